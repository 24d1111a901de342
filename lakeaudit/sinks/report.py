"""Writing an audit: findings as JSON lines, a summary row, a short Markdown page."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.audit import FINDING_COLUMNS, ORDER, Audit


def write_findings(findings: DataFrame | None, path: str, spark: SparkSession | None = None) -> None:
    """One JSON object per finding with sorted keys, in finding order; absent values are written as null.

    Without findings (a run that had nothing to audit) an empty output is written.
    """
    if findings is None:
        spark.createDataFrame([], "value string").write.mode("errorifexists").text(path)
        return
    # An example is JSON already, so it is spliced in between the keys before and after it.
    plain = [c for c in sorted(FINDING_COLUMNS) if c != "example"]
    before = F.to_json(F.struct(*[c for c in plain if c < "example"]), {"ignoreNullFields": "false"})
    after = F.to_json(F.struct(*[c for c in plain if c > "example"]), {"ignoreNullFields": "false"})
    line = F.concat(
        F.expr("substring(b, 1, length(b) - 1)"), F.lit(',"example":'), F.coalesce("example", F.lit("null")), F.lit(","), F.expr("substring(a, 2)"))
    findings.orderBy(*ORDER).select("example", before.alias("b"), after.alias("a")).select(line.alias("value")).write.mode("errorifexists").text(path)


def summary_payload(audit: Audit) -> dict[str, object]:
    """The summary as a dict: one row of totals, the partition labels, and one count per rule of the catalogue."""
    row = audit.summary().first().asDict()
    row["reviewed_partitions"] = [r["partition"] for r in audit.reviewed_partitions().collect()]
    row["rule_counts"] = {r["rule_id"]: r["findings"] for r in audit.rule_counts().collect()}
    return row


def markdown(payload: dict[str, object], root: str, title: str = "Lake audit") -> str:
    lines = [f"# {title}", "", f"Storage root: `{root}`", ""]
    lines += [f"- {name.replace('_', ' ')}: `{value}`" for name, value in payload.items() if name != "rule_counts"]
    lines += ["", "## Findings per rule", ""]
    counts = payload.get("rule_counts") or {}
    lines += [f"- `{rule}`: `{counts[rule]}`" for rule in sorted(counts)] or ["- no findings"]
    lines += ["", "## Payload", "", "```json", json.dumps(payload, sort_keys=True, indent=2, default=str), "```", ""]
    return "\n".join(lines)


def write_text(spark, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def write_report(audit: Audit, root: str, path: str) -> dict[str, object]:
    """Write ``findings``, ``summary`` and ``summary_page`` below ``path``; return the summary payload."""
    spark = audit.findings.sparkSession
    write_findings(audit.findings, f"{path}/findings")
    payload = summary_payload(audit)
    write_text(spark, json.dumps(payload, sort_keys=True, default=str), f"{path}/summary")
    write_text(spark, markdown(payload, root), f"{path}/summary_page")
    return payload
