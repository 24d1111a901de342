"""Findings as rows: shape, enrichment with the rule catalogue, example cap, counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

RULE_SCHEMA = "rule_id string, severity string, status string, description string"
#: So many rules at most are broadcast, after they were counted.
BROADCAST_RULES = 10_000
SEVERITIES = ("critical", "high", "medium", "low")


def example_json(fields: Sequence[tuple[str, Column]]) -> Column:
    """Example as JSON text with sorted keys; NULL values stay visible."""
    ordered = [value.alias(name) for name, value in sorted(fields, key=lambda item: item[0])]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def as_findings(
    rows: DataFrame,
    rule_id: str | Column,
    dataset: str | Column | None = None,
    count: Column | str | None = None,
    file: Column | str | None = None,
    example: Column | None = None,
    part_id: str | None = "part_id",
) -> DataFrame:
    """Project rows onto the finding columns. Columns are passed as Column or, for ``count``, by name."""

    def text(value: str | Column | None) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("string")

    return rows.select(
        text(rule_id).alias("rule_id"),
        (F.col(part_id) if part_id else F.lit(None)).cast("int").alias("part_id"),
        text(dataset).alias("dataset"),
        text(file).alias("file"),
        (F.col(count) if isinstance(count, str) else F.lit(None) if count is None else count).cast("bigint").alias("count"),
        text(example).alias("example"),
    )


def rule_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA)


def with_rule_defaults(findings: DataFrame, rules: DataFrame) -> DataFrame:
    """Add status, severity and message. A finding whose rule is not listed fails the query; it is never dropped."""
    defaults = rules.select("rule_id", "status", "severity", F.col("description").alias("message"))
    unknown = F.raise_error(F.concat(F.lit("no such rule: "), F.coalesce("rule_id", F.lit("NULL")))).cast("string")
    # findings are many and rules few: a catalogue of counted size is sent to the findings, not both to one task per rule
    joined = findings.join(F.broadcast(defaults) if rules.count() <= BROADCAST_RULES else defaults, "rule_id", "left")
    return joined.withColumn("status", F.when(F.col("status").isNull(), unknown).otherwise(F.col("status")))


def cap_examples(findings: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    """For pages that are read by people; stored findings have all examples.

    Keep the example of the first ``limit`` example-carrying findings of each rule; keep every finding.

    Spark limits the ranking on the map side, so at most ``limit`` rows per rule and task are
    shuffled. Only the boundary row of each rule travels back to the findings.
    """
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in order])
    ranked = (
        findings.where(F.col("example").isNotNull())
        .select("rule_id", key.alias("_key"))
        .withColumn("_rank", F.row_number().over(W.partitionBy("rule_id").orderBy("_key")))
        .where(F.col("_rank") <= limit)
    )
    boundary = ranked.groupBy("rule_id").agg(F.max("_key").alias("_last"), F.count(F.lit(1)).alias("_kept"))
    return (
        findings.withColumn("_key", key)
        .join(boundary, "rule_id", "left")
        .withColumn("example", F.when((F.col("_kept") < limit) | (F.col("_key") <= F.col("_last")), F.col("example")))
        .drop("_key", "_last", "_kept")
    )


def rule_counts(findings: DataFrame) -> DataFrame:
    """Findings per rule: ``rule_id, findings``."""
    return findings.groupBy("rule_id").agg(F.count(F.lit(1)).alias("findings"))


def status_counts(findings: DataFrame) -> DataFrame:
    """One row: findings per status, whether any fails, and the worst severity."""
    rank = F.lit(None).cast("int")
    for place, severity in enumerate(SEVERITIES):
        rank = F.when(F.col("severity") == severity, F.lit(place)).otherwise(rank)
    return findings.agg(
        F.count_if(F.col("status") == "fail").alias("fail_count"),
        F.count_if(F.col("status") == "warn").alias("warn_count"),
        F.count_if(F.col("status") == "metric").alias("metric_count"),
        F.coalesce(F.bool_or(F.col("status") == "fail"), F.lit(False)).alias("has_failures"),
        F.min_by("severity", rank).alias("max_severity"),
    )
