"""Manifest, gates and drift on whole lakes."""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import date

import pyarrow as pa
import pytest

from lakeaudit.functions.paths import parse_path
from lakeaudit.plans.audit import audit
from lakeaudit.plans.datasets import CONTRACT
from lakeaudit.plans.rules import RULES
from lakeaudit.sinks.report import write_report
from lakeaudit.sources.contracts import contract_frame, schema_differences
from lakeaudit.sources.manifest import build_manifest, discover_days, layout_errors

from . import lakegen as g
from .lakegen import F, R, T, W

METRICS = {rule for rule, _, status, _ in RULES if status == "metric"}


def issues(outcome):
    found = defaultdict(set)
    for row in outcome.findings.where("status <> 'metric'").collect():
        found[row["partition"]].add((row["rule_id"], row["dataset"]))
    return dict(found)


PATHS = {
    "date=2026-04-05/flashblocks_2026-04-05.parquet": ("date_partition", "flashblocks", "2026-04-05", None),
    "date=2026-04-05/flashblocks_2026-04-06.parquet": ("date_partition", "flashblocks", "2026-04-05", None),
    "flashblocks/year=2026/month=04/day=05/flashblocks_2026-04-05.parquet": ("table_partition", "flashblocks", "2026-04-05", None),
    "year=2026/month=04/day=05/hour=09/flashblocks_2026-04-05_09.parquet": ("hour_partition", "flashblocks", "2026-04-05", 9),
    "year=2026/month=4/day=5/hour=7/a_b_2026-04-05_07.parquet": ("hour_partition", "a_b", "2026-04-05", 7),
    "date=bad/flashblocks_2026-04-05.parquet": None,
    "date=2026-02-30/flashblocks_2026-02-28.parquet": None,
    "date=2026-02-28/flashblocks_2026-02-30.parquet": None,
    "flashblocks/year=2026/month=04/day=xx/flashblocks_2026-04-05.parquet": None,
    "flashblocks/year=2026/month=02/day=30/flashblocks_2026-02-28.parquet": None,
    "flashblocks/year=2026/month=02/day=28/flashblocks_2026-02-30.parquet": None,
    "flashblocks/year=2026/month=04/day=05/other_2026-04-05.parquet": None,
    "flashblocks/year=2026/month=04/day=05/extra/flashblocks_2026-04-05.parquet": None,
    "year=2026/month=04/day=05/hour=99/flashblocks_2026-04-05_99.parquet": None,
    "year=2026/month=04/day=05/hour=24/flashblocks_2026-04-05_24.parquet": None,
    "year=2026/monthX04/day=05/hour=09/flashblocks_2026-04-05_09.parquet": None,
    "year=2026/month=02/day=30/hour=09/flashblocks_2026-02-28_09.parquet": None,
    "year=99999/month=02/day=03/hour=09/flashblocks_2026-02-28_09.parquet": None,
    "year=2026/month=04/day=05/hour=09/flashblocks_2026-04-05.parquet": None,
    "flashblocks_2026-04-05.parquet": None,
}


def test_path_parsing(spark):
    frame = spark.createDataFrame([(p,) for p in PATHS], "rel_path string").select("rel_path", parse_path("rel_path").alias("p"))
    got = {r["rel_path"]: r["p"] for r in frame.collect()}
    for path, want in PATHS.items():
        have = got[path]
        assert (have and (have["layout"], have["dataset"], str(have["partition_date"]), have["partition_hour"])) == want, path


@pytest.fixture(scope="module")
def gates(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("gates") / "a lake+x"
    day = lambda n: date(2026, 4, n)
    tables = {n: g.payload_tables(day(n)) for n in range(1, 11)}
    del tables[1][R]
    g.write_partition(root, tables[1], day(1))
    g.write_partition(root, tables[2], day(2), "table")
    g.write_partition(root, {F: tables[2][F]}, day(2), "date")
    g.write_partition(root, tables[3], day(3))
    g.write_table(g.file_path(root, "hour", F, day(3)), pa.table({"payload_id": ["bad"], "index": pa.array([0], pa.uint64())}))
    g.write_partition(root, tables[4], day(4))
    g.write_table(g.file_path(root, "hour", "surprise", day(4)), pa.table({"marker": pa.array([1], pa.uint64())}))
    blocks = tables[5].pop(F)
    g.write_partition(root, tables[5], day(5))
    g.write_table(root / "year=2026/month=04/day=05/hour=09/flashblocks_2026-04-06_09.parquet", pa.Table.from_pylist(blocks, g.schema(F)))
    withdrawals = tables[6].pop(W)
    g.write_partition(root, tables[6], day(6), "table")
    g.write_partition(root, {W: withdrawals}, day(6), "date")
    g.write_partition(root, tables[7], day(7))
    g.file_path(root, "hour", T, day(7)).write_bytes(b"not parquet")
    g.write_partition(root, {name: [] for name in CONTRACT}, day(8))
    g.write_partition(root, tables[9], day(9), "date")
    bad = root / "flashblocks/year=2026/month=04/day=xx/flashblocks_2026-04-05.parquet"
    bad.parent.mkdir(parents=True, exist_ok=True)
    bad.write_bytes(b"bad path")
    g.write_partition(root / "tmp", tables[10], day(10))
    return root, audit(spark, str(root))


def test_gates(gates):
    root, outcome = gates
    assert issues(outcome) == {
        None: {("partition_parse_error", None)},
        "2026-04-01T09:00Z": {("missing_required_dataset", R)},
        "2026-04-02": {("mixed_storage_layout_for_partition", None), ("multiple_readable_files_for_dataset_partition", F)},
        "2026-04-03T09:00Z": {("schema_mismatch", F)},
        "2026-04-04T09:00Z": {("unknown_dataset", "surprise")},
        "2026-04-05T09:00Z": {("partition_date_mismatch", F)},
        "2026-04-06": {("mixed_storage_layout_for_partition", None)},
        "2026-04-07T09:00Z": {("invalid_parquet_file", T), ("missing_required_dataset", T)},
    }
    reviewed = [r["partition"] for r in outcome.reviewed_partitions().collect()]
    assert reviewed == ["2026-04-04T09:00Z", "2026-04-05T09:00Z", "2026-04-06", "2026-04-08T09:00Z", "2026-04-09"]
    file = outcome.findings.where("rule_id = 'schema_mismatch'").first()["file"]
    assert file == str(g.file_path(root, "hour", F, date(2026, 4, 3)))
    misnamed = outcome.findings.where("rule_id = 'partition_date_mismatch'").first()
    assert json.loads(misnamed["example"]) == {"filename_day": "2026-04-06", "filename_hour": 9, "partition_hour": 9}
    assert misnamed["count"] is None


def test_peer_eligibility(gates):
    _, outcome = gates
    rows = {str(r["partition_date"]): r["peer_eligible"] for r in outcome.snapshots.partitions.collect()}
    assert rows == {"2026-04-04": False, "2026-04-05": False, "2026-04-06": False, "2026-04-08": True, "2026-04-09": True}


def test_empty_partition_metrics(gates):
    _, outcome = gates
    rows = outcome.findings.where("partition = '2026-04-08T09:00Z'").collect()
    assert {r["rule_id"] for r in rows} == METRICS and len(rows) == 16
    empty = next(r for r in rows if r["rule_id"] == "empty_dataset_count")
    assert empty["count"] == 8 and json.loads(empty["example"])["datasets"] == ",".join(sorted(CONTRACT))
    runs = next(r for r in rows if r["rule_id"] == "payload_run_length_distribution")
    assert json.loads(runs["example"]) == {f"payload_length_{k}": 0 if k == "count" else None for k in ("count", "min", "median", "max")}


def test_summary_and_report(spark, gates, tmp_path):
    root, outcome = gates
    payload = write_report(outcome, str(root), str(tmp_path / "report"))
    assert payload["scanned_files"] == 7 + 9 + 8 + 9 + 8 + 8 + 7 + 8 + 8 and payload["has_failures"] is True
    assert payload["fail_count"] == 5 and payload["warn_count"] == 5 and payload["metric_count"] == 5 * 16
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "report/findings")).collect()]
    assert len(lines) == payload["fail_count"] + payload["warn_count"] + payload["metric_count"]
    for line in lines:
        assert list(line) == sorted(line) and set(line) == {
            "rule_id", "status", "severity", "message", "day", "partition", "dataset", "file", "count", "example"}
    assert any(isinstance(line["example"], dict) for line in lines)
    page = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "report/summary_page")).collect())
    assert "`missing_required_dataset`: `2`" in page


def test_schema_differences(spark, gates):
    _, outcome = gates
    rows = schema_differences(outcome.manifest.where("readable"), contract_frame(spark, CONTRACT)).collect()
    assert {r["dataset"] for r in rows} == {F} and len(rows) == 27


def test_manifest_bounds_days_before_opening_footers(spark, gates):
    root, _ = gates
    manifest = build_manifest(spark, str(root), date(2026, 4, 4), date(2026, 4, 5))
    rows = manifest.collect()
    assert {str(r["partition_date"]) for r in rows if r["layout"]} == {"2026-04-04", "2026-04-05"}
    assert [r["rel_path"] for r in rows if r["layout"] is None] == ["flashblocks/year=2026/month=04/day=xx/flashblocks_2026-04-05.parquet"]
    row = next(r for r in rows if r["dataset"] == F and str(r["partition_date"]) == "2026-04-04")
    assert (row["row_count"], row["row_groups"], len(row["fields"])) == (4, 1, 27)
    assert row["file_size_bytes"] == g.file_path(root, "hour", F, date(2026, 4, 4)).stat().st_size
    only = build_manifest(spark, str(root), date_from=date(2026, 4, 9)).where("layout IS NOT NULL").select("partition_date").distinct().collect()
    assert [str(r[0]) for r in only] == ["2026-04-09"]
    with pytest.raises(ValueError):
        build_manifest(spark, str(root), date(2026, 4, 5), date(2026, 4, 4))


def test_missing_root(spark, tmp_path):
    with pytest.raises(ValueError):
        audit(spark, str(tmp_path / "nowhere"))


def test_empty_lake(spark, tmp_path):
    outcome = audit(spark, str(tmp_path))
    rows = outcome.findings.collect()
    assert [(r["rule_id"], r["partition"], r["status"]) for r in rows] == [("no_matching_parquet_files", None, "fail")]


def test_discovered_days_and_layout(spark, tmp_path):
    for text in ("year=2026/month=04/day=05", "year=2026/month=04/day=06", "tmp/anything"):
        (tmp_path / text).mkdir(parents=True)
    g.write_partition(tmp_path, {F: []}, date(2026, 4, 7))
    rows = {str(r["partition_date"]): r["has_files"] for r in discover_days(spark, str(tmp_path)).collect()}
    assert rows == {"2026-04-05": False, "2026-04-06": False, "2026-04-07": True}
    assert layout_errors(spark, str(tmp_path)) == []
    (tmp_path / "date=2026-04-05").mkdir()
    (tmp_path / "stray.txt").write_text("x")
    (tmp_path / "year=2026/month=13").mkdir()
    assert len(layout_errors(spark, str(tmp_path))) == 3


@pytest.fixture(scope="module")
def drifting(spark, tmp_path_factory):
    """Four hours, four days each; the fourth day differs in its own way per hour."""
    root = tmp_path_factory.mktemp("drift")
    for hour in (10, 11, 12, 13):
        for number in (1, 2, 3, 4):
            day = date(2026, 4, number)
            tables = g.payload_tables(day, hour)
            if hour == 10 and number == 4:
                tables = g.merged(tables, g.payload_tables(day, hour, "second", 7420))
            if hour == 11 and number == 4:
                tables = g.payload_tables(day, hour, labels=("legacy",) * 6)
            if hour == 12 and number == 3:
                tables[F][1]["base_block_number"] = 7300
            if hour == 12 and number == 4:
                tables = g.merged(tables, g.payload_tables(day, hour, "second", 7420))
            if hour == 13 and number == 3:
                tables = g.merged(tables, g.only_indexes(g.payload_tables(day, hour, "second", 7420), {1, 2}))
            if hour == 13 and number == 4:
                tables = g.merged(tables, g.payload_tables(day, hour, "second", 7420))
            g.write_partition(root, tables, day, "hour", hour)
    return audit(spark, str(root))


def test_physical_drift_against_three_healthy_days(drifting):
    rows = drifting.findings.where("rule_id = 'dataset_physical_drift'").collect()
    by = {(r["partition"], r["dataset"]): json.loads(r["example"]) for r in rows}
    second = by[("2026-04-04T10:00Z", F)]
    assert second["metric"] == "row_count" and second["drift_ratio"] == 2.0 and second["peer_median"] == 4.0
    assert second["peer_count"] == 3 and second["comparison_scope"] == "same_hour" and second["metrics"].startswith("row_count")
    # Hours 12 and 13 lost a peer to a failing and a warned partition.
    assert {p for p, _ in by} <= {"2026-04-04T10:00Z", "2026-04-04T11:00Z"}


def test_mix_drift(drifting):
    rows = drifting.findings.where("rule_id = 'transaction_type_mix_drift'").collect()
    assert [r["partition"] for r in rows] == ["2026-04-04T11:00Z"]
    example = json.loads(rows[0]["example"])
    assert rows[0]["count"] == 1
    assert example == {"type_label": "legacy", "share": 1.0, "peer_median_share": 0.1667, "difference": 0.8333, "peer_count": 3, "comparison_scope": "same_hour"}
