"""Registered queries against DuckDB on the smallest tables (all of them with LAKEAUDIT_ALL_QUERIES=1)."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402
from lakeaudit.plans import registry  # noqa: E402
from tools.compare import normal  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUICK = (
    "dup_key", "ordinal_sequences", "orphan_null_keys", "count_reconcile_repeated_parents", "relation_summary", "monotonic", "row_shapes",
    "distribution_wide", "label_mix", "count_drift", "all_examples", "review_next", "upsert_snapshots", "strict_records", "digest_verify", "keccak_known_values", "dup_text", "footer_row_counts", "path_parsing",
)
NAMES = list(registry.oracle_sql()) if os.environ.get("LAKEAUDIT_ALL_QUERIES") else QUICK
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_registry():
    queries, oracle = registry.queries(), registry.oracle_sql()
    assert set(queries) <= set(entry.queries()) and set(oracle) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert set(oracle) <= set(queries) and set(QUICK) <= set(oracle)
    assert set(queries) - set(oracle) == {"physical_stats", "schema_contract", "schema_differences"}


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() == 1


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
