"""What steps leave on the disk: no shuffle files, and no tables that nothing reads any more."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from lakeaudit.llm import compact_windows, shared
from lakeaudit.plans import registry
from lakeaudit.session import FREES_SHUFFLES, settle
from tools.compare import normal

from .llm.fixtures import frame


def shuffle_files(spark, least: int = 0) -> set[str]:
    """The names of shuffle files of so many bytes or more."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getName() for f in files if f.getName().startswith("shuffle_") and f.length() >= least}


def test_settled_frames_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREES_SHUFFLES, None)
    counts = settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert sorted(tuple(r) for r in counts.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
    assert shuffle_files(spark) <= before and spark.conf.get(FREES_SHUFFLES, None) == setting


def test_rule_pack_holds_one_step_at_a_time(spark, tmp_path):
    """All rules with rows of their own: each step's shuffles are gone before the result is read, and the result is SQL's."""
    db = duckdb.connect()
    db.execute("CREATE TABLE orders AS SELECT range AS o_orderkey, (range * 37 % 1000)::DOUBLE AS o_totalprice FROM range(400)")
    db.execute("""CREATE TABLE lineitem AS SELECT i * 7 % 400 AS l_orderkey, i * 13 % 200 AS l_partkey, i * 11 % 100 AS l_suppkey,
        (i % 7 + 1)::INTEGER AS l_linenumber, (i * 3 % 50 + 1)::DOUBLE AS l_quantity, CASE WHEN i % 3 = 0 THEN 'A' ELSE 'N' END AS l_returnflag
        FROM range(1600) t(i)""")
    for name in ("orders", "lineitem"):
        db.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet'")
    before = shuffle_files(spark)
    got = registry.queries()["rulepack_integrity"](spark, str(tmp_path)).toPandas()
    assert shuffle_files(spark) <= before
    want = db.execute(registry.oracle_sql()["rulepack_integrity"]).df()
    assert len(want) > 100 and normal(got) == normal(want)


def test_passages_discard_what_they_have_used(spark):
    """Tables of word windows, runs and pairs go as soon as what is made of them is written; so do the shuffles."""
    rng = random.Random(4)
    stock = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(15)) for _ in range(12)]
    texts = [" ".join(rng.sample(stock, 4)) for _ in range(150)]
    rows = [(i % 150, texts[i % 150], *[None] * 5) for i in range(160)]  # some rows come twice
    tables = lambda: set(Path(shared.shared_folder(spark)).glob("llm-*"))
    before, shuffled = tables(), shuffle_files(spark, 2000)
    out = compact_windows.similar_passages(frame(spark, rows))
    left = [{f.name for f in spark.read.parquet(str(p)).schema} for p in tables() - before]
    assert not [c for c in left if c & {"grams", "signature", "of", "wanted", "seeds", "head", "places"}] and len(left) <= 14
    assert shuffle_files(spark, 2000) <= shuffled  # counts of one row aside
    assert out.count() == out.distinct().count() > 50


def test_pairs_of_tiles_are_all_pairs(spark, monkeypatch):
    """With few pairs of places at a time the last step takes several passes, which find the same passages."""
    rng = random.Random(4)
    stock = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(15)) for _ in range(10)]
    rows = [(i, " ".join(rng.sample(stock, 4)), *[None] * 5) for i in range(120)]
    calls, verified, found = [], compact_windows._Passages.verified, []
    monkeypatch.setattr(compact_windows._Passages, "verified", lambda *given: calls.append(1) or verified(*given))
    for pairs in (compact_windows.PAIRS_AT_ONCE, 700):
        monkeypatch.setattr(compact_windows, "PAIRS_AT_ONCE", pairs)
        calls.clear()
        got = sorted(tuple(r) for r in compact_windows.similar_passages(frame(spark, rows)).collect())
        found.append((got, len(calls)))
    assert found[0][0] and found[0][0] == found[1][0] and found[0][1] == 3 < found[1][1]
