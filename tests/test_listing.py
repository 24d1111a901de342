"""Both ways of listing a lake and reading footers give the same rows, on a scheme that Python can't open as well."""

from __future__ import annotations

from datetime import date

import pyarrow as pa
import pytest

from lakeaudit.plans.audit import audit
from lakeaudit.sources import listing, manifest

TABLE = pa.table({"k": pa.array([1, 2, 3], pa.uint64()), "v": pa.array([b"ab", None, b"cd"], pa.binary(2))})
LAYOUTS = {
    "date": "date=2026-03-{d:02d}/flashblocks_2026-03-{d:02d}.parquet",
    "hour": "year=2026/month=03/day={d:02d}/hour=07/flashblocks_2026-03-{d:02d}_07.parquet",
    "table": "flashblocks/year=2026/month=03/day={d:02d}/flashblocks_2026-03-{d:02d}.parquet",
}
ODD = (
    "loose.parquet", "year=2026/month=xx/day=01/a.parquet", "year=2026/month=03/notes/deep/er/b.parquet", "flashblocks/year=nine/c.parquet",
    "other/where/d.parquet", "date=never/e.parquet", "year=2026/month=03/day=02/tmp/f.parquet",
)
EMPTY = "date=2026-03-06/empty_2026-03-06.parquet"
UNSEEN = (
    "tmp/g.parquet", "_staging/h.parquet", ".hidden/i.parquet", "date=2026-03-02/_j.parquet", "date=2026-03-02/.k.parquet", "date=2026-03-02/l.txt",
    "year=2026/month=03/day=02/_temporary/0/m.parquet",
)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Three layouts over nine days, names that stand for no day, names that are no part of a lake; a long footer, damaged files."""
    root = tmp_path_factory.mktemp("list") / "a lake+100% é"
    for pattern in LAYOUTS.values():
        for d in range(1, 10):
            write(root / pattern.format(d=d), TABLE.slice(0, d % 4))
    for name in (*ODD, *UNSEEN):
        write(root / name, TABLE)
    (root / "year=2026/month=03/day=20").mkdir(parents=True)
    wide = pa.table({f"column_with_a_rather_long_name_{i}": [1] for i in range(1500)})
    write(root / "date=2026-03-05/wide_2026-03-05.parquet", wide)
    (root / "date=2026-03-06/cut_2026-03-06.parquet").write_bytes((root / LAYOUTS["date"].format(d=6)).read_bytes()[:-3])
    (root / "date=2026-03-06/empty_2026-03-06.parquet").write_bytes(b"")
    (root / "date=2026-03-06/huge_2026-03-06.parquet").write_bytes(b"PAR1" + b"\xff\xff\xff\x7fPAR1")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.audit.link./in", f"file://{root.parent}")
    return root


def write(path, table):
    import pyarrow.parquet as pq

    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path)


def listed(spark, root, *days):
    return sorted(r.rel_path for r in listing.list_files(spark, str(root), *days).collect())


@pytest.mark.parametrize("limit", [1, 256])
def test_both_ways_list_the_same(spark, lake, monkeypatch, limit):
    monkeypatch.setattr(listing, "DIRECTORIES_PER_TASK", limit)
    everything = sorted(str(p.relative_to(lake)) for p in lake.rglob("*.parquet"))
    want = [p for p in everything if p not in UNSEEN]
    store = f"viewfs://audit/in/{lake.name}"
    assert not listing.executors_can_open(spark, store) and listing.executors_can_open(spark, str(lake))
    assert listed(spark, lake) == want and len(want) == 27 + len(ODD) + 4
    want.remove(EMPTY)  # Spark's sources pass over files of no bytes
    assert listed(spark, store) == want
    bounds = (date(2026, 3, 2), date(2026, 3, 3))
    inside = [p for p in want if p in ODD or "03-02" in p or "03-03" in p]
    assert listed(spark, lake, *bounds) == inside == listed(spark, store, *bounds)
    assert listed(spark, lake, date(2027, 1, 1)) == sorted(p for p in ODD if not p.startswith("year=2026")) == listed(spark, store, date(2027, 1, 1))


def test_listing_stays_off_the_driver(spark, lake, monkeypatch):
    """The frontier never asks the driver for names below the root, and its plan holds no list of files."""
    monkeypatch.setattr(listing.LakeFiles, "children", lambda *_: pytest.fail("listed on the driver"))
    frame = listing.list_files(spark, str(lake))
    assert frame.count() == 38 and "flashblocks" not in frame._jdf.queryExecution().toString()


def test_footers_of_a_scheme_that_python_cannot_open(spark, lake):
    columns = ("rel_path", "readable", "row_count", "file_size_bytes", "row_groups", "compressed_bytes", "uncompressed_bytes", "fields", "partition_date")
    rows = lambda root: sorted(map(tuple, manifest.build_manifest(spark, root).select(*columns).collect()), key=lambda r: r[0])
    local, store = rows(str(lake)), rows(f"viewfs://audit/in/{lake.name}")
    assert [r for r in local if r[0] != EMPTY] == store
    facts = {r[0]: r for r in local}
    plain = facts[LAYOUTS["hour"].format(d=7)]
    assert plain[1:3] == (True, 3) and [tuple(f) for f in plain[7]] == [("k", "uint64", True), ("v", "fixed_size_binary[2]", True)]
    assert plain[3] == (lake / plain[0]).stat().st_size
    wide = facts["date=2026-03-05/wide_2026-03-05.parquet"]
    assert wide[1] and len(wide[7]) == 1500
    assert [facts[f"date=2026-03-06/{n}_2026-03-06.parquet"][1] for n in ("cut", "empty", "huge")] == [False] * 3
    assert facts["loose.parquet"][1] is None


def test_audit_of_a_store_that_only_spark_opens(spark, tmp_path):
    from . import lakegen as g

    g.write_partition(tmp_path / "lake", g.payload_tables(date(2026, 4, 5)), date(2026, 4, 5))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.whole.link./in", f"file://{tmp_path}")
    found = [sorted((r.rule_id, r.dataset or "", r["count"] or 0) for r in audit(spark, root).findings.collect()) for root in (f"{tmp_path}/lake", "viewfs://whole/in/lake")]
    assert found[0] == found[1] and len(found[0]) == 16


def test_choice_by_hand(spark, lake):
    spark.conf.set(listing.LISTING_CONF, "spark")
    try:
        frame = listing.list_files(spark, str(lake), date(2026, 3, 1), date(2026, 3, 1))
        assert "footer" in frame.columns and frame.where("rel_path LIKE 'date=2026%'").count() == 1
    finally:
        spark.conf.unset(listing.LISTING_CONF)
