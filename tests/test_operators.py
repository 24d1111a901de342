"""Operators against brute force. Every scope is an independent random case, so one job checks hundreds."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from decimal import Decimal
from statistics import median

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeaudit.functions import columns
from lakeaudit.functions.columns import U64_ZERO, ordered_long, unsigned
from lakeaudit.functions.keccak import digest_array, digests
from lakeaudit.functions.presence import instant_in_partition
from lakeaudit.functions.scope import part_date, part_hour, part_id, part_label
from lakeaudit.operators import digest, drift, findings, keys, ordered, profile, relations
from lakeaudit.operators.relations import Relation

CASES = 150


def by_scope(frame, *values):
    return {r["s"]: tuple(r[v] for v in values) if len(values) > 1 else r[values[0]] for r in frame.collect()}


def maybe(rng, value, share=0.15):
    return None if rng.random() < share else value


@pytest.fixture(scope="module")
def family(spark):
    """Random parents and children with NULL keys and attributes, repeats, orphans and hot keys."""
    rng = random.Random(7)
    parents, children = [], []
    for s in range(CASES):
        for _ in range(rng.randint(0, 8)):
            parents.append((s, maybe(rng, rng.randint(0, 4)), maybe(rng, rng.randint(0, 1)), maybe(rng, rng.choice("ab")), maybe(rng, rng.randint(0, 4)), rng.random() < 0.5))
        for _ in range(rng.randint(0, 12)):
            key = 1 if rng.random() < 0.33 else maybe(rng, rng.randint(0, 5))
            children.append((s, key, maybe(rng, rng.randint(0, 1)), maybe(rng, rng.choice("abc")), rng.randint(0, 4)))
    p = spark.createDataFrame(parents, "s int, a int, b int, attr string, declared int, flagged boolean")
    c = spark.createDataFrame(children, "s int, x int, y int, attr string, ord int")
    return parents, children, p, c


def joined(parents, children, s):
    return [(p, c) for p in parents for c in children if p[0] == c[0] == s and None not in (p[1], p[2]) and (p[1], p[2]) == (c[1], c[2])]


def test_key_agreement(family):
    parents, children, p, c = family
    parent = Relation("p", p, ("a", "b"), attribute="attr", flag=F.col("flagged"))
    rows = relations.key_agreement(parent, [Relation("c", c, ("x", "y"), attribute="attr"), Relation("d", c.where("ord > 1"), ("x", "y"))], ["s"])
    got = {(r["s"], r["relation"]): r for r in rows.collect()}
    for s in range(CASES):
        for name, kids in (("c", [c for c in children if c[0] == s]), ("d", [c for c in children if c[0] == s and c[4] > 1])):
            mine = [q for q in parents if q[0] == s]
            if (s, name) not in got:
                assert not mine and not [c for c in children if c[0] == s]
                continue
            row = got[(s, name)]
            pairs = joined(mine, kids, s)
            parent_keys = {(q[1], q[2]) for q in mine}
            child_keys = {(k[1], k[2]) for k in kids}
            whole = lambda key: None not in key
            assert row["orphan_keys"] == sum(not (whole(k) and k in parent_keys) for k in child_keys)
            assert row["childless_keys"] == sum(not (whole(k) and k in child_keys) for k in parent_keys)
            assert row["flagged_rows"] == sum(q[5] for q, _ in pairs)
            differ = sum(q[3] is not None and k[3] is not None and q[3] != k[3] for q, k in pairs)
            assert row["mismatched_rows"] == (differ if name == "c" else 0)
            repeats = Counter((k[1], k[2]) for k in kids)
            assert row["duplicate_child_keys"] == sum(n > 1 and key[0] is not None for key, n in repeats.items())


def test_key_contract_adds_agreement_up_before_the_shuffle(spark, monkeypatch):
    """What is counted of each key goes to its scope without the key; only candidates and declarations travel by key."""
    sent = []
    met = relations._met
    monkeypatch.setattr(relations, "_met", lambda rows, *rest: (sent.append(rows), met(rows, *rest))[1])
    p = spark.createDataFrame([(i % 2, i, 1, 7) for i in range(50)], "s int, a int, n bigint, attr int")
    c = spark.createDataFrame([(i % 2, i, 0, 7 + (i == 3)) for i in range(60)] + [(0, None, 0, 7)], "s int, a int, ord int, attr int")
    child = Relation("c", c, ("a",), attribute="attr", declared="n", ordinal="ord")
    got = {r["s"]: r for r in relations.key_contract(Relation("p", p, ("a",), attribute="attr"), [child], ["s"]).collect()}
    assert [got[s]["orphan_keys"] for s in (0, 1)] == [6, 5] and [got[s]["mismatched_rows"] for s in (0, 1)] == [0, 1]
    assert [got[s]["count_mismatches"] for s in (0, 1)] == [0, 0]
    agreement = sent[0].where("orphan_keys IS NOT NULL")
    assert agreement.count() == 61 and agreement.select("s", "_k0", "_relation", "_declared").distinct().count() == 2


def test_declared_counts(family):
    parents, children, p, c = family
    weighted = c.groupBy("s", "x", "y", "ord").agg(F.count(F.lit(1)).alias("n"))
    parent = Relation("p", p, ("a", "b"))
    for rows, weight in ((c, None), (weighted, "n")):
        child = Relation("c", rows, ("x", "y"), declared="declared", ordinal="ord", weight=weight)
        got = by_scope(relations.declared_counts(parent, [child], ["s"]), "count_mismatches", "ordinal_mismatches")
        for s in range(CASES):
            counts = ordinals = 0
            for q in (q for q in parents if q[0] == s):
                kids = [k for _, k in joined([q], children, s)]
                if q[4] is None:
                    continue
                counts += q[4] != len(kids)
                ords = [k[4] for k in kids]
                ordinals += bool(kids) and q[4] > 0 and (min(ords) != 0 or max(ords) != q[4] - 1)
            assert got.get(s, (0, 0)) == (counts, ordinals), s


@pytest.mark.parametrize("weight", [None, "n"])
def test_key_contract_is_both_in_one(family, weight):
    _, _, p, c = family
    rows = c if weight is None else c.groupBy("s", "x", "y", "attr", "ord").agg(F.count(F.lit(1)).alias("n"))
    p = p.withColumn("other", F.col("declared") - 1)
    parent = Relation("p", p, ("a", "b"), attribute="attr", flag=F.col("flagged"))
    children = [
        Relation("c", rows, ("x", "y"), attribute="attr", declared="declared", ordinal="ord", weight=weight),
        Relation("plain", c.where("ord > 1"), ("x", "y")),
        Relation("counted", c.where("ord < 3"), ("x", "y"), declared="other", counted="attr"),
        Relation("none", c.where("false"), ("x", "y"), attribute="attr", declared="other"),
    ]
    got = {(r["s"], r["relation"]): r.asDict() for r in relations.key_contract(parent, children, ["s"]).collect()}
    agreement = {(r["s"], r["relation"]): r.asDict() for r in relations.key_agreement(parent, children, ["s"]).collect()}
    counts = relations.declared_counts(Relation("p", p, ("a", "b")), [x for x in children if x.declared], ["s"])
    counts = {(r["s"], r["relation"]): r.asDict() for r in counts.collect()}
    assert set(got) == set(agreement) >= set(counts) and len(counts) > CASES
    for key, row in got.items():
        both = agreement[key] | {"count_mismatches": 0, "ordinal_mismatches": 0} | counts.get(key, {})
        assert row == both, key
    assert not relations.key_contract(parent, children[:3], ["s"]).where("s < 0").count()


def test_declared_counts_on_the_unsigned_scale(family):
    parents, children, p, c = family
    plain = relations.declared_counts(
        Relation("p", p, ("a", "b")), [Relation("c", c, ("x", "y"), declared="declared", ordinal="ord")], ["s"])
    shift = lambda frame, name: frame.withColumn(name, ordered_long(F.col(name).cast("decimal(20,0)")))
    moved = relations.declared_counts(
        Relation("p", shift(p, "declared"), ("a", "b")),
        [Relation("c", shift(c, "ord"), ("x", "y"), declared="declared", ordinal="ord", zero=U64_ZERO, base=U64_ZERO)], ["s"])
    names = ("count_mismatches", "ordinal_mismatches")
    assert by_scope(plain, *names) == by_scope(moved, *names)


def test_duplicates_skip_null_first_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, None), (3, 1)], "a int, b int")
    assert keys.duplicate_keys(rows, ["a", "b"]).first()[0] == 1
    assert keys.duplicate_keys(rows, ["a", "b"], counted="b").first()[0] == 1
    assert keys.duplicate_keys(rows.limit(0), ["a", "b"]).first()[0] == 0


def test_ordinal_verdicts(spark):
    groups = {
        "good": [0, 1, 2], "repeat": [0, 1, 1, 2], "gap": [0, 2], "late": [1, 2], "balanced": [0, 0, 2], "one": [0], "high": [5],
    }
    rows = spark.createDataFrame([(g, o) for g, os in groups.items() for o in os], "g string, o bigint")
    verdicts = keys.ordinal_groups(rows, ["g"], "o").select(
        "g", keys.is_ordinal_set().alias("set"), keys.is_ordinal_list().alias("list"), keys.has_gap().alias("gap"), keys.starts_late().alias("late"))
    got = {r["g"]: (r["set"], r["list"], r["gap"], r["late"]) for r in verdicts.collect()}
    for g, os in groups.items():
        distinct = sorted(set(os))
        assert got[g] == (
            distinct == list(range(len(distinct))), sorted(os) == list(range(len(os))), max(os) + 1 - min(os) != len(os), min(os) > 0), g


@pytest.mark.parametrize("parts", [4, 61])
def test_backward_groups(spark, parts):
    """Many small groups, and two with most of the rows and ordinals far apart, one of which falls once; cut into few or many ranges."""
    rng = random.Random(parts)
    rows = [(s, g, rng.randint(-6, 9), rng.randint(0, 9) if s % 2 else None) for s in range(CASES) for g in range(3) for _ in range(rng.randint(0, 5))]
    rows = [(s, g, o, o + 20 if v is None else v) for s, g, o, v in rows]
    steps = sorted({rng.randrange(-(2**62), 2**62) for _ in range(3000)})
    rows += [(None, 7, o, n) for n, o in enumerate(steps)] + [(None, 8, o, n - 2 * (n == 2000)) for n, o in enumerate(steps)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "s int, g int, o bigint, v int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts == 4)
    try:
        _check_backward_groups(frame, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def _check_backward_groups(frame, rows):
    got = by_scope(ordered.backward_groups(frame, ["g"], "o", "v", scope=["s"]), "backward_groups")
    want = defaultdict(int)
    for s, g in {(r[0], r[1]) for r in rows}:
        values = [v for _, v in sorted((r[2], r[3]) for r in rows if r[:2] == (s, g))]
        want[s] += any(b < a for a, b in zip(values, values[1:]))
    assert got == dict(want)


def test_backward_children(spark):
    rng = random.Random(3)
    left = [(s, rng.randint(0, 1), rng.randint(0, 4), rng.randint(0, 5)) for s in range(CASES) for _ in range(rng.randint(0, 6))]
    right = [(s, rng.randint(0, 1), rng.randint(0, 4), rng.randint(0, 9)) for s in range(CASES) for _ in range(rng.randint(0, 6))]
    frame = lambda rows, name: spark.createDataFrame(rows, f"s int, g int, link int, {name} int")
    got = by_scope(ordered.backward_children(frame(left, "o"), frame(right, "v"), ["g"], "link", "o", "v", ["s"]), "backward_groups")
    values = defaultdict(list)
    for row in right:
        values[row[:3]].append(row[3])
    for s in range(CASES):
        want = 0
        for g in (0, 1):
            points = sorted((a[3], v) for a in left if a[:2] == (s, g) for v in values[a[:3]])
            want += any(b[1] < a[1] for a, b in zip(points, points[1:]))
        assert got.get(s, 0) == want, s


@pytest.mark.parametrize("bits", [16, 12])
def test_distribution(spark, monkeypatch, bits):
    """Values of all sizes and signs, near to and far from each other."""
    monkeypatch.setattr(profile, "DIGIT_BITS", bits)
    rng = random.Random(5)
    scale = lambda: rng.choice([1, 1, 2**11, 2**16, 2**33, 2**50, 2**56])
    cases = {s: [rng.randint(-40, 60) * scale() if rng.random() < 0.7 else 7 for _ in range(rng.randint(1, 9))] for s in range(CASES)}
    rows = [(s if s else None, v) for s, values in cases.items() for v in values] + [(1, None)]
    frame = spark.createDataFrame(rows, "s int, v bigint")
    hist = profile.histogram(frame, "v", ["s"])
    got = by_scope(profile.distribution(hist, ["s"]), "count", "minimum", "median_value", "maximum")
    for s, values in cases.items():
        assert got[s or None] == (len(values), min(values), float(median(values)), max(values))
    every = [v for values in cases.values() for v in values]
    row = profile.distribution(profile.histogram(frame, "v")).first()
    assert tuple(row) == (len(every), min(every), float(median(every)), max(every))
    empty = profile.distribution(profile.histogram(frame.where("v IS NULL"), "v")).first()
    assert tuple(empty) == (0, None, None, None)


def test_no_window_over_more_rows_than_a_digit_has(spark):
    """A million sparse values of one scope: the median is exact, and what the windows see is bounded by their digits."""
    frame = spark.range(1_000_000).select((F.col("id") * 7_777_777_777_777 - 2**61).alias("v"))
    row = profile.distribution(profile.histogram(frame, "v")).first()
    half = (499_999 * 7_777_777_777_777 - 2**61) + (500_000 * 7_777_777_777_777 - 2**61)
    assert tuple(row) == (1_000_000, -(2**61), float(half) / 2, 999_999 * 7_777_777_777_777 - 2**61)
    cells = frame.groupBy(*[F.shiftright("v", profile.DIGIT_BITS * k).alias(f"c{k}") for k in (1, 2, 3)]).count()
    for k in (3, 2, 1):
        above = ["c3", "c2"][: 3 - k]
        assert cells.groupBy(*above).agg(F.countDistinct(f"c{k}").alias("n")).agg(F.max("n")).first()[0] <= 1 << profile.DIGIT_BITS


def test_distribution_of_huge_unsigned_values(spark):
    values = [0, 1, 2**63, 2**64 - 1]
    frame = spark.createDataFrame([(str(v),) for v in values], "v string").select(ordered_long(F.col("v").cast("decimal(20,0)")).alias("v"))
    row = profile.distribution(profile.histogram(frame, "v"), zero=U64_ZERO).first()
    assert (int(row["minimum"]), int(row["maximum"])) == (0, 2**64 - 1)
    assert row["median_value"] == float((1 + 2**63) / 2)
    back = frame.select(unsigned("v", U64_ZERO).alias("v")).collect()
    assert sorted(int(r["v"]) for r in back) == values


def test_short_runs_and_tail_only(spark):
    rng = random.Random(11)
    cases = {s: [rng.choice([1, 1, 2, 3, 5, 8]) for _ in range(rng.randint(1, 8))] for s in range(CASES)}
    starts = {s: [rng.choice([0, 0, 0, 2]) for _ in lengths] for s, lengths in cases.items()}
    hist = profile.histogram(spark.createDataFrame([(s, v) for s, vs in cases.items() for v in vs], "s int, v bigint"), "v", ["s"])
    got = by_scope(profile.short_runs(hist, profile.distribution(hist, ["s"]), ["s"]), "short_runs", "threshold_length")
    ranges = spark.createDataFrame([(s, v) for s, vs in starts.items() for v in vs], "s int, first_ordinal bigint")
    tails = by_scope(profile.tail_only_excess(ranges, ["s"]), "tail_only", "group_count")
    for s, lengths in cases.items():
        limit = max(1, int(median(lengths) // 2))
        short = sum(v <= limit for v in lengths)
        due = len(lengths) >= 4 and median(lengths) >= 3 and 0 < short < len(lengths)
        assert got.get(s) == ((short, limit) if due else None), s
        late = sum(v > 0 for v in starts[s])
        assert tails.get(s) == ((late, len(lengths)) if late >= 3 and late / len(lengths) >= 0.25 else None), s


def test_leave_one_out_medians(spark):
    rng = random.Random(13)
    cases = {s: [rng.choice([1.0, 2.0, 2.0, 5.5, 9.0]) for _ in range(rng.randint(1, 7))] for s in range(CASES)}
    frame = spark.createDataFrame([(s, n, v) for s, vs in cases.items() for n, v in enumerate(vs)], "s int, n int, v double")
    for row in drift.leave_one_out_medians(frame, ["s"], "v", ["n"]).collect():
        others = [v for n, v in enumerate(cases[row["s"]]) if n != row["n"]]
        assert row["peer_values"] == len(others)
        assert row["peer_median"] == (median(others) if others else None)


def brute_metric_drift(rows, limits):
    """rows: (partition, cohort, judged, {metric: value or None})"""
    found = {}
    for part, cohort, judged, values in rows:
        if not judged:
            continue
        drifted = []
        for metric, (ratio_limit, gap) in limits.items():
            value = values[metric]
            peers = [r[3][metric] for r in rows if r[0] != part and r[1] == cohort and r[3][metric] is not None]
            if value is None or len(peers) < 3:
                continue
            middle = float(median(peers))
            positive = value > 0 and middle > 0
            ratio = max(value, middle) / min(value, middle) if positive else (math.inf if value != middle else 1.0)
            if value > 0 if middle == 0 else ratio >= ratio_limit and abs(value - middle) >= gap:
                drifted.append((metric, ratio))
        if drifted:
            found[part] = (len(drifted), ",".join(m for m, _ in drifted), max(drifted, key=lambda d: d[1])[0])
    return found


def test_metric_drift(spark):
    rng = random.Random(17)
    limits = {"rows": (1.5, 1.0), "bytes": (2.0, 2.0), "ratio": (1.25, 0.1)}
    rows = [
        (n, n % 25, rng.random() < 0.8, {"rows": rng.choice([0, 0, 3, 4, 6]), "bytes": rng.choice([0, 5, 5, 20]), "ratio": maybe(rng, rng.choice([1.0, 1.2, 2.0]), 0.3)})
        for n in range(25 * 6)
    ]
    frame = spark.createDataFrame([(p, c, j, float(v["rows"]), float(v["bytes"]), v["ratio"]) for p, c, j, v in rows],
                                  "part int, cohort int, judged boolean, rows double, bytes double, ratio double")
    got = {r["part"]: (r["drifted"], r["metrics"], r["metric"]) for r in drift.metric_drift(frame, ["part"], ["cohort"], limits, target="judged").collect()}
    assert got == brute_metric_drift(rows, limits) and len(got) > 20


def test_mix_drift(spark):
    rng = random.Random(19)
    parts = {}
    for n in range(30 * 7):
        labels = rng.sample("vwxyz", rng.randint(1, 3))
        parts[n] = (n % 30, rng.random() < 0.8, {label: rng.choice([1, 1, 5, 20]) for label in labels})
    share = lambda n, label: parts[n][2].get(label, 0) / sum(parts[n][2].values())
    want = {}
    for n, (cohort, judged, mix) in parts.items():
        peers = [m for m in parts if m != n and parts[m][0] == cohort]
        if not judged or len(peers) < 3:
            continue
        drifted = []
        for label in sorted({x for m in [*peers, n] for x in parts[m][2]}):
            gap = abs(share(n, label) - median(share(m, label) for m in peers))
            if gap >= 0.35:
                drifted.append((label, gap))
        if drifted:
            best = max(drifted, key=lambda d: d[1])
            want[n] = (len(drifted), best[0], round(best[1], 9))
    mix = spark.createDataFrame([(n, c, label, share(n, label)) for n, (c, _, m) in parts.items() for label in m], "part int, cohort int, label string, share double")
    who = spark.createDataFrame([(n, c, j) for n, (c, j, _) in parts.items()], "part int, cohort int, judged boolean")
    got = {r["part"]: (r["drifted"], r["label"], round(r["difference"], 9)) for r in drift.mix_drift(mix, who, ["part"], ["cohort"], target="judged").collect()}
    assert got == want and len(want) > 20


def test_members(spark):
    present = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z"), (None, "b")], "s int, member string")
    absent = {tuple(r) for r in relations.absent_members(present, ["s"], present, "member", ["a", "b"]).collect()}
    assert absent == {(1, "b"), (None, "a")}
    assert [tuple(r) for r in relations.unknown_members(present, ["s"], "member", ["a", "b"]).collect()] == [(1, "z")]


def test_digests(spark):
    assert digests([]) == []
    empty, abc = digests([b"", b"abc"])
    assert empty.hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert abc.hex() == "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"
    lengths = [0, 1, 135, 136, 137, 271, 272, 273, 5000] * 80
    together = digests([bytes([n % 251]) * length for n, length in enumerate(lengths)])
    assert together == [digests([bytes([n % 251]) * length])[0] for n, length in enumerate(lengths)]
    values = [None if n % 7 == 0 else bytes([n % 251]) * length for n, length in enumerate(lengths)]
    for kind in (pa.binary(), pa.large_binary()):  # NULLs, and a stretch of a longer array
        part = digest_array(pa.array(values, kind).slice(5, 600)).to_pylist()
        assert part == [v and digests([v])[0] if v != b"" else empty for v in values[5:605]]
    assert digest_array(pa.array([None, None], pa.binary())).to_pylist() == [None, None]
    rows = spark.createDataFrame([(1, b"abc", abc), (1, b"abd", abc), (2, b"", empty), (2, None, empty)], "s int, p binary, d binary")
    assert by_scope(digest.digest_mismatches(rows, "p", "d", "keccak256", ["s"]), "rows", "mismatches") == {1: (2, 1), 2: (2, 1)}
    with pytest.raises(ValueError):
        digest.digest("p", "crc")


def test_partition_identity(spark):
    rows = spark.createDataFrame([("2026-04-05", None), ("2026-04-05", 0), ("2026-04-05", 23), ("1969-12-31", 4)], "d string, h int")
    ids = rows.select(part_id(F.to_date("d"), "h").alias("i"), "d", "h")
    got = ids.select("i", "d", "h", part_date("i").cast("string").alias("d2"), part_hour("i").alias("h2"), part_label("i").alias("l")).orderBy("i").collect()
    assert [(r["d"], r["h"]) for r in got] == [(r["d2"], r["h2"]) for r in got]
    assert [r["l"] for r in got] == ["1969-12-31T04:00Z", "2026-04-05", "2026-04-05T00:00Z", "2026-04-05T23:00Z"]


def test_instants_are_read_in_utc(spark):
    rows = spark.createDataFrame([("2026-04-05 23:59:59", "2026-04-05", 23), ("2026-04-06 00:00:00", "2026-04-05", 23), ("2026-04-06 00:00:00", "2026-04-06", None)],
                                 "t string, d string, h int")
    frame = rows.select(F.to_timestamp("t").alias("t"), F.to_date("d").alias("d"), "h").cache()
    frame.count()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert [r[0] for r in frame.select(instant_in_partition("t", F.col("d"), F.col("h"))).collect()] == [True, False, True]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        frame.unpersist()


def test_example_cap_keeps_findings(spark):
    rows = spark.range(100).selectExpr("'r' AS rule_id", "id AS place", "CASE WHEN id % 2 = 0 THEN '{}' END AS example", "lpad(id, 3, '0') AS k")
    kept = findings.cap_examples(rows, ["k"], limit=25).orderBy("place").collect()
    assert len(kept) == 100
    assert [r["place"] for r in kept if r["example"]] == list(range(0, 50, 2))


HOT = 600_000


def test_hot_key_does_not_pile_up(spark):
    """A third of all rows share one key on both sides; counts stay exact and no task sees the pairs."""
    ids = spark.range(HOT)
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    left = ids.select(hot.alias("k"), (F.col("id") % 2).alias("attr"), F.col("id").alias("ord"))
    right = ids.select(hot.alias("k"), F.lit(0).alias("attr"), (F.col("id") % 5).alias("declared"))
    row = relations.key_agreement(Relation("r", right, ("k",), attribute="attr"), [Relation("l", left, ("k",), attribute="attr")]).first()
    third = HOT // 3
    assert row["mismatched_rows"] == third // 2 * third + (HOT - third) // 2
    assert row["orphan_keys"] == 0 and row["duplicate_child_keys"] == 1
    counts = relations.declared_counts(Relation("r", right, ("k",)), [Relation("l", left, ("k",), declared="declared", ordinal="ord")]).first()
    ones = ids.where("id % 3 <> 0 AND id % 5 = 1").count()
    assert counts["count_mismatches"] == HOT - ones
    falls = ordered.backward_groups(left, ["k"], "ord", "attr").first()[0]
    assert falls == 1


def test_unknown_rule_fails(spark):
    rows = spark.createDataFrame([("known",), ("unknown",)], "rule_id string")
    rules = findings.rule_frame(spark, [("known", "low", "warn", "a rule")])
    with pytest.raises(Exception, match="no such rule: unknown"):
        findings.with_rule_defaults(rows, rules).collect()


def test_count_beyond_long_fails(spark):
    rows = spark.createDataFrame([(Decimal(2**63),)], "n decimal(38,0)")
    with pytest.raises(Exception, match="exceeds BIGINT"):
        rows.select(columns.exact_long(F.col("n"))).collect()


def test_unknown_file_system_is_no_corrupt_file():
    from lakeaudit.sources import manifest

    with pytest.raises(ValueError, match="file system"):
        manifest._footer("nosuch://lake/file.parquet")
