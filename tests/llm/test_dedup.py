"""Line, exact, n-gram and suffix-array deduplication against plain versions."""

from __future__ import annotations

import hashlib
import pickle
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeaudit.llm import compact_windows, components, exact_dedup, hashing, jaccard_join, line_dedup, suffix_array

from .fixtures import BLANKS, LOWER, SCHEMA, corpus, frame, roots, words_of


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# ---- lines


def plain_lines(rows, least):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    out = {}
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least]
        out[r[0]] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_filter_is_small_on_the_driver(spark):
    """What the driver holds and sends of a sparse filter is a small part of it, and it knows just what was seen twice."""
    rng = random.Random(4)
    seen = [rng.getrandbits(64) - 2**63 for _ in range(3000)]
    rows = [(seen[i : i + 30],) for i in range(0, 2000, 30)] + [(seen[1900:],), (seen[2900:],)]
    twice = {h for h in seen if sum(h in r[0] for r in rows) > 1}
    filter_, bits = line_dedup.twice_filter(spark.createDataFrame(rows, "hashes array<long>"), 1 << 20)
    sent = pickle.dumps(filter_)
    assert len(sent) * 4 < line_dedup.SEGMENTS * bits // 8
    known = line_dedup.seen_twice(pickle.loads(sent), bits, np.array(seen, np.int64).view(np.uint64))
    assert {h for h, k in zip(seen, known.tolist(), strict=True) if k} == twice and len(twice) > 100


@pytest.mark.parametrize("bits", [1, 16])
def test_lines(spark, bits):
    """A filter that is much too small only costs work."""
    docs = frame(spark)
    out = line_dedup.drop_shared_lines(docs, bits_per_line=bits, max_filter_bits=1 << (13 if bits == 1 else 29))
    assert out.columns == [*docs.columns, "line_dedup"]
    got = {r.doc_id: (r.text, r.line_dedup.n_lines, r.line_dedup.n_dropped) for r in out.collect()}
    want = plain_lines(corpus(), 10)
    assert got == want and sum(w[2] for w in want.values()) > 20


def test_lines_empty_repeated_and_null_ids(spark):
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "same\nown", None, None, None, None, None)] * 6 + [(1, "Same \nother\nother", None, None, None, None, None)] * 6
    got = sorted(r.text for r in line_dedup.drop_shared_lines(frame(spark, rows)).collect())
    assert got == ["other\nother"] * 6 + ["own"] * 6


# ---- exact copies


def test_exact(spark):
    rows = corpus()
    got = {r.doc_id: tuple(r.exact_dedup) for r in exact_dedup.exact_dedup(frame(spark), head_chars=2).collect()}
    same = defaultdict(list)
    for r in rows:
        same[r[1] or ""].append(r[0])
    want = {i: (max(g), len(g), i == max(g), sha(t)) for t, g in same.items() for i in g}
    assert got == want


def test_exact_edges(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "t", *[None] * 5), (None, "t", *[None] * 5), (None, None, *[None] * 5), (3, "", *[None] * 5), (4, "t2", *[None] * 5), (4, "t2", *[None] * 5)]
    got = sorted(((r.doc_id, r.text, *r.exact_dedup[:3]) for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(
        [(None, "t", None, 2, True)] * 2 + [(None, None, 3, 2, False), (3, "", 3, 2, True)] + [(4, "t2", 4, 2, True)] * 2, key=repr)


# ---- n-gram join


def plain_components(rows, size, percent):
    sets = {}
    for r in rows:
        w = words_of(r[1])
        sets[r[0]] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


@pytest.mark.parametrize(("size", "percent", "crowd", "block"), [(3, 90, 24, 512), (5, 80, 2, 3), (1, 50, 3, 4)])
def test_jaccard(spark, monkeypatch, size, percent, crowd, block):
    """Small crowds and blocks reach the ways of hot n-grams."""
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark), size=size, percent=percent).collect()}
    assert got == plain_components(corpus(), size, percent)


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(5, "a b c d", *[None] * 5), (None, "a b c d", *[None] * 5), (3, "A b  c\td", *[None] * 5), (3, "A b  c\td", *[None] * 5), (9, None, *[None] * 5)]
    got = sorted((tuple(r) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 2, 3), (None, 2, None), (3, 2, 3), (3, 2, 3), (9, 0, 9)], key=repr)
    kept = jaccard_join.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3, 9]


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == roots({x for e in links for x in e}, links)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- suffix arrays


@pytest.mark.parametrize("few", [0, 4096])
def test_suffix_array(monkeypatch, few):
    monkeypatch.setattr(suffix_array, "FEW_SYMBOLS", few)
    rng = random.Random(few)
    for _ in range(150):
        n, symbols = rng.randint(1, 70), rng.choice([1, 2, 3, 200])
        data = np.array([rng.randint(1, symbols) for _ in range(n)], np.uint8)
        text = np.concatenate([data.astype(np.int64) + 1, [0]])
        array = suffix_array.suffix_array(text)
        items = text.tolist()
        assert array.tolist() == sorted(range(n + 1), key=lambda i: items[i:])
        before, common = suffix_array.common_prefixes(data, array)
        order = array[array < n].tolist()
        for a, b in zip(order, order[1:], strict=False):
            k = next((k for k in range(n) if max(a, b) + k >= n or data[a + k] != data[b + k]), n)
            assert (before[b], common[b]) == (a, k)


def plain_removal(rows, length):
    count = Counter(d[i : i + length] for r in rows for d in [(r[1] or "").encode()] for i in range(len(d) - length + 1))
    out = {}
    for r in rows:
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if count[data[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[r[0]] = (bytes(d for d, g in zip(data, gone, strict=True) if not g), len(data), spans)
    return out


@pytest.mark.parametrize(("chunk", "piece", "shard"), [(4096, 8 << 20, 1 << 21), (2, 1000, 3000)])
def test_repeated_bytes(spark, monkeypatch, chunk, piece, shard):
    """Small chunks, pieces and shards reach the ways of hot anchors and long texts."""
    for name, value in (("CHUNK", chunk), ("PIECE", piece), ("SHARD_BYTES", shard)):
        monkeypatch.setattr(suffix_array, name, value)
    rows = corpus()
    out = suffix_array.drop_repeated_bytes(frame(spark), length=250).collect()
    got = {r.doc_id: (bytes(r.suffix_dedup.kept), r.suffix_dedup.n_bytes, len(r.suffix_dedup.spans)) for r in out}
    want = plain_removal(rows, 250)
    assert got == want and sum(w[2] for w in want.values()) > 30


def test_repeated_bytes_edges(spark):
    assert suffix_array.drop_repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(900))
    rows = [(1, text, *[None] * 5), (1, text, *[None] * 5), (None, None, *[None] * 5), (2, "short", *[None] * 5)]
    got = sorted(((r.doc_id or 0, bytes(r.suffix_dedup.kept)) for r in suffix_array.drop_repeated_bytes(frame(spark, rows)).collect()))
    assert got == [(0, b""), (1, b""), (1, b""), (2, b"short")]


# ---- compact windows


def test_compact_windows():
    rng = np.random.default_rng(1)
    for _ in range(200):
        bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 30, rng.integers(1, 5)))])
        hashes = rng.integers(1, rng.choice([3, 10, 1000]), bounds[-1]).astype(np.uint64)
        passage = int(rng.integers(1, 8))
        got = sorted(zip(*[x.tolist() for x in compact_windows.compact_windows(hashes, bounds, passage)], strict=True))
        want = []
        for first, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            for c in range(first, end):
                low = high = c
                while low > first and hashes[low - 1] > hashes[c]:
                    low -= 1
                while high + 1 < end and hashes[high + 1] >= hashes[c]:
                    high += 1
                if high - low + 1 >= passage:
                    want.append((low, c, high))
        assert got == sorted(want)


def test_passages(spark):
    """Every run of 51 words that two documents share connects them, and what is reported is as similar as it says."""
    rows = corpus()
    got = compact_windows.similar_passages(frame(spark)).collect()
    text = {r[0]: words_of(r[1]) for r in rows}
    for r in got:
        a, b = text[r.id][r.first_word : r.last_word + 1], text[r.other_id][r.other_first_word : r.other_last_word + 1]
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        assert len(a & b) / len(a | b) == pytest.approx(r.similarity) and r.similarity >= 0.8
    group = {i: r.class_id for r in got for i in (r.id, r.other_id)}
    first: dict = {}
    for i, words in text.items():
        for k in range(len(words) - 50):
            other = first.setdefault(tuple(words[k : k + 51]), i)
            assert other == i or group[other] == group[i]


def test_passages_edges(spark):
    assert compact_windows.similar_passages(spark.createDataFrame([], SCHEMA)).count() == 0
    words = " ".join(str(i * i) for i in range(80))
    rows = [(None, words, *[None] * 5), (2, "x " + words, *[None] * 5), (3, None, *[None] * 5), (4, "", *[None] * 5), (5, "a b", *[None] * 5)]
    got = compact_windows.similar_passages(frame(spark, rows)).collect()
    assert got and {r.class_id for r in got} == {2} and {i for r in got for i in (r.id, r.other_id)} == {None, 2}


def test_passages_of_frequent_lines(spark):
    """Documents of few frequent lines in changing order: what they share has other, unrelated texts at its signatures' ends."""
    rng = random.Random(4)
    stock = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(15)) for _ in range(12)]
    rows = [(i, " ".join(rng.sample(stock, 4)), *[None] * 5) for i in range(400)]
    got = compact_windows.similar_passages(frame(spark, rows)).collect()
    group = {i: r.class_id for r in got for i in (r.id, r.other_id)}
    first: dict = {}
    links = []
    for i, text, *_ in rows:
        words = text.split()
        for k in range(len(words) - 43):
            other = first.setdefault(tuple(words[k : k + 44]), i)
            if other != i:
                links.append((other, i))
    assert len(links) > 100 and not [(a, b) for a, b in links if a not in group or group.get(a) != group.get(b)]


def test_repeated_words_have_few_windows():
    """A text that repeats a few words has two united windows of a signature, and each run of a text is in one of its signature."""
    repeated = hashing.mix(np.tile(np.arange(1, 8, dtype=np.uint64), 300))
    for _, signature, first, last, *_ in compact_windows._functions(repeated, np.array([0, len(repeated)]), 40):
        assert len(signature) <= 4 and first[0] == 0 and last[-1] == len(repeated) - 40
    rng = np.random.default_rng(3)
    for _ in range(100):
        bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 60, rng.integers(1, 5)))])
        hashes, passage = hashing.mix(rng.integers(1, rng.choice([3, 10, 1000]), bounds[-1]).astype(np.uint64)), int(rng.integers(2, 9))
        for f, signature, first, last, centre, until, text in compact_windows._functions(hashes, bounds, passage):
            mixed = hashing.mix(hashes + np.uint64(0x632BE59BD9B4E019 * (f + 1) % (1 << 64)))
            want = {s: mixed[s : s + passage].min() for a, b in zip(bounds, bounds[1:], strict=False) for s in range(a, b - passage + 1)}
            got = {s: i for i in range(len(first)) for s in range(first[i], last[i] + 1)}
            assert got.keys() == want.keys() and sum(last - first + 1) == len(want)
            for s, i in got.items():
                assert signature[i] == hashing.mix(np.array([want[s]]) + np.uint64(f))[0]
                assert centre[i] <= s + passage - 1 and until[i] >= s and bounds[text[i]] <= s < bounds[text[i] + 1]


def plain_passages(a, b, percent, passage):
    first: dict = {}
    for i, x in enumerate(b):
        first.setdefault(x, i)
    pairs = [(i, first[x]) for i, x in enumerate(a) if x in first]
    open_ = [pairs]
    while open_:
        part = open_.pop()
        if len(part) < 2 or part[-1][0] - part[0][0] + 1 < passage:
            continue
        low, high = min(y for _, y in part), max(y for _, y in part)
        one, two = set(a[part[0][0] : part[-1][0] + 1]), set(b[low : high + 1])
        alike = len(one & two) * 100 >= len(one | two) * percent
        while alike and high - low + 1 < passage and high + 1 < len(b) and b[high + 1] in two:
            high += 1
        if alike and high - low + 1 >= passage:
            yield part[0][0], part[-1][0], low, high, len(one & two), len(one | two)
        else:
            gaps = [max(q[0] - p[0], abs(q[1] - p[1])) for p, q in zip(part, part[1:], strict=False)]
            cut = gaps.index(max(gaps)) + 1
            open_ += [part[:cut], part[cut:]]


def test_similar_passages_against_plain():
    """Parts that are left out early hold no similar passage, and neither do stretches of windows that are not met elsewhere."""
    rng = np.random.default_rng(5)
    found = 0
    for _ in range(600):
        kinds, passage = int(rng.choice([3, 8, 60, 400])), int(rng.integers(2, 12))
        a, b = (rng.integers(0, kinds, rng.integers(1, 80)).astype(np.uint64) for _ in range(2))
        if rng.random() < 0.6:
            b = np.concatenate([b[: rng.integers(0, 20)], a[rng.integers(0, len(a)) :], b[: rng.integers(0, 5)]])
            b[rng.random(len(b)) < 0.1] = 999
        want = list(plain_passages(a.tolist(), b.tolist(), 80, passage)) if len(b) else []
        got = [tuple(map(int, x)) for x in compact_windows._passages(a, b, 80, passage)] if len(b) else []
        assert got == want
        found += len(want)
        once = np.array([(b == x).any() or (a == x).sum() > 1 for x in a])
        assert not want or compact_windows.can_be_similar(once, 80, passage)
    assert found > 100


def test_passage_repeated_in_its_own_text(spark):
    """A text that says the same 33 words again and again, between others, has the passage at another place."""
    rows = [(i, " ".join([f"a{i} b{i} c{i}", *[" ".join(f"w{i}x{k}" for k in range(33))] * 4, f"d{i} e{i}"]), *[None] * 5) for i in range(30)]
    got = compact_windows.similar_passages(frame(spark, rows)).collect()
    assert {(r.id, r.other_id) for r in got} == {(i, i) for i in range(30)} and all(r.similarity >= 0.8 for r in got)


def test_folded_rows_never_lose_a_link():
    """Sets of all sizes around the bound: what the folded rows rule out is not similar."""
    random = np.random.default_rng(5)
    for percent in (50, 80, 90, 100):
        sets = []
        for size in (1, 2, 3, 9, 40, 41, 300, 2000):
            base = random.integers(0, 1 << 62, size, dtype=np.int64).astype(np.uint64)
            for edits in {0, 1, size // 20, size // 10, size // 4}:
                sets.append(np.unique(np.concatenate([base[edits:], random.integers(0, 1 << 62, edits // 2, dtype=np.int64).astype(np.uint64)])))
        sets = [s for s in sets if len(s)]
        n = np.array([len(s) for s in sets])
        folded = [jaccard_join._fold(s, int(w)) for s, w in zip(sets, jaccard_join._folded_bits(n, percent), strict=True)]
        room = jaccard_join._room(n, folded, percent)
        ruled_out = 0
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                shared = len(np.intersect1d(a, b))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    assert room[i, j] >= 0, (percent, i, j)
                ruled_out += room[i, j] < 0
        assert ruled_out > len(sets) ** 2 / 2
