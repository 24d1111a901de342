"""Removal of byte strings that occur more than once, found with suffix arrays.

Every window of ``length`` bytes holds an *anchor*: the places with the smallest hash of ``GRAM`` bytes in it. Equal windows
have equal anchors, so only texts around anchors that occur more than once are looked at, and equal windows meet in the
same shard. Surroundings that are equal as a whole are found by counting; where they differ (at the borders of repeated
passages), a shard's suffix array tells which windows repeat: it is built by induced sorting, and the common prefixes of
neighbours are computed in text order. An anchor with very many different surroundings is dealt to several shards, and what
is unique in a shard is then compared between shards by hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hashing
from .shared import lookup, row_key, with_result, written

#: Bytes of an anchor.
GRAM = 100
#: A longer text is searched in pieces of so many bytes, which overlap by a window.
PIECE = 8 << 20
#: Low bits that tell a place in a piece; the hash that anchors are chosen by has the others.
PLACE_BITS = np.uint64(24)
#: Different surroundings of one anchor that one shard takes.
CHUNK = 4096
#: Bytes of text after which a shard's array is built.
SHARD_BYTES = 1 << 21
#: Symbols up to which buckets are induced as a whole.
FEW_SYMBOLS = 4096
#: Between texts of a shard; no byte of UTF-8.
SEPARATOR = 0xFF


def _classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the sentinel's is)."""
    n = len(text)
    differs = np.ones(n, bool)
    differs[:-1] = text[1:] != text[:-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = text[:-1] < text[1:]
    following = np.where(differs, np.arange(n), n)  # where the run of equal symbols ends
    following = np.minimum.accumulate(following[::-1])[::-1]
    return smaller[following]


def _induce(text: np.ndarray, small: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that the given order of leftmost-smaller suffixes induces.

    Bucket by bucket, not suffix by suffix: all that a bucket induces into later ones is appended at once, in order; what it
    induces into itself comes in rounds, one for each further symbol of a run.
    """
    n, symbols = len(text), len(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    array = np.full(n, -1, np.int64)

    # larger suffixes, front to back: a bucket's own part first, then its leftmost-smaller suffixes
    sent: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    mine = np.searchsorted(text[leftmost][np.argsort(text[leftmost], kind="stable")], np.arange(symbols + 1))
    leftmost = leftmost[np.argsort(text[leftmost], kind="stable")]
    large: list[np.ndarray] = []
    for c in range(symbols):
        own = np.concatenate(sent[c]) if sent[c] else np.empty(0, np.int64)
        sent[c] = []
        parts, fresh = [own], own
        while len(fresh):
            before = fresh[fresh > 0] - 1
            before = before[~small[before]]
            fresh = before[text[before] == c]
            parts.append(fresh)
            _append(sent, text, before[text[before] != c])
        whole = np.concatenate(parts)
        array[starts[c] : starts[c] + len(whole)] = whole
        large.append(whole)
        stars = leftmost[mine[c] : mine[c + 1]]
        before = stars[stars > 0] - 1
        _append(sent, text, before[~small[before]])

    # smaller suffixes, back to front
    sent = [[] for _ in range(symbols)]
    for c in range(symbols - 1, -1, -1):
        own = np.concatenate(sent[c]) if sent[c] else np.empty(0, np.int64)  # from the bucket's end
        parts, fresh = [own], own
        while len(fresh):
            before = fresh[fresh > 0] - 1
            before = before[small[before]]
            fresh = before[text[before] == c]
            parts.append(fresh)
            _append(sent, text, before[text[before] != c])
        whole = np.concatenate(parts)
        if c == 0 and not len(whole):
            whole = np.array([n - 1])  # the sentinel
            before = whole[whole > 0] - 1
            _append(sent, text, before[small[before]])
        array[starts[c + 1] - len(whole) : starts[c + 1]] = whole[::-1]
        back = large[c][::-1]
        before = back[back > 0] - 1
        _append(sent, text, before[small[before]])
    return array


def _append(sent: list[list[np.ndarray]], text: np.ndarray, places: np.ndarray) -> None:
    """Deal suffixes to the buckets of their symbols, keeping their order."""
    if len(places):
        symbol = text[places]
        order = np.argsort(symbol, kind="stable")
        symbol, places = symbol[order], places[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for c, part in zip(symbol[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts), strict=True):
            sent[c].append(part)


def _induce_each(before: tuple[list[int], list[int]], text: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray) -> list[int]:
    """As _induce, suffix by suffix, for the many symbols of a shortened text.

    ``before`` has the symbol before each place if that is larger, and if it is smaller than its follower; else, and at the
    end (which -1, an empty place, reads), -1.
    """
    heads, tails = (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()
    array = [-1] * len(text)
    ends = tails.copy()
    larger, smaller = before
    for i, c in zip(leftmost[::-1].tolist(), text[leftmost[::-1]].tolist(), strict=True):
        ends[c] -= 1
        array[ends[c]] = i
    for i in array:  # what is put in goes to later places
        c = larger[i]
        if c >= 0:
            array[heads[c]] = i - 1
            heads[c] += 1
    for k in range(len(array) - 1, -1, -1):
        i = array[k]
        c = smaller[i]
        if c >= 0:
            c_end = tails[c] - 1
            tails[c] = c_end
            array[c_end] = i - 1
    array[0] = len(array) - 1
    return array


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``text``, whose last symbol is 0 and stands nowhere else."""
    text = text.astype(np.int64)
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    sizes = np.bincount(text)
    small = _classify(text)
    star = np.zeros(n, bool)
    star[1:] = small[1:] & ~small[:-1]
    leftmost = np.flatnonzero(star)
    if len(sizes) <= FEW_SYMBOLS:
        induce = lambda order: _induce(text, small, order, sizes)
    else:
        before = [np.concatenate([[-1], np.where(small[:-1] == kind, text[:-1], -1), [-1]]).tolist() for kind in (False, True)]
        induce = lambda order: np.array(_induce_each(before, text, order, sizes), np.int64)
    sorted_ = induce(leftmost)
    sorted_ = sorted_[star[sorted_]]
    names = np.empty(n, np.int64)
    names[sorted_] = np.cumsum(_differ(text, sorted_, leftmost)) - 1
    shorter = names[leftmost]
    if shorter.max() + 1 < len(shorter):
        sorted_ = leftmost[suffix_array(shorter)]
    return induce(sorted_)


def _differ(text: np.ndarray, sorted_: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """For leftmost-smaller substrings in order: whether each differs from the one before."""
    size = np.zeros(len(text), np.int64)
    size[leftmost[:-1]] = np.diff(leftmost) + 1
    size[leftmost[-1]] = 1
    a, b = sorted_[:-1], sorted_[1:]
    differ = np.ones(len(sorted_), bool)
    open_ = np.flatnonzero(size[a] == size[b])
    differ[open_ + 1] = False
    k = 0
    while len(open_):
        unlike = text[a[open_] + k] != text[b[open_] + k]
        differ[open_[unlike] + 1] = True
        k += 1
        open_ = open_[~unlike & (size[a[open_]] > k)]
    return differ


def common_prefixes(data: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``data``: the place before it in the order of suffixes (-1: none), and their common prefix.

    The length at a place is one less than at the place before it, if the bytes before both neighbours are equal; only the
    other lengths are counted, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    array = array[array < n]
    before[array[1:]] = array[:-1]
    own = np.ones(n, bool)
    own[1:] = (before[1:] <= 0) | (data[:-1] != data[before[1:] - 1])
    own &= before >= 0
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words |= padded[k : n + 1 + k] << np.uint64(8 * k)
    x = np.flatnonzero(own)
    y = before[x]
    length = np.zeros(n, np.int64)
    count, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(open_):
        a, b = np.minimum(x[open_] + count[open_], n), np.minimum(y[open_] + count[open_], n)
        unlike = words[a] ^ words[b]
        low = unlike & (~unlike + np.uint64(1))
        more = np.where(unlike == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)) // 8).astype(np.int64))
        room = n - np.maximum(a, b)
        count[open_] += np.minimum(more, room)
        open_ = open_[(unlike == 0) & (room > 8)]
    length[x] = count
    last = np.maximum.accumulate(np.where(own, np.arange(n), -1))
    fill = (before >= 0) & ~own
    length[fill] = length[last[fill]] - (np.flatnonzero(fill) - last[fill])
    return before, length


def repeated_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of all texts: whether each repeats, and where each text's windows begin (and the last end).

    The third array names the content: equal windows have one number, that of their first in the suffix array.
    """
    data = np.frombuffer(bytes([SEPARATOR]).join([*texts, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(0, np.int64)
    array = suffix_array(np.concatenate([data.astype(np.int64) + 1, [0]]))
    before, common = common_prefixes(data, array)
    array = array[array < len(data)]
    same = common >= length
    repeats = same.copy()
    repeats[before[same]] = True
    content = np.empty(len(data), np.int64)
    content[array] = np.cumsum(~same[array])
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    count = np.maximum(sizes - length + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    places = np.repeat(starts - bounds[:-1], count) + np.arange(bounds[-1])
    return repeats[places], bounds, content[places]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from the running minima of blocks in both directions."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def _pieces(keys: pa.Array, texts: pa.Array, length: int) -> Iterator[tuple[list, list[int], list[bytes]]]:
    """Keys, first bytes and bytes of texts, about ``hashing.RUN_BYTES`` at a time."""
    found: tuple[list, list[int], list[bytes]] = ([], [], [])
    held = 0
    for key, text in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
        data = text.encode() if isinstance(text, str) else text
        for at in range(0, max(1, len(data) - length + 1), PIECE):
            part = data[at : at + PIECE + length - 1]
            if len(part) >= length:
                for items, item in zip(found, (key, at, part), strict=True):
                    items.append(item)
                held += len(part)
            if held >= hashing.RUN_BYTES:
                yield found
                found, held = ([], [], []), 0
    if found[0]:
        yield found


def _anchors(length: int):
    """For each anchor: its hash, its surroundings' hash, where its windows begin and how many they are, and its place there."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
        for batch in batches:
            for keys, offsets, parts in _pieces(batch.column(0), batch.column(1), length):
                data = np.frombuffer(b"".join(parts), np.uint8)
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
                ranges = hashing.Ranges(data)
                grams = ranges.all_of(GRAM)
                if len(data) > mask:
                    raise ValueError("a piece is larger than places can tell")
                anchor = _sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1) & mask
                count = np.diff(bounds) - length + 1
                first = np.concatenate([[0], np.cumsum(count)])
                start = np.repeat(bounds[:-1] - first[:-1], count) + np.arange(first[-1])  # of all windows within a text
                place = anchor[start].astype(np.int64)
                new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                windows = np.diff(np.concatenate([new, [len(place)]]))
                start, place = start[new], place[new]
                around = ranges.hash(start, start + windows - 1 + length)
                around = hashing.mix(around + (place - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
                text = np.searchsorted(bounds, start, side="right") - 1
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(grams[place].view(np.int64)), "around": pa.array(around.view(np.int64)),
                    "key": pa.array(keys, pa.string()).take(pa.array(text)),
                    "start": pa.array(start - bounds[text] + np.array(offsets)[text], pa.int64()), "windows": pa.array(windows, pa.int32()),
                    "place": pa.array(place - start, pa.int32()),
                })

    return anchors


def _slice(length: int):
    """The bytes around sampled anchors."""

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, samples in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode()
                rows += [(s["anchor"], s["around"], s["chunk"], s["chunks"], s["place"], data[s["start"] : s["start"] + s["windows"] - 1 + length]) for s in samples]
            names = ["anchor", "around", "chunk", "chunks", "place", "bytes"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[i : i + 10_000], strict=True), kinds, strict=True)], names=names)

    return slice_


def _trimmed(rows: list[tuple], length: int) -> list[tuple[int, int, int, int, bytes]]:
    """Anchor, surroundings, chunks, first window and bytes, without windows that can't repeat.

    A window goes half of what is beside its anchor to the left or, beyond that, to the right. If no other surroundings of
    the anchor are equal there, its windows on that side are unique. Anchors in several chunks stay as they are.
    """
    half = (length - GRAM) // 2
    sides: Counter = Counter()
    keys = []
    for anchor, _, _, _, place, data in rows:
        left = (anchor, 0, data[place - half : place]) if place >= half else None
        right = (anchor, 1, data[place + GRAM : place + GRAM + half]) if len(data) >= place + GRAM + half else None
        sides.update(k for k in (left, right) if k)
        keys.append((left, right))
    parts = []
    for (anchor, around, _, chunks, place, data), (left, right) in zip(rows, keys, strict=True):
        low, high = 0, len(data) - length + 1
        if chunks == 1:
            border = max(0, place - half + 1)  # windows from here on go to the right
            low = low if sides[left] > 1 else min(border, high)
            high = high if sides[right] > 1 else min(border, high)
        if low < high:
            parts.append((anchor, around, chunks, low, data[low : high - 1 + length]))
    return parts


def _shards(length: int):
    """For surroundings in the order of their anchors: the windows that repeat in the shard, as ranges; of anchors in several
    chunks also every window's hash, once for each content in the shard, and whether it repeats there."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        parts = _trimmed(rows, length)
        repeats, bounds, content = repeated_windows([p[4] for p in parts], length)
        out = {"anchor": [], "around": [], "low": [], "high": [], "window": []}
        seen: set[int] = set()
        for (anchor, around, chunks, shift, data), a, b in zip(parts, bounds[:-1], bounds[1:], strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], repeats[a:b].astype(np.int8), [0]]))) + shift
            low, high, window = edge[::2].tolist(), (edge[1::2] - 1).tolist(), [None] * (len(edge) // 2)
            if chunks > 1:
                all_ = hashing.Ranges(np.frombuffer(data, np.uint8)).all_of(length).view(np.int64).tolist()
                for i, (number, hash_) in enumerate(zip(content[a:b].tolist(), all_, strict=True)):
                    if number not in seen:
                        seen.add(number)
                        low.append(i)
                        high.append(i)
                        window.append(hash_)
            for name, values in (("anchor", [anchor] * len(low)), ("around", [around] * len(low)), ("low", low), ("high", high), ("window", window)):
                out[name] += values
        kinds = {"low": pa.int32(), "high": pa.int32()}
        return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_BYTES and row[:1] + row[2:3] != last:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
                last = row[:1] + row[2:3]
        if rows:
            yield shard(rows)

    return shards


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, spans = [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data, merged = text.encode(), []
            for start, end in sorted((r["start"], r["end"]) for r in ranges or []):
                if merged and start <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], end)
                else:
                    merged.append({"start": start, "end": end})
            edges = [0, *(x for m in merged for x in (m["start"], m["end"])), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append(merged)
        yield pa.RecordBatch.from_pydict({"row": batch.column(0), "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, kind)})


def repeated_ranges(docs: DataFrame, key, text, length: int) -> DataFrame:
    """``key, start, end`` of bytes that windows occurring more than once cover; ranges may overlap."""
    base = docs.select(key.alias("key"), text.alias("text"))
    anchors = written(base.mapInArrow(_anchors(length), "anchor long, around long, key string, start long, windows int, place int"))
    counts = written(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    anchors = written(lookup(anchors, counts, ["anchor"], "_n", "inner"))
    sample = F.min(F.struct("key", "start", "windows", "place")).alias("sample")
    around = written(anchors.groupBy("anchor", "around").agg(F.count(F.lit(1)).alias("_n"), sample).select("anchor", "around", "_n", "sample.*"))
    several = around.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("chunks", F.ceil(F.col("_n") / F.lit(CHUNK)).cast("int"))
    unlike = lookup(around.drop("_n"), written(several), ["anchor"], "_n", "inner").withColumn("chunk", F.pmod("around", "chunks").cast("int"))
    samples = unlike.groupBy("key").agg(F.collect_list(F.struct("anchor", "around", "chunk", "chunks", "place", "start", "windows")).alias("samples"))
    schema = "anchor long, around long, chunk int, chunks int, place int, bytes binary"
    texts = written(base.dropDuplicates(["key"]).join(samples, "key").select("text", "samples").mapInArrow(_slice(length), schema))
    shards = max(1, -(-(texts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0) // (2 * SHARD_BYTES)))
    dealt = texts.repartition(shards, "anchor", "chunk").sortWithinPartitions("anchor", "chunk")
    found = written(dealt.mapInArrow(_shards(length), "anchor long, around long, low int, high int, window long"))
    across = found.where("window IS NOT NULL")
    again = across.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    across = lookup(across, written(again), ["anchor", "window"], "_n", "inner")
    ranges = found.where("window IS NULL").unionByName(across.select(found.columns)).select("anchor", "around", "low", "high")
    ranges = ranges.groupBy("anchor", "around").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    whole = around.where("_n > 1").select("anchor", "around", F.array(F.struct(F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))).alias("ranges"))
    sizes = around.select("anchor", "around", "_n")
    facts = written(whole.unionByName(ranges).groupBy("anchor", "around").agg(F.flatten(F.collect_list("ranges")).alias("ranges")).join(sizes, ["anchor", "around"]))
    out = lookup(anchors, facts, ["anchor", "around"], "_n", "inner").select("key", "start", F.explode("ranges").alias("r"))
    return out.select("key", (F.col("start") + F.col("r.low")).alias("start"), (F.col("start") + F.col("r.high") + length).alias("end"))


def drop_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, result: str = "suffix_dedup"
) -> DataFrame:
    """All rows with a struct column ``kept`` (binary), ``spans`` (array of start and end) and ``n_bytes``.

    Texts are UTF-8 bytes, a NULL is empty. Every byte that a string of ``length`` bytes covers which also starts anywhere
    else, in the same or another row, is removed; strings lie within one row and are judged on the input. What stays may
    not be valid UTF-8, so it is binary. Spans are the maximal removed runs. Repeated rows are copies of each other and
    lose what such copies lose. Ids may be NULL or repeat. An empty table gives no rows. Other columns are passed on
    whatever their names; one named as the result is replaced.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    key, text = row_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit(""))
    gone = repeated_ranges(docs, key, text, length).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), text.alias("text")).join(gone, "key", "left").select("row", "text", "gone")
    schema = rows.select("row").schema.add("kept", "binary").add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long")))
    out = rows.mapInArrow(_cut, schema)
    size = F.octet_length(F.coalesce(F.col("row").getField(text_col), F.lit(""))).cast("long").alias("n_bytes")
    return with_result(out.withColumn(result, F.struct("kept", "spans", size)), result)
