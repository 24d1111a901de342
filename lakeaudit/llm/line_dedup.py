"""Removal of lines that many documents share, with Bloom filters for lines seen once and seen twice.

The hashes of all lines pass by two filters: one holds what was seen, the other what was seen again. Only lines that the
second filter knows leave their task with their text; their documents are then counted exactly. A filter never forgets a
line, so its errors only cost shuffled rows.

The filters are cut into ``SEGMENTS`` ranges of the hash. A task sends each range's hashes, once each, to the task that owns
the range, which keeps two bit arrays of a fixed size and nothing else. Their size follows the number of lines up to
``MAX_FILTER_BITS``, the proven bound of what is broadcast; with more lines the filters get denser and more lines are
confirmed exactly, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeing_shuffles
from .shared import Packed, handing_back, lookup, packed, row_key, with_result, written

#: Stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENTS = 256
BITS_PER_LINE = 16
#: 64 MiB: no filter is larger, whatever the input.
MAX_FILTER_BITS = 1 << 29


def line_key(line: Column) -> Column:
    """A line as it is compared: blanks stripped at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text_col: str) -> Column:
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places in the segment of each hash; bits is a power of two."""
    mask = np.uint64(bits - 1)
    return (hashes >> np.uint64(8)) & mask, ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) & mask


def _has(filter_: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (filter_[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _put(filter_: np.ndarray, place: np.ndarray) -> None:
    np.bitwise_or.at(filter_, place >> np.uint64(3), np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8)))


def _segment(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SEGMENTS - 1)).astype(np.int64)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each segment: the batch's hashes, once each, those that several of its documents have apart."""
    for batch in batches:
        hashes, counts = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
        segment = _segment(hashes)
        order = np.argsort(segment, kind="stable")
        hashes, counts, segment = hashes[order], counts[order], segment[order]
        found, starts = np.unique(segment, return_index=True)
        parts = list(zip(np.split(hashes, starts[1:]), np.split(counts, starts[1:]), strict=True)) if len(found) else []
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(found, pa.int32()),
            "once": pa.array([h[c == 1].tobytes() for h, c in parts], pa.binary()),
            "again": pa.array([h[c > 1].tobytes() for h, c in parts], pa.binary()),
        })


def _fill(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, once, again in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if segment not in filters:
                    filters[segment] = (np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8))
                seen, twice = filters[segment]
                both = np.frombuffer(again, np.uint64)
                first, second = _places(np.frombuffer(once, np.uint64), bits)
                repeat = _has(seen, first) & _has(seen, second)
                for place in (first[repeat], second[repeat], *_places(both, bits)):
                    _put(twice, place)
                for place in (first, second, *_places(both, bits)):
                    _put(seen, place)
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(list(filters), pa.int32()), "twice": pa.array([packed(t) for _, t in filters.values()], pa.binary()),
        })

    return fill


def twice_filter(hashes: DataFrame, count: int, bits_per_item: int = BITS_PER_LINE, max_filter_bits: int = MAX_FILTER_BITS) -> tuple[Packed, int]:
    """The filter of hashes seen twice, and the bits of a segment, for rows of one column ``hashes`` (array of long)."""
    bits = min(1 << max(10, (count * bits_per_item // SEGMENTS).bit_length()), max_filter_bits // SEGMENTS)
    dealt = hashes.mapInArrow(handing_back(_deal), "segment int, once binary, again binary")
    with freeing_shuffles(hashes.sparkSession):
        filters = dealt.repartition(SEGMENTS, "segment").mapInArrow(handing_back(_fill(bits)), "segment int, twice binary")
        parts = {part.segment: bytes(part.twice) for part in filters.collect()}  # max_filter_bits in all, before they are compressed
    return Packed(parts, bits // 8, SEGMENTS * bits // 8, "uint8"), bits


def seen_twice(filter_: Packed, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter knows each hash."""
    offset = _segment(hashes).astype(np.uint64) * np.uint64(bits)
    first, second = _places(hashes, bits)
    return _has(filter_.whole, first + offset) & _has(filter_.whole, second + offset)


def _suspects(twice, bits: int):
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            hit = np.flatnonzero(seen_twice(twice.value, bits, hashes))
            row = pc.list_parent_indices(keys).to_numpy().astype(np.int64)
            at = np.arange(len(row)) - np.searchsorted(row, row)  # place of the line in its document
            line = keys.flatten().take(pa.array(hit))
            same = row[hit] * (len(hit) + 1) + line.dictionary_encode().indices.to_numpy()
            new = np.zeros(len(hit), np.int64)
            new[np.unique(same, return_index=True)[1]] = 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[hit])), line, pa.array(at[hit], pa.int32()), pa.array(new)], names=["key", "line", "at", "new"])

    return suspects


def suspected_lines(docs: DataFrame, text_col: str, key: Column, bits_per_line: int, max_filter_bits: int) -> DataFrame:
    """``key, line, at, new``: lines that the filter of twice-seen lines knows; new is 1 for the first of equals in a document."""
    spark = docs.sparkSession
    lines = docs.select(key.alias("key"), F.transform(_lines(text_col), line_key).alias("lines"))
    lines = lines.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
    count = lines.agg(F.sum(F.size("lines"))).first()[0] or 0
    whole, bits = twice_filter(lines.select(F.array_distinct("hashes").alias("hashes")), count, bits_per_line, max_filter_bits)
    return lines.mapInArrow(handing_back(_suspects(spark.sparkContext.broadcast(whole), bits)), "key string, line string, at int, new long")


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_documents: int = 10, min_chars: int = 1,
    bits_per_line: int = BITS_PER_LINE, max_filter_bits: int = MAX_FILTER_BITS, result: str = "line_dedup",
) -> DataFrame:
    """All rows with ``text`` freed of shared lines, and a struct column ``n_lines, n_dropped``.

    A line whose key (blanks stripped, A-Z lower-cased) has at least ``min_chars`` code points and stands in at least
    ``min_documents`` documents goes from every document; the others stay as they are, joined by a newline. Each row counts
    as a document, repeated rows too; a line repeated in one document counts once. A NULL or empty text is one empty line
    and gives the empty text, as does a document that loses all lines. Ids may be NULL. An empty table gives no rows. Other
    columns are passed on whatever their names; one named as the result is replaced.
    """
    key = row_key(id_col, text_col)
    suspects = suspected_lines(docs, text_col, key, bits_per_line, max_filter_bits)
    suspects = written(suspects.where(F.char_length("line") >= min_chars))
    shared = suspects.groupBy("line").agg(F.count(F.lit(1)).alias("_n"), F.sum("new").alias("documents"))
    shared = written(shared.where(F.col("documents") >= min_documents).drop("documents"))
    gone = lookup(suspects, shared, ["line"], "_n", "inner").groupBy("key").agg(F.collect_list("at").alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), _lines(text_col).alias("lines")).join(gone, "key", "left")
    # array_except works by hashing, so a document of very many lines stays linear.
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    rows = rows.withColumn("places", places)
    text = F.array_join(F.transform("places", lambda i: F.col("lines")[i]), "\n")
    fields = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    counts = F.struct(F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("places")).cast("long").alias("n_dropped"))
    return with_result(rows.select(F.struct(*fields).alias("row"), counts.alias(result)), result)
