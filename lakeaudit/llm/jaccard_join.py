"""Similarity join of documents by the Jaccard similarity of their n-gram sets, as a blocked sparse matrix product.

The matrix has a row per distinct set and a column per n-gram; its product with itself counts shared n-grams. Only columns
that can decide are multiplied: a set's n-grams are put in one global order, rare ones first, and as two similar sets share
so many n-grams, they must share one of the first few (the size-derived bound). The order comes from a count sketch of all
n-grams; any order gives the same result, a good one few products. Columns with many rows are cut into blocks, and each pair
of blocks is multiplied by itself, with the n-grams folded to as many columns modulo two as the sets' sizes ask for: the
folded rows of two sets differ in at most as many columns as the sets differ in n-grams, so the product bounds the overlap
from above, and pairs below what their sizes ask for are dropped at once. The overlap of the others is counted exactly.

Rows of equal sets are one row of the matrix. In crowded columns, rows are first compared with a central one; rows that are
thus known to be connected need not be compared again, so a large group of near copies costs about as many comparisons as
it has members. Blocks then give each row's closest partner first, and only where that leaves rows that can be similar but
are not connected, the remaining pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .components import components
from .line_dedup import seen_twice, twice_filter
from .shared import Packed, handing_back, lookup, packed, without, written

#: Counters of the sketch of n-gram counts: 8 MiB are broadcast, whatever the input.
COUNTERS = 1 << 20
SEGMENTS = 64
#: Members of a column's block.
BLOCK = 512
#: Bits of a folded row at most; a larger set's are folded more densely, which drops fewer pairs before they are counted.
FOLDED_BITS = 1 << 15
#: Rows of columns with more members are first compared with the column's pivot.
CROWD = 2
#: So many ids at most are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20


def _ngram_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram hashes of all texts, each set sorted, and the bounds of each text."""
    hashes, bounds = hashing.windows(*hashing.words(texts), size)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def _each_run(batches: Iterator[pa.RecordBatch], size: int):
    """Ids, digests of the sets, all n-grams and their bounds, of a few texts at a time."""
    for batch in batches:
        texts = batch.column(1)
        for first, last in hashing.runs(texts):
            hashes, bounds = _ngram_sets(texts.slice(first, last - first), size)
            digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield batch.column(0).slice(first, last - first), np.frombuffer(b"".join(digests), np.int64), hashes, bounds


def _identify(size: int):
    """Each document's set: its size and a digest; and at the end, the counts of all n-grams of the task by segment."""

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, kind = np.zeros(COUNTERS, np.int64), None
        for ids, digests, hashes, bounds in _each_run(batches, size):
            kind = ids.type
            counters += np.bincount((hashes & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            yield pa.RecordBatch.from_pydict({
                "id": ids, "n": pa.array(np.diff(bounds), pa.int64()), "set": pa.array(digests),
                "segment": pa.nulls(len(ids), pa.int32()), "counts": pa.nulls(len(ids), pa.binary()),
            })
        if kind is not None:
            parts = [x.astype(np.uint32).tobytes() for x in counters.reshape(SEGMENTS, -1)]
            yield pa.RecordBatch.from_pydict({
                "id": pa.nulls(SEGMENTS, kind), "n": pa.nulls(SEGMENTS, pa.int64()), "set": pa.nulls(SEGMENTS, pa.int64()),
                "segment": pa.array(range(SEGMENTS), pa.int32()), "counts": pa.array(parts, pa.binary()),
            })

    return identify


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[segment] = total.get(segment, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"segment": pa.array(list(total), pa.int32()), "counts": pa.array([packed(x) for x in total.values()], pa.binary())})


def _folded_bits(n: np.ndarray, percent: int) -> np.ndarray:
    """Bits of the folded rows of sets of these sizes: a power of two, six times what similar sets may differ in."""
    differ = np.maximum(1, 2 * n * (100 - percent) // (100 + percent))
    return np.minimum(FOLDED_BITS, 1 << np.maximum(6, np.ceil(np.log2(6 * differ))).astype(np.int64))


def _fold(hashes: np.ndarray, bits: int) -> bytes:
    """The set's row of the matrix modulo two, its columns folded to so many."""
    odd = np.bincount((hashes >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _prefixes(counts, size: int, percent: int):
    """The rarest n-grams of each set, one of which any similar set has among its own; and its folded row."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task gives equal sets once
        for _, digests, hashes, bounds in _each_run(batches, size):
            n = np.diff(bounds)
            text = np.repeat(np.arange(len(n)), n)
            count = counts.value.whole[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)]
            order = np.lexsort((hashes, count, text))
            # what a set of n shares with any similar one is n * percent / 100 at least; a very small one has only equal ones
            first = np.where(100 * n >= percent * (n + 1), n - -(-n * percent // 100) + 1, 0)
            keep = (np.arange(len(hashes)) - bounds[text]) < first[text]
            grams = hashes[order][keep].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(first)])
            new = [f > 0 and not (d in seen or seen.add(d)) for d, f in zip(digests.tolist(), first.tolist(), strict=True)]
            bits = _folded_bits(n, percent).tolist()
            folded = [_fold(hashes[a:b], w) if f else None for a, b, w, f in zip(bounds[:-1], bounds[1:], bits, new, strict=True)]
            rows = pa.RecordBatch.from_pydict({
                "row": pa.array(digests), "n": pa.array(n, pa.int64()), "folded": pa.array(folded, pa.binary()),
                "prefix": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams)),
            })
            yield rows.filter(pa.array(new, pa.bool_()))

    return prefixes


def _shared_columns(twice, bits: int):
    """The cells of columns that the filter of n-grams seen twice knows."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(2)
            column = prefix.flatten().to_numpy(zero_copy_only=False)
            hit = seen_twice(twice.value, bits, column.view(np.uint64))
            of = pc.list_parent_indices(prefix).to_numpy()[hit]
            row, n = (batch.column(i).to_numpy()[of] for i in (0, 1))
            yield pa.RecordBatch.from_pydict({"column": pa.array(column[hit]), "row": pa.array(row), "n": pa.array(n)})

    return shared


def _narrowed(folded: bytes, width: int) -> np.ndarray:
    """A folded row of more bytes, folded to ``width`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(folded, np.uint8).reshape(-1, width), axis=0)


def _room(n: np.ndarray, folded: list[bytes], percent: int) -> np.ndarray:
    """For all pairs of rows: in how many n-grams similar sets of their sizes may differ, less those they surely differ in.

    Pairs below zero are not similar. The product of the folded rows, as ones and minus ones, counts the columns in which
    they differ; rows of different widths are compared in the narrower one.
    """
    total = n[:, None] + n[None, :]
    ratio = np.minimum(n[:, None], n[None, :]) * 100 >= np.maximum(n[:, None], n[None, :]) * percent
    room = np.where(ratio, total - 2 * -(-total * percent // (100 + percent)), -1)
    widths = np.array([len(x) for x in folded])
    for width in np.unique(widths).tolist():
        wide = np.flatnonzero(widths >= width)
        own = np.flatnonzero(widths[wide] == width)
        signs = np.unpackbits(np.stack([_narrowed(folded[i], width) for i in wide]), axis=1).astype(np.float32) * 2 - 1
        room[np.ix_(wide[own], wide)] -= ((8 * width - signs[own] @ signs.T) / 2).astype(np.int64)
    return np.minimum(room, room.T)


def _multiply(percent: int, closest: bool):
    """Pairs of rows ``x, y`` in a block (or across two) that are not yet connected and can be similar.

    With ``closest``, each row gives one pair only; a block that has more also gives a row ``of`` without a pair.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, more = [np.zeros((0, 2), np.int64)], []
            cells = batch.column(0).flatten()
            row, n, group, block = (cells.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            folded = cells.field(4)
            offsets = batch.column(0).offsets.to_numpy() - batch.column(0).offsets[0].as_py()
            across = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, other, of in zip(offsets[:-1], offsets[1:], across, batch.column(2).to_pylist(), strict=True):
                own = group[a:b]
                if (own == own[0]).all():
                    continue
                room = _room(n[a:b], folded.slice(a, b - a).to_pylist(), percent)
                fits = (room >= 0) & (own[:, None] != own[None, :])
                if other:
                    fits &= block[a:b][:, None] != block[a:b][None, :]
                if closest and np.count_nonzero(fits) > 2:
                    best = np.where(fits, room, -1).argmax(axis=1)
                    x = np.flatnonzero(fits.any(axis=1))
                    y = best[x]
                    more.append(of)
                else:
                    x, y = np.nonzero(np.triu(fits, 1))
                found = np.stack([row[a:b][x], row[a:b][y]], axis=1)
                pairs.append(np.unique(np.sort(found, axis=1), axis=0))
            found = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_pydict({
                "x": pa.concat_arrays([pa.array(found[:, 0]), pa.nulls(len(more), pa.int64())]),
                "y": pa.concat_arrays([pa.array(found[:, 1]), pa.nulls(len(more), pa.int64())]),
                "of": pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(more, pa.int64())]),
            })

    return multiply


def _promising(percent: int):
    """Single pairs that can be similar."""

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (n, x), (m, y) = ([batch.column(i).field(f).to_pylist() for f in ("n", "folded")] for i in (2, 3))
            keep = []
            for p, q, s, t in zip(n, m, x, y, strict=True):
                width = min(len(s), len(t))
                s, t = (int.from_bytes(v if len(v) == width else _narrowed(v, width).tobytes(), "little") for v in (s, t))
                keep.append((s ^ t).bit_count() <= p + q - 2 * -(-(p + q) * percent // (100 + percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return promising


def _overlap(percent: int):
    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(same, pa.bool_()))

    return overlap


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, digests, hashes, bounds in _each_run(batches, size):
            data = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"row": pa.array(digests), "grams": pa.array(data, pa.binary())})

    return sets


class _Join:
    """One run of the join over ``id, text``. A row of the matrix is named by the digest of its set."""

    def __init__(self, base: DataFrame, size: int, percent: int):
        self.base, self.size, self.percent = base, size, percent
        kind = base.schema["id"].dataType.simpleString()
        out = written(base.mapInArrow(handing_back(_identify(size)), f"id {kind}, n long, set long, segment int, counts binary"))
        parts = out.where("segment IS NOT NULL").select("segment", "counts").repartition(SEGMENTS, "segment")
        counts = {part.segment: bytes(part.counts) for part in parts.mapInArrow(handing_back(_add), "segment int, counts binary").collect()}  # COUNTERS numbers in all
        self.counts = base.sparkSession.sparkContext.broadcast(Packed(counts, COUNTERS // SEGMENTS, COUNTERS, "int64"))
        self.docs = out.where("segment IS NULL").select("id", "n", "set")
        named = self.docs.where("n > 0 AND id IS NOT NULL")
        self.classes = written(named.groupBy("set").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("_n")))

    def cells(self) -> DataFrame:
        """``column, row, n, members`` of the columns that decide and have more than one row."""
        rows = self.base.mapInArrow(handing_back(_prefixes(self.counts, self.size, self.percent)), "row long, n long, folded binary, prefix array<long>")
        self.rows = written(rows.dropDuplicates(["row"]))
        many = self.rows.agg(F.sum(F.size("prefix"))).first()[0] or 0
        twice, bits = twice_filter(self.rows.select(F.col("prefix").alias("hashes")), many)
        cells = self.rows.select("row", "n", "prefix").mapInArrow(handing_back(_shared_columns(self.base.sparkSession.sparkContext.broadcast(twice), bits)), "column long, row long, n long")
        cells = written(cells)
        shared = written(cells.groupBy("column").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("members", F.col("_n")))
        return written(lookup(cells, shared, ["column"], "_n", "inner"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The links among candidate pairs ``a, b``: the overlap of their whole sets is counted."""
        rows = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
        ids = written(self.classes.join(rows, "set", "left_semi").select(F.col("least").alias("id")))
        texts = self.base.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
        sets = written(texts.mapInArrow(handing_back(_sets(self.size)), "row long, grams binary").dropDuplicates(["row"]))
        x, y = sets.select(F.col("row").alias("a"), F.col("grams").alias("x")), sets.select(F.col("row").alias("b"), F.col("grams").alias("y"))
        sides = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return written(sides.mapInArrow(handing_back(_overlap(self.percent)), "a long, b long"))

    def by_pivots(self, cells: DataFrame) -> DataFrame:
        """Links of the rows of crowded columns with the most central row of the column.

        That is the row with the most shared columns: what is copied has them all, an edited copy lacks some.
        """
        crowd = cells.where(F.col("members") > CROWD)
        central = crowd.groupBy("row").agg((-F.count(F.lit(1))).alias("o"))
        pivot = F.min(F.struct("o", F.xxhash64("row").alias("h"), F.col("row").alias("pivot"), F.col("n").alias("of"))).alias("p")
        pivots = crowd.join(central, "row").groupBy("column").agg(pivot, F.first("members").alias("_n"))
        pairs = lookup(crowd.drop("members"), written(pivots.select("column", "p.pivot", "p.of", "_n")), ["column"], "_n", "inner").where("row != pivot")
        pairs = pairs.where(F.least("n", "of") * 100 >= F.greatest("n", "of") * self.percent)
        pairs = written(pairs.select(F.least("row", "pivot").alias("a"), F.greatest("row", "pivot").alias("b")).distinct())
        about = F.struct("n", "folded")
        x, y = self.rows.select(F.col("row").alias("a"), about.alias("x")), self.rows.select(F.col("row").alias("b"), about.alias("y"))
        pairs = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return self.verified(written(pairs.mapInArrow(handing_back(_promising(self.percent)), "a long, b long")))

    def product(self, lists: DataFrame, closest: bool) -> DataFrame:
        """``x, y, of`` of the lists' blocks (:func:`_multiply`)."""
        cell = F.struct("row", "n", "group", F.pmod(F.xxhash64("row"), "blocks").alias("block"), "folded")
        blocks = lists.join(self.rows.drop("prefix"), "row").groupBy("of", "across").agg(F.collect_list(cell).alias("cells"))
        return written(blocks.select("cells", "across", "of").mapInArrow(handing_back(_multiply(self.percent, closest)), "x long, y long, of long"))

    def by_blocks(self, cells: DataFrame, first: DataFrame) -> DataFrame:
        """Links of rows that ``first`` does not connect: all blocks of all columns. Equal blocks are multiplied once."""
        grouped = lambda rows, known: rows.join(known.select(F.col("node").alias("row"), "component"), "row", "left").withColumn(
            "group", F.coalesce("component", "row")).drop("component")
        cells = grouped(cells, components(first))
        open_ = cells.groupBy("column").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high").select("column")
        cells = written(cells).join(written(open_), "column", "left_semi")
        blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int").alias("blocks")
        parts = cells.select("column", "row", "group", blocks)
        parts = parts.withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        lists = parts.groupBy("column", "blocks", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
        lists = lists.agg(F.sort_array(F.collect_list(F.struct("row", "group"))).alias("list")).where(F.size("list") > 1)
        lists = lists.groupBy("list", "blocks", (F.col("i") != F.col("j")).alias("across")).agg(F.count(F.lit(1)).alias("columns"))
        lists = written(lists.select(F.xxhash64("list", "blocks", "across").alias("of"), "blocks", "across", F.explode("list").alias("c")).select("*", "c.*").drop("c"))
        pairs_of = lambda found: written(found.where("y IS NOT NULL").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        found = self.product(lists, True)
        links = self.verified(pairs_of(found))
        again = written(found.where("y IS NULL").select("of").distinct())
        if not again.limit(1).count():
            return links
        rest = grouped(lists.drop("group").join(again, "of", "left_semi"), components(first.unionByName(links)))
        return links.unionByName(self.verified(pairs_of(self.product(rest, False))))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """One row ``id, n_shingles, component_id`` for each input row.

    A document's set holds its distinct windows of ``size`` words (A-Z lower-cased, split at blanks); with fewer words, all
    of them are one window; without words or text it is empty and linked with nothing. Two documents link when
    100 * shared >= percent * united. ``component_id`` is the smallest id that links reach, the own one included. Rows that
    repeat an id are one document to the links. A row without an id is linked with nothing and has a NULL component. An
    empty table gives no rows. Other columns are not looked at, whatever their names. N-grams are compared by 64-bit hashes.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    join = _Join(base, size, percent)
    cells = join.cells()
    first = join.by_pivots(cells)
    links = first.unionByName(join.by_blocks(cells, first))
    found = components(links).withColumnRenamed("node", "set")
    classes = written(join.classes.join(found, "set", "left").withColumn("component", F.coalesce("component", "set")))
    names = classes.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    facts = written(lookup(classes.withColumn("weight", F.col("_n")).drop("_n", "least"), written(names), ["component"], "_n", "inner").drop("component"))
    out = lookup(join.docs, facts, ["set"], "weight", "left")
    alone = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, but of each group of linked documents only the one with the smallest id."""
    found = jaccard_components(docs, id_col, text_col, size, percent)
    return without(docs, F.col(id_col), found.where("component_id != id").select("id"))
