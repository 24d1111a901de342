"""A trie of conversations by truncation peeling.

Each conversation is peeled in its own row: it strips its last turn until nothing is left, and what is left each time is
known by a digest chained from the first turn. Equal remains of all conversations are one node, so one shuffle finds the
nodes of all levels, however deep, and a conversation of n turns gives n + 1 rows of a fixed size.

A node belongs to its smallest member, which owns all deeper nodes of its own as well: a conversation owns its nodes from
some depth on. So it can tell each of its beginnings what it adds there: a child, the bytes of the nodes that it owns
below, and a leaf if its last node has no child. These sums, by node, are what a subtree holds, without going down it.

A turn is known by the MD5 of its role and text and by its size; no text goes further than the first step. The rows of a
node are added up in each task before they are shuffled, so that a first turn or a whole conversation that a third of all
rows share is a few rows per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lookup, written

#: Ids of one ending are joined in text blocks of at most so many ids (a power of two) before they are shuffled.
BLOCK_IDS = 1 << 12
#: Conversations of so many turns together are peeled at a time; a longer one by itself.
RUN_TURNS = 1 << 16


def conversations(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, path``: each conversation's turns in order, as ``digest, bytes``; a NULL role or text is the empty one.

    NULL orders come first; turns of one order are taken in the order of their digests. Rows without an id belong to no
    conversation. A conversation passes as one row of 24 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col(order_col).alias("at"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("turn"))
    paths = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # NULLs first
    return paths.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("path"))


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each path's beginnings, the empty one first: their chained digests, and the bytes from their last turn to the path's end."""
    for batch in batches:
        sizes = np.diff(batch.column(1).offsets.to_numpy())
        for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // RUN_TURNS)) + 1):
            part = batch.slice(rows[0], len(rows)) if len(rows) else batch
            flat, turns = part.column(1).flatten(), sizes[rows].astype(np.int64)
            digests = iter(flat.field(0).to_pylist())
            keys = []
            for n in turns.tolist():
                keys.append(key := hashlib.md5(b"").digest())
                for _ in range(n):
                    keys.append(key := hashlib.md5(key + next(digests)).digest())
            so_far = np.concatenate([[0], np.cumsum(flat.field(1).to_numpy(zero_copy_only=False))]).astype(np.int64)
            ends, bounds = np.cumsum(turns), np.concatenate([[0], np.cumsum(turns + 1)])
            depth = np.arange(bounds[-1]) - np.repeat(bounds[:-1], turns + 1)
            before = np.repeat(ends - turns, turns + 1) + np.maximum(depth, 1) - 1
            end = np.repeat(ends, turns + 1)
            rest = so_far[end] - so_far[np.minimum(before, end)]
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(keys, pa.binary())), pa.ListArray.from_arrays(offsets, pa.array(rest))],
                names=["conv_id", "path", "nodes", "rest"])


def peel(paths: DataFrame) -> DataFrame:
    """``conv_id, path, nodes, rest`` from ``conv_id, path``: a path's beginnings from the empty one on (:func:`_peel`)."""
    return paths.select("conv_id", "path").mapInArrow(
        _peel, "conv_id long, path array<struct<digest:binary,bytes:long>>, nodes array<binary>, rest array<long>")


def owners(peeled: DataFrame) -> DataFrame:
    """``conv_id, own, leaf, parent_conv_id`` of the conversations that own nodes, those that they are the smallest member of.

    They own theirs from depth ``own`` on; the node above that is ``parent_conv_id``'s. ``leaf``: their last node has no child.
    """
    rows = peeled.select("conv_id", (F.size("nodes") - 1).alias("longest"), F.posexplode("nodes").alias("depth", "node"))
    nodes = written(rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("longest").alias("longest")))
    found = nodes.groupBy("conv_id").agg(F.min("depth").alias("own"), F.max(F.col("longest") == F.col("depth")).alias("leaf"))
    found = peeled.select("conv_id", "nodes").join(found, "conv_id")
    found = written(found.select("conv_id", "own", "leaf", F.when(F.col("own") > 0, F.get("nodes", F.col("own") - 1)).alias("node")))
    above = found.where("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    above = written(above.join(nodes.select("node", F.col("conv_id").alias("parent_conv_id")), "node"))
    return written(lookup(found, above, ["node"], "_n").drop("node"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each key over its blocks, which come in order; nothing but the running digest is kept."""
    current, running = None, None
    for batch in batches:
        keys, out = [], []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key == current:
                running.update(b",")
            else:
                if running is not None:
                    keys.append(current)
                    out.append(running.hexdigest())
                current, running = key, hashlib.sha256()
            running.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], names=["node", "ends_sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.string()), pa.array([running.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def endings(peeled: DataFrame) -> DataFrame:
    """``node, ends_sha256``: for each whole path, the digest of its conversations' ids, ascending, joined by commas."""
    block = F.shiftright("conv_id", BLOCK_IDS.bit_length() - 1).alias("block")
    whole = F.hex(F.element_at("nodes", -1)).alias("node")
    blocks = peeled.select(whole, block, "conv_id").groupBy("node", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = blocks.select("node", "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    ordered = texts.repartition("node").sortWithinPartitions("node", "block").select("node", "ids")
    return ordered.mapInArrow(_digests, "node string, ends_sha256 string").withColumn("node", F.unhex("node"))


def prefix_trie(paths: DataFrame) -> DataFrame:
    """A row for each distinct beginning of ``path`` in a frame ``conv_id, path`` with one row per id.

    Gives ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL at the root), ``n_convs`` (members: all whose
    path begins so), ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (over the subtree,
    members but one times the bytes of a node's last text), ``ends_sha256`` (of the ids of members that end there,
    ascending, joined by commas; the empty text's where none does) and ``path``. The root is there as soon as there is a
    conversation; an empty path belongs to the root alone. An empty table gives no rows. The number of jobs does not depend
    on how long conversations are, and the work grows with the number of turns; only ``path``, where it is asked for, has
    24 d bytes for a node of depth d.
    """
    peeled = written(peel(paths))
    beginnings = F.posexplode(F.arrays_zip("nodes", "rest")).alias("depth", "at")
    rows = peeled.join(owners(peeled), "conv_id", "left").select("conv_id", "path", "nodes", "rest", "own", "leaf", "parent_conv_id", beginnings)
    depth, own, mine = F.col("depth"), F.col("own"), F.col("depth") >= F.col("own")
    number = lambda met: F.sum(F.when(met, 1).otherwise(0)).cast("long")
    # Every member has the bytes from here to its end; of each node below, the owner's once are not saved.
    unsaved = F.coalesce(F.get("rest", F.greatest(depth, own)), F.lit(0))
    parent = F.when(depth > own, F.col("conv_id")).otherwise(F.col("parent_conv_id"))
    nodes = rows.groupBy(F.col("at.nodes").alias("node")).agg(
        F.max(F.when(mine, F.col("conv_id"))).alias("conv_id"), F.max(depth).cast("long").alias("depth"), F.max(F.when(mine, parent)).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"), number((depth + 1 >= own) & (depth + 1 < F.size("nodes"))).alias("n_children"), number(F.col("leaf")).alias("n_leaves"),
        F.sum(F.col("at.rest") - F.when(own.isNull(), F.lit(0)).otherwise(unsaved)).alias("saved_tokens"),
        F.first(F.when(mine, F.slice("path", F.lit(1), depth)), ignorenulls=True).alias("path"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(endings(peeled), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "path")


def spliced(paths: DataFrame, group: int = 5, modulus: int = 9) -> DataFrame:
    """Conversations that share beginnings: the first h turns of conversation c - c % group, then c's own after its first h.

    h is the unsigned CRC-32 of c in decimal, modulo ``modulus``. Only beginnings of ``modulus`` - 1 turns are joined.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(modulus)).cast("int")
    rows = paths.select("conv_id", "path", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = paths.select(F.col("conv_id").alias("base"), F.slice("path", 1, modulus - 1).alias("head")).where(F.col("base") % group == 0)
    own = F.when(F.size("path") > F.col("h"), F.expr("slice(path, h + 1, size(path) - h)")).otherwise(F.slice("path", 1, 0))
    shared = F.coalesce(F.expr("slice(head, 1, h)"), F.slice("path", 1, 0))
    return rows.join(heads, "base", "left").select("conv_id", F.concat(shared, own).alias("path"))
