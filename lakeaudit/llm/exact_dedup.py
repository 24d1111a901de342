"""Exact deduplication by progressive refinement: length, then a hash of the head, then a hash of everything.

Each step only looks at rows whose group still has company, so the whole content is hashed for survivors alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lookup, with_result, written

#: Characters that the second step hashes.
HEAD_CHARS = 128
#: So many (size, head) groups at most are broadcast (20 bytes each); more are joined by a shuffle.
BROADCAST_GROUPS = 1 << 20


def _with_company(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key at least one other row has. Rows of a key are counted in each task before the shuffle."""
    counts = written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    return lookup(rows, counts, key, "_n", "inner")


def duplicate_members(docs: DataFrame, id_col: str, text_col: str, head_chars: int = HEAD_CHARS) -> DataFrame:
    """For each (id, content) that has equals: ``member``, ``content``, ``keep_id``, ``group_size``."""
    base = docs.select(F.col(id_col).alias("member"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.select("member", "text", F.octet_length("text").alias("size"), F.xxhash64(F.substring("text", 1, head_chars)).alias("head"))
    sketch = written(base.select("size", "head"))  # two numbers for each row: no step before the last carries texts
    same_head = _with_company(sketch, ["size"]).groupBy("size", "head").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same_head = written(same_head)
    if same_head.count() <= BROADCAST_GROUPS:
        survivors = base.join(F.broadcast(same_head), ["size", "head"], "left_semi")
    else:
        survivors = base.join(same_head.drop("_n"), ["size", "head"], "left_semi")
    whole = written(survivors.select("member", "size", F.sha2("text", 256).alias("content")))
    groups = whole.groupBy("size", "content").agg(F.count(F.lit(1)).alias("_n"), F.max("member").alias("keep_id"))
    groups = written(groups.where("_n > 1").withColumn("group_size", F.col("_n")))
    members = lookup(whole, groups, ["size", "content"], "_n", "inner")
    # An id may repeat with the same text: one fact for each (id, content), so that no row is multiplied later.
    return members.groupBy("member", "content").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_chars: int = HEAD_CHARS, result: str = "exact_dedup"
) -> DataFrame:
    """All rows with a struct column ``keep_id, group_size, kept, content``; texts are equal byte for byte.

    Of equal texts, the row with the largest id stays. ``content`` is the SHA-256 of the text in UTF-8 (hex). A NULL text
    is the empty text. NULL ids come after all others: such a row stays only if its whole group has none. Rows with equal
    id and text are counted each in ``group_size`` but share one fate, as nothing tells them apart. An empty table gives
    no rows. Other columns are passed on whatever their names; one named as the result is replaced.
    """
    facts = duplicate_members(docs, id_col, text_col, head_chars)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_col).alias("_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("_content")
    )
    joined = rows.join(facts, F.col("_id").eqNullSafe(F.col("member")) & (F.col("_content") == F.col("content")), "left")
    alone = F.col("group_size").isNull()
    verdict = F.struct(
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("_content").alias("content"),
    )
    return with_result(joined.withColumn(result, verdict), result)
