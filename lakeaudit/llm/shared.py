"""What the corpus operators share: row keys, written tables, and joins that survive hot keys."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeing_shuffles

#: A key that holds more than one part in so many of all rows counts as hot; there are never more such keys than this.
HOT_PARTS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints").rstrip("/")


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back: its lineage is cut and lost executors cost nothing."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    with freeing_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    _folders[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read any more: all that was made of them is written itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def handing_back(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of ``mapInArrow``, which in the end gives back what Arrow's pool and the C library keep of freed memory.

    A Python worker lives on for the tasks of other steps; what it keeps adds up to theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return run


def packed(part: np.ndarray) -> bytes:
    """A part of a :class:`Packed` array, made in a task."""
    return pa.compress(part.tobytes(), codec="zstd", asbytes=True)


class Packed:
    """An array whose parts are compressed one by one, for broadcasts: the driver holds it so, only tasks unpack it.

    Filters are mostly zeros. Unpacked, the driver would hold one several times: as rows, as an array and as what is sent.
    """

    def __init__(self, parts: dict[int, bytes], each: int, size: int, kind: str):
        self.parts, self.each, self.size, self.kind = parts, each, size, kind

    def __reduce__(self):
        return Packed, (self.parts, self.each, self.size, self.kind)

    def __iter__(self) -> Iterator[np.generic]:
        return iter(self.whole)

    @functools.cached_property
    def whole(self) -> np.ndarray:
        out = np.zeros(self.size, self.kind)
        for i, part in self.parts.items():
            own = out[i * self.each : (i + 1) * self.each]
            own[:] = np.frombuffer(pa.decompress(part, decompressed_size=own.nbytes, codec="zstd"), self.kind)
        return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(*columns: str) -> Column:
    """A key that never is NULL: equal exactly for rows that agree, NULLs included, in the given columns."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def with_result(docs: DataFrame, result: str, kept: str = "row") -> DataFrame:
    """Unpack the struct of the input's columns and put the result column beside them; it replaces one of the same name."""
    names = [f.name for f in docs.schema[kept].dataType.fields if f.name.lower() != result.lower()]
    return docs.select(*[F.col(kept).getField(n).alias(n) for n in names], F.col(result))


def lookup(rows: DataFrame, facts: DataFrame, key: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join rows with facts (one per key) where a key may hold a third of the rows. Both must be cheap to read twice.

    ``weight`` of a fact is the number of rows with its key. Facts with more than one part in ``HOT_PARTS`` of all rows are
    at most ``HOT_PARTS`` many and are broadcast; the others have no large group and are joined by a shuffle. ``weight`` is
    dropped. NULL keys match nothing.
    """
    total = rows.count()
    hot = F.col(weight) * HOT_PARTS > F.lit(total)
    if not facts.where(hot).limit(1).count():
        return rows.join(facts.drop(weight), key, how)
    few = F.broadcast(facts.where(hot).drop(weight).withColumn("_hot", F.lit(True)))
    first = rows.join(few, key, "left")
    done = first.where("_hot").drop("_hot")
    rest = rows.join(F.broadcast(facts.where(hot).select(*key)), key, "left_anti").join(facts.where(~hot).drop(weight), key, how)
    return done.unionByName(rest)


#: So many keys at most are broadcast, after they were counted (8 to 40 bytes each).
BROADCAST_KEYS = 1 << 19


def without(rows: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in ``gone``, a frame of one column. Few keys are broadcast, more joined by a shuffle."""
    gone = written(gone.toDF("_gone").where("_gone IS NOT NULL").distinct())
    few = gone.count() <= BROADCAST_KEYS
    packed = rows.select(F.struct(*rows.columns).alias("row"), key.alias("_key"))
    return packed.join(F.broadcast(gone) if few else gone, F.col("_key") == F.col("_gone"), "left_anti").select("row.*")
