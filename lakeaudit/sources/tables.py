"""Reading the gated files of each dataset with the partition identity on every row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import ordered_long
from ..functions.scope import part_id
from .contracts import Contract, read_schema

_DIRECTORY_COLUMNS = {
    "date_partition": [("date", T.DateType())],
    "table_partition": [("year", T.IntegerType()), ("month", T.IntegerType()), ("day", T.IntegerType())],
    "hour_partition": [("year", T.IntegerType()), ("month", T.IntegerType()), ("day", T.IntegerType()), ("hour", T.IntegerType())],
}


def _identity(layout: str):
    if layout == "date_partition":
        return part_id(F.col("date"), F.lit(None).cast("int"))
    day = F.make_date("year", "month", "day")
    return part_id(day, F.col("hour") if layout == "hour_partition" else F.lit(None).cast("int"))


def read_tables(
    spark: SparkSession,
    root: str,
    files: Iterable[tuple[str, str, str]],
    contract: Contract,
    ordered: Sequence[str] = (),
) -> Mapping[str, DataFrame]:
    """One frame per dataset of the contract from ``(dataset, layout, path)`` of files that passed the gate.

    Directory columns come from Spark's own partition discovery, so ``part_id`` is constant per file
    and costs no path parsing per row. Columns named in ``ordered`` become order-preserving longs.
    The path list is what Spark's file index holds on the driver anyway.
    """
    grouped: dict[tuple[str, str], list[str]] = {}
    for dataset, layout, path in files:
        grouped.setdefault((dataset, layout), []).append(path)
    tables: dict[str, DataFrame] = {}
    for dataset, columns in contract.items():
        names = [name for name, _, _ in columns]
        schema = read_schema(columns)
        parts = []
        for layout, directories in _DIRECTORY_COLUMNS.items():
            paths = grouped.get((dataset, layout))
            if not paths:
                continue
            layout_schema = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in directories]])
            base = f"{root}/{dataset}" if layout == "table_partition" else root
            read = spark.read.schema(layout_schema).option("basePath", base).parquet(*sorted(paths))
            parts.append(read.select(_identity(layout).alias("part_id"), *names))
        if parts:
            frame = reduce(DataFrame.unionAll, parts)
        else:
            empty = spark.createDataFrame([], T.StructType([T.StructField("part_id", T.IntegerType()), *schema.fields]))
            frame = empty.where(F.lit(False))  # known to be empty, so Spark folds every plan over it
        tables[dataset] = frame.select(
            "part_id", *[ordered_long(n).alias(n) if n in ordered else F.col(n) for n in names]
        )
    return tables
