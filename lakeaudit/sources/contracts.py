"""From an exact footer contract to a Spark read schema, and footer comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Contract = Mapping[str, Sequence[tuple[str, str, bool]]]
FIELDS_TYPE = "array<struct<name:string,type:string,nullable:boolean>>"


def spark_type(arrow_type: str) -> T.DataType:
    """Spark type that reads a parquet column of this Arrow type without loss."""
    if arrow_type.startswith("fixed_size_binary") or arrow_type == "binary":
        return T.BinaryType()
    if arrow_type.startswith("timestamp[ns"):
        return T.LongType()  # nanoseconds since the epoch; Spark has no such timestamp
    if arrow_type.startswith("timestamp"):
        return T.TimestampType() if "tz=" in arrow_type else T.TimestampNTZType()
    return {
        "uint64": T.DecimalType(20, 0),
        "uint8": T.ShortType(),
        "int32": T.IntegerType(),
        "int64": T.LongType(),
        "float": T.FloatType(),
        "double": T.DoubleType(),
        "bool": T.BooleanType(),
        "string": T.StringType(),
    }[arrow_type]


def read_schema(columns: Sequence[tuple[str, str, bool]]) -> T.StructType:
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind, _ in columns])


def contract_frame(spark: SparkSession, contract: Contract) -> DataFrame:
    """One row per dataset of the contract: ``dataset, expected``."""
    rows = [(dataset, [tuple(column) for column in columns]) for dataset, columns in contract.items()]
    return spark.createDataFrame(rows, f"dataset string, expected {FIELDS_TYPE}")


def fields_equal(actual: Column | str, expected: Column | str) -> Column:
    """Ordered equality of name, type and nullability."""
    left = F.col(actual) if isinstance(actual, str) else actual
    right = F.col(expected) if isinstance(expected, str) else expected
    return left.eqNullSafe(right)


def schema_differences(manifest: DataFrame, contract: DataFrame) -> DataFrame:
    """Column-by-column report for files whose footer differs from the contract.

    ``path, dataset, position, expected, actual``; a NULL side means the column is not there.
    """
    differing = manifest.join(F.broadcast(contract), "dataset").where(~fields_equal("fields", "expected"))
    positions = F.explode(F.sequence(F.lit(0), F.greatest(F.size("fields"), F.size("expected")) - 1))
    return (
        differing.select("path", "dataset", "fields", "expected", positions.alias("position"))
        .select(
            "path",
            "dataset",
            "position",
            F.get("expected", F.col("position")).alias("expected"),
            F.get("fields", F.col("position")).alias("actual"),
        )
        .where(~F.col("expected").eqNullSafe(F.col("actual")))
    )
