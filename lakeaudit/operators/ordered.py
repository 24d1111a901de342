"""Order checks: a value that moves backward along an ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from .tally import tally


def backward_groups(
    df: DataFrame,
    group: Sequence[str],
    ordinal: str,
    low: str,
    high: str | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Groups in which a value falls somewhere along an integer ordinal: ``(scope..., backward_groups)``.

    Equal neighbours are fine; rows sharing an ordinal count as sorted by value. ``low``/``high`` may
    be a value range per row (``high`` defaults to ``low``).

    1. Rows collapse to (group, ordinal) with the smallest and largest value: unique ordinals.
    2. These are range-partitioned along group and ordinal and compared inside each range, so a group with a third of all
       rows is many ranges of a like size, however sparse its ordinals are.
    3. The first and last value of each range are compared across the ranges of the group, one row per group and range.
    """
    high = high or low
    points = (
        df.select(*scope, *group, F.col(ordinal).cast("bigint").alias("_ord"), F.col(low).alias("_low"), F.col(high).alias("_high"))
        .where(F.col("_ord").isNotNull())
        .groupBy(*scope, *group, "_ord")
        .agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    )
    # Equal keys are one row by now, and adaptive execution merges neighbouring ranges only.
    points = points.repartitionByRange(*scope, *group, "_ord").withColumn("_run", F.spark_partition_id())
    inside = W.partitionBy(*scope, *group, "_run").orderBy("_ord")
    runs = (
        points.withColumn("_falls", F.col("_low") < F.lag("_high").over(inside))
        .groupBy(*scope, *group, "_run")
        .agg(
            F.coalesce(F.bool_or("_falls"), F.lit(False)).alias("_falls"),
            F.min_by("_low", "_ord").alias("_first"),
            F.max_by("_high", "_ord").alias("_last"),
        )
    )
    across = W.partitionBy(*scope, *group).orderBy("_run")
    groups = (
        runs.withColumn("_falls", F.col("_falls") | F.coalesce(F.col("_first") < F.lag("_last").over(across), F.lit(False)))
        .groupBy(*scope, *group)
        .agg(F.bool_or("_falls").alias("_falls"))
    )
    return tally(groups, scope, {"backward_groups": F.col("_falls")})


def backward_children(
    ordered: DataFrame,
    valued: DataFrame,
    group: Sequence[str],
    link: str,
    ordinal: str,
    value: str,
    scope: Sequence[str] = (),
) -> DataFrame:
    """As ``backward_groups`` where ordinal and value live in two tables linked by (group, link).

    Of all rows sharing a link, only the extreme ordinals and the extreme values can take part in a
    fall: one exists between two links exactly if it exists between the smallest ordinal of one and
    the largest of the other. So each link becomes at most two points, by a tagged union instead of
    a join, and repeated links cannot multiply.
    """
    keys = [*scope, *group, link]
    left = ordered.select(*keys, F.col(ordinal).cast("bigint").alias("_ord"))
    right = valued.select(*keys, F.col(value).alias("_value"))
    links = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.min("_ord").alias("_from"),
            F.max("_ord").alias("_to"),
            F.min("_value").alias("_low"),
            F.max("_value").alias("_high"),
        )
        .where(F.col("_from").isNotNull() & F.col("_low").isNotNull() & F.col(link).isNotNull())
    )
    points = links.select(*scope, *group, F.explode(F.array_distinct(F.array("_from", "_to"))).alias("_point"), "_low", "_high")
    return backward_groups(points, group, "_point", "_low", "_high", scope)
