"""Partition profiles: distributions, run lengths, label mixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from ..functions.columns import null_safe_join, unsigned

# A rank is found digit by digit, so a window never sees more than 2**DIGIT_BITS rows.
DIGIT_BITS = 16


def _attach(rows: DataFrame, per_scope: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Join one row per scope onto the rows of the scope. Without a scope that is a single row, hence the hint."""
    if scope:
        return null_safe_join(rows, per_scope, scope)
    one = per_scope.withColumn("_all", F.lit(0))
    return rows.withColumn("_all", F.lit(0)).join(F.broadcast(one), "_all").drop("_all")


def histogram(df: DataFrame, value: str, scope: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each integer value: ``(scope..., value, n)``. Combines on the map side."""
    return (
        df.select(*scope, F.col(value).cast("bigint").alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*scope, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distribution(hist: DataFrame, scope: Sequence[str] = (), zero: int = 0) -> DataFrame:
    """Exact summary of a ``histogram``: ``(scope..., count, minimum, median_value, maximum)``.

    Radix selection: counts per leading digit of 16 bits tell in which digit the middle row(s) lie, counts per second digit
    below that one, and so on; four digits make a value. Each coarser count is made from the finer one, and a scope keeps at
    most two rows from digit to digit, so neither sparse values nor a hot scope make a window long.
    """
    levels = [hist.select(*scope, F.col("value").alias("_cell"), F.col("n").alias("_n"), F.col("value").alias("_min"), F.col("value").alias("_max"))]
    for _ in range(-(-64 // DIGIT_BITS) - 1):
        upper = F.shiftright("_cell", DIGIT_BITS).alias("_cell")
        levels.append(levels[-1].groupBy(*scope, upper).agg(F.sum("_n").alias("_n"), F.min("_min").alias("_min"), F.max("_max").alias("_max")))
    *finer, top = levels
    everything = W.partitionBy(*scope) if scope else W.partitionBy(F.lit(1))
    total = F.sum("_n").over(everything)
    facts = ("_count", "_least", "_most", "_lower", "_upper")
    found = _holding_middle(top.select(
        *scope, "_cell", "_n", F.lit(0).cast("bigint").alias("_before"), total.alias("_count"), F.min("_min").over(everything).alias("_least"),
        F.max("_max").over(everything).alias("_most"), F.floor((total + 1) / 2).cast("bigint").alias("_lower"),
        F.floor((total + 2) / 2).cast("bigint").alias("_upper")), everything, scope)
    for level in reversed(finer):
        above = found.select(*scope, F.col("_cell").alias("_above"), "_before", *facts)
        above = above if scope else F.broadcast(above)  # two rows without a scope
        cells = level.select(*scope, "_cell", "_n", F.shiftright("_cell", DIGIT_BITS).alias("_above"))
        found = _holding_middle(null_safe_join(cells, above, [*scope, "_above"]), W.partitionBy(*scope, "_above"), scope)
    low = F.min(F.when(F.col("_before") + F.col("_n") >= F.col("_lower"), F.col("_cell")))
    high = F.min(F.when(F.col("_before") + F.col("_n") >= F.col("_upper"), F.col("_cell")))
    total = unsigned(low, zero).cast("decimal(20,0)") + unsigned(high, zero).cast("decimal(20,0)")
    count = F.first("_count") if scope else F.coalesce(F.first("_count"), F.lit(0))
    return found.groupBy(*scope).agg(
        count.alias("count"),
        unsigned(F.first("_least"), zero).alias("minimum"),
        (total / F.lit(2)).cast("double").alias("median_value"),
        unsigned(F.first("_most"), zero).alias("maximum"),
    )


def _holding_middle(cells: DataFrame, siblings: WindowSpec, scope: Sequence[str]) -> DataFrame:
    """The cells that hold the row(s) in the middle; ``_before`` becomes the number of the scope's rows before a cell."""
    upto = F.col("_before") + F.sum("_n").over(siblings.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = cells.select(*scope, "_cell", "_n", (upto - F.col("_n")).alias("_before"), "_count", "_least", "_most", "_lower", "_upper")
    return placed.where((F.col("_before") + F.col("_n") >= F.col("_lower")) & (F.col("_before") < F.col("_upper")))


def run_length() -> Column:
    """Span of a group on ``ordinal_ranges`` output: last - first + 1, not its row count."""
    return F.col("last_ordinal") - F.col("first_ordinal") + 1


def short_runs(
    hist: DataFrame,
    summary: DataFrame,
    scope: Sequence[str] = (),
    min_count: int = 4,
    min_median: float = 3,
    zero: int = 0,
) -> DataFrame:
    """Scopes where some runs are far shorter than the local norm.

    ``(scope..., short_runs, run_count, median_length, threshold_length)``: at least ``min_count`` runs, a median
    of at least ``min_median``, and some but not all runs no longer than half the median. ``hist`` is
    the histogram of run lengths, shifted by ``zero``, and ``summary`` its distribution.
    """
    limits = summary.where((F.col("count") >= min_count) & (F.col("median_value") >= min_median)).select(
        *scope,
        F.col("count").alias("run_count"),
        F.col("median_value").alias("median_length"),
        F.greatest(F.lit(1), F.floor(F.col("median_value") / 2)).cast("bigint").alias("threshold_length"),
    )
    return (
        _attach(hist, limits, scope).groupBy(*scope, "run_count", "median_length", "threshold_length")
        .agg(F.coalesce(F.sum(F.when(F.col("value") <= F.col("threshold_length") + F.lit(zero), F.col("n"))), F.lit(0)).alias("short_runs"))
        .where((F.col("short_runs") > 0) & (F.col("short_runs") < F.col("run_count")))
        .select(*scope, "short_runs", "run_count", "median_length", "threshold_length")
    )


def tail_only_excess(
    ranges: DataFrame, scope: Sequence[str] = (), base: int = 0, min_count: int = 3, min_share: float = 0.25
) -> DataFrame:
    """Scopes where many groups start late: ``(scope..., tail_only, group_count, tail_share)``."""
    return (
        ranges.groupBy(*scope)
        .agg(F.count_if(F.col("first_ordinal") > base).alias("tail_only"), F.count("first_ordinal").alias("group_count"))
        .withColumn("tail_share", F.col("tail_only") / F.col("group_count"))
        .where((F.col("tail_only") >= min_count) & (F.col("tail_share") >= min_share))
    )


def label_mix(df: DataFrame, label: str, scope: Sequence[str] = ()) -> DataFrame:
    """Frequency and share of each non-NULL label: ``(scope..., label, n, total, share)``."""
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy(*scope, F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sums = counts.groupBy(*scope).agg(F.sum("n").alias("total"))
    return _attach(counts, sums, scope).select(*scope, "label", "n", "total", (F.col("n") / F.col("total")).alias("share"))
