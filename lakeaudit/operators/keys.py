"""Key, dependency and ordinal checks of a single table.

All of them are plain grouped aggregates with map-side combine. Where distinct values of a group
matter, the value becomes part of a first grouping key, so even one group holding a third of the
rows is spread over the cluster before it is rolled up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .tally import tally


def duplicate_keys(
    df: DataFrame, keys: Sequence[str], scope: Sequence[str] = (), counted: str | None = None
) -> DataFrame:
    """Number of keys carried by more than one row: ``(scope..., duplicate_keys)``.

    Rows count only where ``counted`` (the first key unless named) is not NULL.
    """
    groups = df.groupBy(*scope, *keys).agg(F.count(counted or keys[0]).alias("_rows"))
    return tally(groups, scope, {"duplicate_keys": F.col("_rows") > 1})


def dependency_violations(df: DataFrame, determinant: Sequence[str], dependent: str, scope: Sequence[str] = ()) -> DataFrame:
    """Number of determinants that map to more than one value: ``(scope..., violations)``.

    ``min <> max`` equals "more than one distinct value" (both ignore NULL) and needs one shuffle.
    """
    groups = df.groupBy(*scope, *determinant).agg(F.min(dependent).alias("_low"), F.max(dependent).alias("_high"))
    return tally(groups, scope, {"violations": F.col("_low") != F.col("_high")})


def ordinal_ranges(df: DataFrame, group: Sequence[str], ordinal: str, scope: Sequence[str] = ()) -> DataFrame:
    """Smallest, largest and number of ordinals per group."""
    return df.groupBy(*scope, *group).agg(
        F.min(ordinal).alias("first_ordinal"),
        F.max(ordinal).alias("last_ordinal"),
        F.count(ordinal).alias("ordinal_count"),
    )


def has_gap() -> Column:
    """Verdict on ``ordinal_ranges``: the span differs from the row count (repeats show up too)."""
    span = F.try_subtract(F.col("last_ordinal").cast("bigint"), F.col("first_ordinal").cast("bigint"))
    return ~span.eqNullSafe(F.col("ordinal_count") - 1) & F.col("first_ordinal").isNotNull()


def starts_late(base: int = 0) -> Column:
    """Verdict on ``ordinal_ranges``: the first ordinal lies above ``base``."""
    return F.col("first_ordinal") > base


def ordinal_gaps(df: DataFrame, group: Sequence[str], ordinal: str, scope: Sequence[str] = ()) -> DataFrame:
    """Groups whose ordinals do not fill their own span: ``(scope..., groups, gap_groups)``."""
    ranges = ordinal_ranges(df, group, ordinal, scope)
    return tally(ranges, scope, {"groups": F.lit(True), "gap_groups": has_gap()})


def late_starts(df: DataFrame, group: Sequence[str], ordinal: str, scope: Sequence[str] = (), base: int = 0) -> DataFrame:
    """Groups whose first ordinal lies above ``base``: ``(scope..., late_groups)``."""
    return tally(ordinal_ranges(df, group, ordinal, scope), scope, {"late_groups": starts_late(base)})


def ordinal_groups(
    df: DataFrame,
    group: Sequence[str],
    ordinal: str,
    scope: Sequence[str] = (),
    counted: str | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per group: range, number of distinct ordinals, rows, and duplicated (group, ordinal) keys.

    Distinct ordinals come from a first grouping by (group, ordinal), which also yields the
    duplicate-key verdict of that key, so one chain serves four checks. ``counted`` names the
    column whose non-NULL values make a row count for the duplicate verdict.
    """
    cells = df.groupBy(*scope, *group, ordinal).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(counted or group[0]).alias("_counted"), *extra
    )
    present = F.col(ordinal).isNotNull()
    return cells.groupBy(*scope, *group).agg(
        F.min(ordinal).alias("first_ordinal"),
        F.max(ordinal).alias("last_ordinal"),
        F.coalesce(F.sum(F.when(present, F.col("_rows"))), F.lit(0)).alias("ordinal_count"),
        F.count(ordinal).alias("distinct_ordinals"),
        F.sum("_rows").alias("rows"),
        F.count_if(F.col("_counted") > 1).alias("duplicate_keys"),
    )


def is_ordinal_set(base: int = 0) -> Column:
    """Verdict on ``ordinal_groups``: the distinct ordinals are exactly base..base+n-1 (repeats allowed)."""
    last = F.col("distinct_ordinals") - 1 + F.lit(base)
    return (F.col("first_ordinal") == base) & (F.col("last_ordinal") == last)


def is_ordinal_list(base: int = 0) -> Column:
    """Verdict on ``ordinal_groups``: as a set, and no ordinal repeats."""
    return is_ordinal_set(base) & (F.col("distinct_ordinals") == F.col("ordinal_count"))


def nullable_ordinal_item(rows: str, ordinals: str, values: str) -> Column:
    """Verdict on non-NULL counts of an item: one row with neither ordinal nor value, or all rows with both."""
    n, no, nv = F.col(rows), F.col(ordinals), F.col(values)
    return ((no == 0) & (n == 1) & (nv == 0)) | ((no == n) & (nv == n))


def ordinal_sequences(
    df: DataFrame, group: Sequence[str], ordinal: str, scope: Sequence[str] = (), base: int = 0
) -> DataFrame:
    """Both ordinal verdicts and the duplicate count: ``(scope..., groups, bad_sets, bad_lists, duplicate_keys)``."""
    groups = ordinal_groups(df, group, ordinal, scope)
    return groups.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(~is_ordinal_set(base)).alias("bad_sets"),
        F.count_if(~is_ordinal_list(base)).alias("bad_lists"),
        F.coalesce(F.sum("duplicate_keys"), F.lit(0)).alias("duplicate_keys"),
    )
