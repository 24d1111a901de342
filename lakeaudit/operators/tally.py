"""Turning per-group verdicts into per-scope counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def tally(groups: DataFrame, scope: Sequence[str], verdicts: Mapping[str, Column]) -> DataFrame:
    """Count the groups for which each verdict holds, one row per scope (one row for no scope).

    ``count_if`` combines on the map side, so a hot scope costs each task one partial row.
    """
    return groups.groupBy(*scope).agg(*[F.count_if(cond).alias(name) for name, cond in verdicts.items()])


def totals(groups: DataFrame, scope: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sum each expression per scope; an empty input gives zeros, not NULLs."""
    return groups.groupBy(*scope).agg(
        *[F.coalesce(F.sum(expr), F.lit(0)).cast("bigint").alias(name) for name, expr in sums.items()]
    )


def long_counts(wide: DataFrame, scope: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Turn one column per check into rows ``(scope..., check, count)``."""
    return wide.unpivot([F.col(c) for c in scope], list(columns), "check", "count")
