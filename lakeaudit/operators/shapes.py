"""Row-level contracts: all predicates of a table in one scan and one small aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .tally import long_counts


def row_violations(df: DataFrame, checks: Mapping[str, Column], scope: Sequence[str] = ()) -> DataFrame:
    """Evaluate boolean or numeric checks per row: ``(scope..., check, count)``.

    A boolean counts the rows where it is true (NULL does not count); a number is summed, for checks
    that count cells instead of rows.
    """
    types = dict(df.select(*[expr.alias(name) for name, expr in checks.items()]).dtypes)
    aggregates = [
        (F.count_if(expr) if types[name] == "boolean" else F.coalesce(F.sum(expr).cast("bigint"), F.lit(0).cast("bigint"))).alias(name)
        for name, expr in checks.items()
    ]
    return long_counts(df.groupBy(*scope).agg(*aggregates), scope, list(checks))


def slot_coverage(df: DataFrame, slots: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Non-NULL count of each slot: ``(scope..., slot, present, total_rows)``."""
    wide = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("total_rows"), *[F.count(s).alias(s) for s in slots])
    return wide.unpivot([*scope, "total_rows"], list(slots), "slot", "present")
