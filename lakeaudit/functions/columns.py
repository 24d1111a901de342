"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Smallest BIGINT: the image of unsigned zero under ``ordered_long``.
U64_ZERO = -(2**63)
MAX_LONG = 2**63 - 1


def ordered_long(column: Column | str) -> Column:
    """Map an unsigned 64-bit value, read as DECIMAL(20,0), onto BIGINT keeping order and equality.

    Every uint64 has exactly one image, so keys and ordinals can be grouped, sorted and shuffled as
    8-byte longs instead of 16-byte decimals, without proving a range first. Values below 2**63, that is
    practically all, take the first branch and need no decimal arithmetic.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(
        column.try_cast("bigint") + F.lit(U64_ZERO), (column - F.lit(Decimal(2**63))).cast("bigint")
    )


def unsigned(column: Column | str, zero: int) -> Column:
    """Undo ``ordered_long`` when ``zero`` is its zero; otherwise return the column unchanged."""
    column = F.col(column) if isinstance(column, str) else column
    if zero == 0:
        return column
    return (column.cast("decimal(20,0)") - F.lit(Decimal(zero))).cast("decimal(20,0)")


def all_present(columns: Sequence[Column | str]) -> Column:
    """True when no column is NULL."""
    checks = [(F.col(c) if isinstance(c, str) else c).isNotNull() for c in columns]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def exact_long(column: Column) -> Column:
    """Narrow a wide decimal total to BIGINT; a total beyond its range fails the query instead of being clamped."""
    return F.when(column > F.lit(Decimal(MAX_LONG)), F.raise_error(F.lit("a count exceeds BIGINT")).cast("bigint")).otherwise(column.cast("bigint"))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL scopes meet, as they do in a grouping. Spark plans it as a hash or merge join."""
    renamed = right.withColumnsRenamed({name: f"_on_{name}" for name in on})
    condition = reduce(lambda a, b: a & b, [left[name].eqNullSafe(renamed[f"_on_{name}"]) for name in on])
    return left.join(renamed, condition, how).drop(*[f"_on_{name}" for name in on])
