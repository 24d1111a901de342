"""Presence contracts: which columns must be set or NULL, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def present_cells(columns: Sequence[Column | str]) -> Column:
    """Number of non-NULL columns in the row."""
    return reduce(lambda a, b: a + b, [_col(c).isNotNull().cast("int") for c in columns])


def all_or_none(columns: Sequence[Column | str]) -> Column:
    """True when the columns are set together or NULL together."""
    return present_cells(columns).isin(0, len(columns))


def all_missing(columns: Sequence[Column | str]) -> Column:
    """True when every column is NULL."""
    return present_cells(columns) == 0


def label_contract(label: Column | str, contract: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> Column:
    """True when the row obeys ``contract[label] = (required, forbidden)``; unknown labels never do."""
    label = _col(label)
    obeyed = F.lit(False)
    for value, (required, forbidden) in contract.items():
        checks = [_col(c).isNotNull() for c in required] + [_col(c).isNull() for c in forbidden]
        obeyed = F.when(label == value, reduce(lambda a, b: a & b, checks, F.lit(True))).otherwise(obeyed)
    return obeyed


def slots_match_count(count: Column | str, slots: Sequence[Column | str]) -> Column:
    """True when slot i (1-based) is set exactly if ``count >= i``."""
    count = _col(count)
    return reduce(
        lambda a, b: a & b,
        [(count >= position) == _col(slot).isNotNull() for position, slot in enumerate(slots, start=1)],
    )


def code_matches_label(code: Column | str, label: Column | str, mapping: Mapping[int | str, str]) -> Column:
    """True when ``label`` is the mapped text of ``code``; an unknown code maps to NULL."""
    expected = F.lit(None).cast("string")
    for key, text in mapping.items():
        expected = F.when(_col(code) == F.lit(key), F.lit(text)).otherwise(expected)
    return expected.eqNullSafe(_col(label))


def prefix_matches(declared_length: Column | str, payload: Column | str, prefix: Column | str, width: int) -> Column:
    """True when ``prefix`` holds the first bytes of ``payload``, or is NULL for payloads declared shorter."""
    return F.when(_col(declared_length) < width, _col(prefix).isNull()).otherwise(
        _col(prefix).eqNullSafe(F.substring(_col(payload), 1, width))
    )


def timestamp_in_partition(ts: Column | str, day: Column, hour: Column) -> Column:
    """True when the wall-clock time lies in the partition's day and, where there is one, its hour."""
    ts = _col(ts)
    return (F.to_date(ts) == day) & (hour.isNull() | (F.hour(ts) == hour))


def instant_in_partition(instant: Column | str, day: Column, hour: Column) -> Column:
    """As ``timestamp_in_partition`` for an instant, read in UTC whatever the session time zone is."""
    seconds = F.unix_seconds(_col(instant))
    in_day = F.floor(seconds / 86400) == F.unix_date(day)
    return F.when(hour.isNull(), in_day).otherwise(F.floor(seconds / 3600) == F.unix_date(day) * 24 + hour)
