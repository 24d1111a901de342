"""Parent/child checks without row-level joins.

Joining two tables to count disagreements moves every row pair of a hot key through one task.
These operators instead *union* the tables, tag each row with its source, and aggregate by key:
map-side combine collapses a hot key before the shuffle, nothing is broadcast, and no pair is ever
emitted. Numbers of joined rows come from counts (``children * parents`` of a key), and numbers of
matches from grouping by (key, value), so the difference is exactly what a join would have counted.
NULL keys match nothing, as in a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import all_present, null_safe_join, exact_long


@dataclass(frozen=True)
class Relation:
    """One side of a parent/child check.

    ``keys`` line up with the parent's keys. ``attribute`` must equal the parent's attribute.
    ``ordinal`` numbers the rows of a key from ``base``. ``declared`` is the parent column holding
    the expected number of child rows, on a scale where "none" is ``zero``; ``counted`` is the child
    column whose non-NULL values are counted (all rows if not named). ``flag`` marks rows of a
    parent that may not have children. ``weight`` names a column telling how many equal rows a row
    stands for, so that a grouping made for another check can be handed in instead of the raw rows.
    """

    name: str
    rows: DataFrame
    keys: tuple[str, ...]
    attribute: str | None = None
    ordinal: str | None = None
    base: int = 0
    declared: str | None = None
    zero: int = 0
    counted: str | None = None
    flag: Column | None = None
    weight: str | None = None


def _weighted(sides: Sequence[Relation]):
    """How to count rows that meet a condition: plainly, or by weight if any side carries one."""
    if all(side.weight is None for side in sides):
        return F.count_if
    return lambda condition: F.coalesce(F.sum(F.when(condition, F.col("_weight"))), F.lit(0))


def _weight(side: Relation) -> Column:
    return (F.lit(1) if side.weight is None else F.col(side.weight)).cast("bigint").alias("_weight")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _keys(relation: Relation) -> list[Column]:
    return [F.col(name).alias(f"_k{i}") for i, name in enumerate(relation.keys)]


def _pairs(left: str, right: str) -> Column:
    return F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(18,0)")


def _keyed(parent: Relation, children: Sequence[Relation], scope: Sequence[str], declared: bool = False) -> tuple[DataFrame, bool]:
    """One row per key from one union of all sides: rows ``_n``, flagged rows ``_f``, known attributes ``_v`` and matches ``_m``
    of each side; with ``declared`` also what ``_candidates`` needs. And whether attributes are compared."""
    sides = [parent, *children]
    key_names = [f"_k{i}" for i in range(len(parent.keys))]
    with_attribute = parent.attribute is not None and any(c.attribute for c in children)
    flagged = F.coalesce(parent.flag, F.lit(False)) if parent.flag is not None else F.lit(False)
    ranged = [i for i, c in enumerate(children, start=1) if declared and c.declared is not None and c.ordinal is not None]
    frames = []
    for position, side in enumerate(sides):
        columns = [F.col(c) for c in scope] + _keys(side) + [F.lit(position).cast("tinyint").alias("_side"), _weight(side)]
        columns.append((flagged if position == 0 else F.lit(False)).alias("_flag"))
        if with_attribute and side.attribute is not None:
            columns.append(F.col(side.attribute).alias("_attr"))
        if declared:
            columns.append((F.col(side.counted).isNotNull() if side.counted else F.lit(True)).alias("_counted"))
            columns.append((F.col(side.ordinal) if position in ranged else F.lit(None)).cast("bigint").alias("_ord"))
            if position == 0:
                columns += [F.col(children[i - 1].declared).cast("bigint").alias(f"_d{i}") for i in ranged]
        frames.append(side.rows.select(*columns))
    rows = _stack(frames)

    count = _weighted(sides)
    counts = [count(F.col("_side") == i).alias(f"_n{i}") for i in range(len(sides))]
    counts.append(count(F.col("_flag")).alias("_f"))
    sums = [F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(sides))] + [F.sum("_f").alias("_f")]
    for i, child in enumerate(children, start=1):
        mine = F.col("_side") == i
        if declared and child.declared is not None:
            counts.append(count(mine & F.col("_counted")).alias(f"_c{i}"))
            sums.append(F.sum(f"_c{i}").alias(f"_c{i}"))
        if i in ranged:
            counts += [F.min(F.when(mine, F.col("_ord"))).alias(f"_first{i}"), F.max(F.when(mine, F.col("_ord"))).alias(f"_last{i}"),
                       count(F.col(f"_d{i}") > child.zero).alias(f"_positive{i}")]
            sums += [F.min(f"_first{i}").alias(f"_first{i}"), F.max(f"_last{i}").alias(f"_last{i}"), F.sum(f"_positive{i}").alias(f"_positive{i}")]
    if not with_attribute:
        return rows.groupBy(*scope, *key_names).agg(*counts), False
    # Step 1 by (key, attribute): multiplicities of each value. Step 2 by key: totals and matches.
    cells = rows.groupBy(*scope, *key_names, "_attr").agg(*counts)
    known = F.col("_attr").isNotNull()
    sums.append(F.coalesce(F.sum(F.when(known, F.col("_n0"))), F.lit(0)).alias("_v0"))
    for i, child in enumerate(children, start=1):
        if child.attribute is not None:
            sums.append(F.coalesce(F.sum(F.when(known, F.col(f"_n{i}"))), F.lit(0)).alias(f"_v{i}"))
            sums.append(F.coalesce(F.sum(F.when(known, _pairs("_n0", f"_n{i}"))), F.lit(0)).alias(f"_m{i}"))
    return cells.groupBy(*scope, *key_names).agg(*sums), True


def _judged_key(parent: Relation, child: Relation, i: int, with_attribute: bool) -> tuple[Column, Column, Column, Column, Column]:
    """Of one key: is it an orphan, childless, repeated in the child; its mismatched and its flagged joined rows."""
    joinable, present = all_present([f"_k{j}" for j in range(len(parent.keys))]), F.col("_k0").isNotNull()
    n0, ni = F.col("_n0"), F.col(f"_n{i}")
    mismatched = F.lit(0)
    if with_attribute and child.attribute is not None:
        mismatched = F.when(joinable, _pairs("_v0", f"_v{i}") - F.col(f"_m{i}"))
    return (
        (ni > 0) & ((n0 == 0) | ~joinable), (n0 > 0) & ((ni == 0) | ~joinable), (ni > 1) & present,
        mismatched, F.when(joinable, _pairs("_f", f"_n{i}")),
    )


def key_agreement(parent: Relation, children: Sequence[Relation], scope: Sequence[str] = ()) -> DataFrame:
    """Compare key sets and attributes of a parent and its children.

    Returns ``(scope..., relation, orphan_keys, childless_keys, mismatched_rows, flagged_rows,
    duplicate_child_keys, duplicate_parent_keys)``, one row per child relation:

    * ``orphan_keys``: distinct child keys without a parent;
    * ``childless_keys``: distinct parent keys without a child;
    * ``mismatched_rows``: joined rows whose attributes differ (NULL never differs);
    * ``flagged_rows``: joined rows whose parent carries ``flag``;
    * ``duplicate_*_keys``: keys carried by more than one row of that side.
    """
    keyed, with_attribute = _keyed(parent, children, scope)
    present = F.col("_k0").isNotNull()
    aggregates: list[Column] = [F.count_if((F.col("_n0") > 1) & present).alias("_dup0")]
    for i, child in enumerate(children, start=1):
        orphan, childless, repeated, mismatched, flags = _judged_key(parent, child, i, with_attribute)
        aggregates.append(F.count_if(orphan).alias(f"_orphan{i}"))
        aggregates.append(F.count_if(childless).alias(f"_childless{i}"))
        aggregates.append(F.count_if(repeated).alias(f"_dup{i}"))
        aggregates.append(F.coalesce(F.sum(mismatched), F.lit(0)).alias(f"_mismatch{i}"))
        aggregates.append(F.coalesce(F.sum(flags), F.lit(0)).alias(f"_flagged{i}"))
    summary = keyed.groupBy(*scope).agg(*aggregates)
    per_child = [
        F.struct(
            F.lit(child.name).alias("relation"),
            F.col(f"_orphan{i}").alias("orphan_keys"),
            F.col(f"_childless{i}").alias("childless_keys"),
            exact_long(F.col(f"_mismatch{i}")).alias("mismatched_rows"),
            exact_long(F.col(f"_flagged{i}")).alias("flagged_rows"),
            F.col(f"_dup{i}").alias("duplicate_child_keys"),
            F.col("_dup0").alias("duplicate_parent_keys"),
        )
        for i, child in enumerate(children, start=1)
    ]
    return summary.select(*scope, F.inline(F.array(*per_child)))


def orphan_keys(child: Relation, parent: Relation, scope: Sequence[str] = ()) -> DataFrame:
    """Distinct child keys without a parent: ``(scope..., orphan_keys)``."""
    return key_agreement(parent, [child], scope).select(*scope, "orphan_keys")


def key_set_difference(left: Relation, right: Relation, scope: Sequence[str] = ()) -> DataFrame:
    """Size of both halves of the symmetric difference: ``(scope..., only_left, only_right)``."""
    return key_agreement(left, [right], scope).select(
        *scope, F.col("childless_keys").alias("only_left"), F.col("orphan_keys").alias("only_right")
    )


def attribute_mismatches(child: Relation, parent: Relation, scope: Sequence[str] = ()) -> DataFrame:
    """Joined rows whose attributes differ: ``(scope..., mismatched_rows)``."""
    return key_agreement(parent, [child], scope).select(*scope, "mismatched_rows")


def declared_counts(parent: Relation, children: Sequence[Relation], scope: Sequence[str] = ()) -> DataFrame:
    """Compare the child counts a parent declares with the child rows that exist.

    Returns ``(scope..., relation, count_mismatches, ordinal_mismatches)``:

    * ``count_mismatches``: parent rows whose declared count differs from the child rows of the key
      (no child counts as zero);
    * ``ordinal_mismatches``: parent rows that declare children, have some, and whose child ordinals
      do not run from ``base`` to ``base + declared - 1``. A parent without children is not counted.

    Step 1 reduces every table to one row per key. Step 2 regroups by (key, declared value), where
    the observed count is a candidate value: a parent row agrees exactly if its value meets the
    candidate. Parents that repeat a key with different declarations therefore need no special case
    and never pile up in one task.
    """
    key_names = [f"_k{i}" for i in range(len(parent.keys))]
    sides = [parent, *children]
    frames = []
    for position, side in enumerate(sides):
        columns = [F.col(c) for c in scope] + _keys(side) + [F.lit(position).cast("tinyint").alias("_side"), _weight(side)]
        if position == 0:
            columns += [
                F.col(child.declared).cast("bigint").alias(f"_d{i}")
                for i, child in enumerate(children, start=1)
                if child.ordinal is not None
            ]
        else:
            counted = F.col(side.counted).isNotNull() if side.counted else F.lit(True)
            columns.append(counted.alias("_counted"))
            if side.ordinal is not None:
                columns.append(F.col(side.ordinal).cast("bigint").alias("_ord"))
        frames.append(side.rows.select(*columns))
    rows = _stack(frames)
    if "_ord" not in rows.columns:
        rows = rows.withColumn("_ord", F.lit(None).cast("bigint"))

    count = _weighted(sides)
    aggregates: list[Column] = [count(F.col("_side") == 0).alias("_parents")]
    for i, child in enumerate(children, start=1):
        mine = F.col("_side") == i
        aggregates.append(count(mine & F.col("_counted")).alias(f"_n{i}"))
        if child.ordinal is not None:
            aggregates.append(F.min(F.when(mine, F.col("_ord"))).alias(f"_first{i}"))
            aggregates.append(F.max(F.when(mine, F.col("_ord"))).alias(f"_last{i}"))
            aggregates.append(count(F.col(f"_d{i}") > child.zero).alias(f"_positive{i}"))
    keyed = rows.groupBy(*scope, *key_names).agg(*aggregates).where(F.col("_parents") > 0)

    candidates = [F.struct(*[v.alias(k) for k, v in c.items()]) for c in _candidates(parent, children, "_n")]
    expected = keyed.select(*scope, *key_names, F.inline(F.array(*candidates))).where(F.col("_declared").isNotNull())
    return _met(_stack([_declarations(parent, children, scope), expected]), parent, children, scope)


def _candidates(parent: Relation, children: Sequence[Relation], observed_as: str) -> list[dict[str, Column]]:
    """The declarations that would be right for a key, by count and by range of ordinals."""
    joinable = all_present([f"_k{j}" for j in range(len(parent.keys))])
    candidates = []
    for i, child in enumerate(children, start=1):
        if child.declared is None:
            continue
        observed = F.when(joinable, F.col(f"{observed_as}{i}")).otherwise(F.lit(0)) + F.lit(child.zero)
        by_range = F.lit(None).cast("bigint")
        positive = F.lit(0).cast("bigint")
        if child.ordinal is not None:
            starts = joinable & (F.col(f"_first{i}") == child.base)
            by_range = F.when(starts, F.try_add(F.col(f"_last{i}"), F.lit(1 + child.zero - child.base).cast("bigint")))
            positive = F.when(joinable & F.col(f"_first{i}").isNotNull(), F.col(f"_positive{i}")).otherwise(F.lit(0))
        same = by_range.eqNullSafe(observed)
        relation = F.lit(i).cast("tinyint")
        candidates.append({"_relation": relation, "_declared": observed, "_by_count": F.lit(True), "_by_range": same,
                           "_positive": positive.cast("bigint")})
        if child.ordinal is not None:
            candidates.append({"_relation": relation, "_declared": F.when(~same, by_range), "_by_count": F.lit(False),
                               "_by_range": F.lit(True), "_positive": F.lit(0).cast("bigint")})
    return candidates


def _declarations(parent: Relation, children: Sequence[Relation], scope: Sequence[str]) -> DataFrame:
    values = [
        F.struct(F.lit(i).cast("tinyint").alias("_relation"), F.col(c.declared).cast("bigint").alias("_declared"))
        for i, c in enumerate(children, start=1)
        if c.declared is not None
    ]
    rows = parent.rows.select(*scope, *_keys(parent), _weight(parent).alias("_rows"), F.inline(F.array(*values)))
    return rows.where(F.col("_declared").isNotNull())


def _met(
    rows: DataFrame, parent: Relation, children: Sequence[Relation], scope: Sequence[str], totals: Sequence[str] = ()
) -> DataFrame:
    """Declarations against candidates per relation, and the sums of further columns."""
    key_names = [f"_k{j}" for j in range(len(parent.keys))]
    met = rows.groupBy(*scope, *key_names, "_relation", "_declared").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.coalesce(F.bool_or("_by_count"), F.lit(False)).alias("_by_count"),
        F.coalesce(F.bool_or("_by_range"), F.lit(False)).alias("_by_range"),
        F.coalesce(F.sum("_positive"), F.lit(0)).alias("_positive"),
        *[F.sum(name).alias(name) for name in totals],
    )
    zero = F.lit(None).cast("bigint")
    name = F.lit(None).cast("string")
    for i, child in enumerate(children, start=1):
        zero = F.when(F.col("_relation") == i, F.lit(child.zero).cast("bigint")).otherwise(zero)
        name = F.when(F.col("_relation") == i, F.lit(child.name)).otherwise(name)
    return (
        met.groupBy(*scope, "_relation")
        .agg(
            F.sum(F.when(~F.col("_by_count"), F.col("_rows")).otherwise(F.lit(0))).alias("count_mismatches"),
            (
                F.sum("_positive")
                - F.sum(
                    F.when(F.col("_by_range") & (F.col("_declared") > zero), F.col("_rows")).otherwise(F.lit(0))
                )
            ).alias("ordinal_mismatches"),
            *[exact_long(F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in totals],
        )
        .select(*scope, name.alias("relation"), *totals, "count_mismatches", "ordinal_mismatches")
    )


AGREEMENT = ("orphan_keys", "childless_keys", "duplicate_child_keys", "duplicate_parent_keys", "mismatched_rows", "flagged_rows")


def key_contract(parent: Relation, children: Sequence[Relation], scope: Sequence[str] = ()) -> DataFrame:
    """``key_agreement`` and ``declared_counts`` of the same key from one union: each child is read and shuffled once.

    Returns the columns of both, one row per scope and child. A child without ``declared`` has no count or ordinal mismatches,
    one without ``attribute`` no mismatched rows. What a key says about agreement travels beside its candidates, but without
    the key: tasks add it up before the shuffle.
    """
    keyed, with_attribute = _keyed(parent, children, scope, declared=True)
    types = dict.fromkeys(AGREEMENT[:4], "bigint") | dict.fromkeys(AGREEMENT[4:], "decimal(38,0)")
    none = {name: F.lit(None).cast(kind) for name, kind in types.items()}
    key_names = [f"_k{j}" for j in range(len(parent.keys))]
    no_key = {name: F.lit(None).cast(keyed.schema[name].dataType) for name in key_names}
    found = []
    for i, child in enumerate(children, start=1):
        orphan, childless, repeated, mismatched, flags = _judged_key(parent, child, i, with_attribute)
        values = (orphan, childless, repeated, (F.col("_n0") > 1) & F.col("_k0").isNotNull(), mismatched, flags)
        key = {"_relation": F.lit(i).cast("tinyint"), "_declared": F.lit(None).cast("bigint"), "_by_count": F.lit(False),
               "_by_range": F.lit(False), "_positive": F.lit(0).cast("bigint")}
        found.append(no_key | key | {name: value.cast("int").cast(types[name]) if name in AGREEMENT[:4] else value.cast(types[name])
                            for name, value in zip(AGREEMENT, values, strict=True)})
    right = [{name: F.col(name) for name in key_names} | c | none for c in _candidates(parent, children, "_c")]
    # without a parent there is nothing to declare
    wanted = F.filter(F.array(*[F.struct(*[v.alias(k) for k, v in c.items()]) for c in found + right]),
                      lambda c: c["orphan_keys"].isNotNull() | (c["_declared"].isNotNull() & (F.col("_n0") > 0)))
    rows = _stack([keyed.select(*scope, F.inline(wanted)), _declarations(parent, children, scope)])
    return _met(rows, parent, children, scope, AGREEMENT)


def absent_members(
    scopes: DataFrame, scope: Sequence[str], present: DataFrame, member: str, required: Sequence[str]
) -> DataFrame:
    """Required members a scope lacks: ``(scope..., member)``.

    The required list is a fixed array exploded next to each scope, then removed by an anti join.
    """
    wanted = scopes.select(*scope).distinct().select(*scope, F.explode(F.array(*[F.lit(r) for r in required])).alias(member))
    return null_safe_join(wanted, present.select(*scope, member).distinct(), [*scope, member], "left_anti")


def unknown_members(present: DataFrame, scope: Sequence[str], member: str, known: Sequence[str]) -> DataFrame:
    """Members of a scope outside the known list: ``(scope..., member)``."""
    return present.where(~F.col(member).isin(list(known))).select(*scope, member).distinct()
