"""Comparing a partition with its peers: leave-one-out medians and drift verdicts.

A partition's peers are the other healthy partitions of its cohort (same hour of other days). A self
join would build days x days pairs per cohort. Instead every cohort is sorted once, and the median
without one member is read from the two middle positions of the sorted list: positions behind the
left-out member shift by one. A cohort series holds one value per day, so its window is as long as
the history has days, however large the data is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

MIN_PEERS = 3


def _identity(partition: Sequence[str], cohort: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*partition, *cohort]))


def _at(position: Column, rank: Column, value: Column, over: W) -> Column:
    return F.max(F.when(rank == position, value)).over(over)


def leave_one_out_medians(
    rows: DataFrame, cohort: Sequence[str], value: str, order: Sequence[str] = ()
) -> DataFrame:
    """Add ``peer_median`` and ``peer_values``: median and number of the other rows of the cohort."""
    group = W.partitionBy(*cohort)
    ranked = rows.withColumn("_rank", F.row_number().over(group.orderBy(value, *order))).withColumn(
        "peer_values", F.count(F.lit(1)).over(group) - 1
    )
    low = F.floor((F.col("peer_values") + 1) / 2)
    high = F.floor((F.col("peer_values") + 2) / 2)
    rank, val = F.col("_rank"), F.col(value).cast("double")
    picked = (
        ranked.withColumn("_low", low)
        .withColumn("_high", high)
        .withColumn("_a", _at(F.col("_low"), rank, val, group))
        .withColumn("_b", _at(F.col("_low") + 1, rank, val, group))
        .withColumn("_c", _at(F.col("_high"), rank, val, group))
        .withColumn("_d", _at(F.col("_high") + 1, rank, val, group))
    )
    lower = F.when(F.col("_low") < rank, F.col("_a")).otherwise(F.col("_b"))
    upper = F.when(F.col("_high") < rank, F.col("_c")).otherwise(F.col("_d"))
    return picked.withColumn("peer_median", F.when(F.col("peer_values") > 0, (lower + upper) / 2)).drop(
        "_rank", "_low", "_high", "_a", "_b", "_c", "_d"
    )


def drift_ratio(value: Column, median: Column) -> Column:
    """Larger over smaller; infinite when one of two different values is not positive."""
    positive = (value > 0) & (median > 0)
    return (
        F.when(positive, F.greatest(value, median) / F.least(value, median))
        .when(value != median, F.lit(float("inf")))
        .otherwise(F.lit(1.0))
    )


def metric_drift(
    series: DataFrame,
    partition: Sequence[str],
    cohort: Sequence[str],
    metrics: Mapping[str, tuple[float, float]],
    entity: Sequence[str] = (),
    target: str | None = None,
    min_peers: int = MIN_PEERS,
) -> DataFrame:
    """Metrics of an entity that left the range of their peers.

    ``series`` has the partition, cohort and entity columns and one column per metric, and holds
    healthy partitions only; ``target`` marks those to be judged (all if not named). ``metrics``
    maps each metric to its (ratio, difference) thresholds: a metric drifts when both are reached,
    or, against a zero median, when it is positive. Returns one row per drifting (partition, entity):
    ``drifted, metrics, metric, value, peer_median, drift_ratio``, the dominant metric being the first with the
    largest ratio.
    """
    names = list(metrics)
    identity = _identity(partition, cohort)
    long = series.unpivot(
        [F.col(c) for c in [*identity, *entity, *([target] if target else [])]],
        [F.col(n).cast("double").alias(n) for n in names],
        "metric",
        "value",
    ).where(F.col("value").isNotNull())
    judged = leave_one_out_medians(long, [*cohort, *entity, "metric"], "value", list(partition)).where(
        (F.col("peer_values") >= min_peers) & (F.col(target) if target else F.lit(True))
    )
    ratio_limit = difference_limit = position = F.lit(None).cast("double")
    for place, (name, (ratio, difference)) in enumerate(metrics.items()):
        hit = F.col("metric") == name
        ratio_limit = F.when(hit, F.lit(float(ratio))).otherwise(ratio_limit)
        difference_limit = F.when(hit, F.lit(float(difference))).otherwise(difference_limit)
        position = F.when(hit, F.lit(float(place))).otherwise(position)
    value, median = F.col("value"), F.col("peer_median")
    drifting = F.when(median == 0, value > 0).otherwise(
        (F.col("drift_ratio") >= ratio_limit) & (F.abs(value - median) >= difference_limit)
    )
    marked = (
        judged.withColumn("drift_ratio", drift_ratio(value, median))
        .where(drifting)
        .withColumn("_position", position)
    )
    # At most one row per metric in a group, so the collected lists are as short as ``metrics``.
    best = F.max_by(F.struct("metric", "value", "peer_median", "drift_ratio"), F.struct("drift_ratio", -F.col("_position")))
    return (
        marked.groupBy(*identity, *entity)
        .agg(
            F.count(F.lit(1)).alias("drifted"),
            F.sort_array(F.collect_list(F.struct("_position", "metric"))).alias("_list"),
            best.alias("_best"),
        )
        .select(
            *identity,
            *entity,
            "drifted",
            F.array_join(F.col("_list.metric"), ",").alias("metrics"),
            "_best.*",
        )
    )


def mix_drift(
    mix: DataFrame,
    partitions: DataFrame,
    partition: Sequence[str],
    cohort: Sequence[str],
    threshold: float = 0.35,
    target: str | None = None,
    min_peers: int = MIN_PEERS,
) -> DataFrame:
    """Partitions whose label shares left the median share of their peers.

    ``mix`` has (partition, cohort, label, share) with positive shares; ``partitions`` lists the healthy
    partitions with at least one label. A label a partition lacks has share zero there. Those zeros
    are never written out: they are the front of the sorted cohort list, so their number is enough.
    Returns ``drifted, label, share, peer_median, difference`` per drifting partition; the dominant
    label is the alphabetically first with the largest difference.
    """
    sizes = partitions.groupBy(*cohort).agg(F.count(F.lit(1)).alias("_members")).where(F.col("_members") > min_peers)
    identity = _identity(partition, cohort)
    judged = F.col(target) if target else F.lit(True)
    carried = [target] if target else []
    rows = mix.join(partitions.select(*identity, *carried), [*identity]).join(sizes, list(cohort))
    group = W.partitionBy(*cohort, "label")
    rank, share = F.col("_rank"), F.col("share")
    ranked = (
        rows.withColumn("_rank", F.row_number().over(group.orderBy("share", *partition)))
        .withColumn("_zeros", F.col("_members") - F.count(F.lit(1)).over(group))
        .withColumn("_low", F.floor(F.col("_members") / 2))
        .withColumn("_high", F.floor((F.col("_members") + 1) / 2))
    )

    def sorted_at(position: Column) -> Column:
        return F.when(position <= F.col("_zeros"), F.lit(0.0)).otherwise(_at(position - F.col("_zeros"), rank, share, group))

    picked = (
        ranked.withColumn("_a", sorted_at(F.col("_low")))
        .withColumn("_b", sorted_at(F.col("_low") + 1))
        .withColumn("_c", sorted_at(F.col("_high")))
        .withColumn("_d", sorted_at(F.col("_high") + 1))
    )
    place = rank + F.col("_zeros")
    lower = F.when(F.col("_low") < place, F.col("_a")).otherwise(F.col("_b"))
    upper = F.when(F.col("_high") < place, F.col("_c")).otherwise(F.col("_d"))
    having = picked.where(judged).select(*identity, "label", "share", ((lower + upper) / 2).alias("peer_median"))

    # A partition without the label: leaving out a zero moves every position by one. Such a median
    # reaches the threshold only if half of the peers give the label that much, so a cohort has at
    # most 2 / threshold of these labels.
    usual = (
        picked.where((F.col("_zeros") > 0) & ((F.col("_b") + F.col("_d")) / 2 >= threshold))
        .groupBy(*cohort, "label")
        .agg(F.first((F.col("_b") + F.col("_d")) / 2).alias("peer_median"))
    )
    lacking = (
        partitions.where(judged)
        .select(*identity)
        .join(usual, list(cohort))
        .join(mix.select(*identity, "label"), [*identity, "label"], "left_anti")
        .select(*identity, "label", F.lit(0.0).alias("share"), "peer_median")
    )
    differing = (
        having.unionByName(lacking)
        .withColumn("difference", F.abs(F.col("share") - F.col("peer_median")))
        .where(F.col("difference") >= threshold)
    )
    # Shares of a partition sum to one, so only a handful of labels can differ by the threshold.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("difference")).alias("o"), "label", "share", "peer_median", "difference")))
    return (
        differing.groupBy(*identity)
        .agg(F.count(F.lit(1)).alias("drifted"), F.element_at(ordered, 1).alias("_best"))
        .select(*identity, "drifted", "_best.label", "_best.share", "_best.peer_median", "_best.difference")
    )
