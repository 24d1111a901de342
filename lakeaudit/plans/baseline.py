"""Partition profiles, their metric findings, and drift against peers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import U64_ZERO
from ..functions.scope import part_date, part_hour
from ..operators import drift, profile
from ..operators.findings import as_findings, example_json
from .datasets import TYPE_LABELS
from .rulepack import BLOCKS, RECEIPTS, SCOPE, TRANSACTIONS, Tables, payload_ranges

# What counts as drift or as an unusual partition.
PHYSICAL_THRESHOLDS = {
    "row_count": (1.5, 1.0),
    "file_size_bytes": (1.5, 1.0),
    "row_groups": (2.0, 2.0),
    "compression_ratio": (1.25, 0.1),
}
TYPE_SHARE_THRESHOLD = 0.35
SHORT_RUN_MIN_COUNT, SHORT_RUN_MIN_MEDIAN = 4, 3
TAIL_ONLY_MIN_COUNT, TAIL_ONLY_MIN_SHARE = 3, 0.25

MEASURES = ("payload_length", "transaction_count", "log_count", "balance_change_count", "withdrawal_count")
LABELS = tuple(TYPE_LABELS.values())



def _partition_columns() -> str:
    counts = ["tail_only", "total_transactions", *[f"{m}_count" for m in MEASURES], *[f"{x}_count" for x in LABELS]]
    ranges = [f"{m}_{part}" for m in MEASURES for part in ("min", "median", "max")]
    columns = ["part_id int", "partition_date date", "partition_hour int", *[f"{c} bigint" for c in counts]]
    columns += [f"{c} {'double' if c.endswith('median') else 'decimal(20,0)'}" for c in ranges]
    columns += [f"{c} bigint" for c in ("short_runs", "threshold_length", "empty_count")]
    return ", ".join([*columns, "empty_names string", *[f"{c} boolean" for c in ("tail_only_excess", "peer_eligible", "is_peer")]])


# The columns of stored snapshots.
SNAPSHOT_SCHEMAS = {
    "partitions": _partition_columns(),
    "physical": "part_id int, dataset string, row_count bigint, file_size_bytes bigint, row_groups bigint, "
    "compressed_bytes bigint, uncompressed_bytes bigint, compression_ratio double",
    "mix": "part_id int, label string, n bigint",
}


@dataclass(frozen=True)
class Snapshots:
    """Compact profiles in long form; small enough to keep for every audited partition.

    ``partitions``: one row per partition with the summaries, warnings and ``is_peer``;
    ``physical``: one row per partition and dataset; ``mix``: one per partition and type label.
    """

    partitions: DataFrame
    physical: DataFrame
    mix: DataFrame

    def map(self, function) -> "Snapshots":
        return Snapshots(function(self.partitions), function(self.physical), function(self.mix))

    def zip(self, other: "Snapshots", function) -> "Snapshots":
        return Snapshots(
            function(self.partitions, other.partitions),
            function(self.physical, other.physical),
            function(self.mix, other.mix),
        )


def physical_snapshot(files: DataFrame) -> DataFrame:
    """Physical facts per partition and dataset, from gated manifest rows."""
    ratio = F.when(
        (F.col("compressed_bytes") > 0) & (F.col("uncompressed_bytes") > 0),
        F.col("uncompressed_bytes") / F.col("compressed_bytes"),
    )
    return files.select(
        "part_id", "dataset", "row_count", "file_size_bytes", "row_groups", "compressed_bytes", "uncompressed_bytes",
        ratio.alias("compression_ratio"),
    )


def mix_snapshot(t: Tables) -> DataFrame:
    """Transactions per partition and type label."""
    label = F.col("transaction_type_label")
    return (
        t[TRANSACTIONS].where(label.isNotNull()).groupBy(*SCOPE, label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    )


def measure_histogram(t: Tables) -> DataFrame:
    """``part_id, measure, value, n`` for payload lengths and declared child counts, on the shifted scale."""
    length = F.col("last_ordinal").cast("decimal(20,0)") - F.col("first_ordinal").cast("decimal(20,0)") + F.lit(U64_ZERO + 1)
    lengths = payload_ranges(t).select("part_id", F.lit("payload_length").alias("measure"), length.try_cast("bigint").alias("value"))
    declared = ["transaction_count", "balance_change_count", "withdrawal_count"]
    counts = t[BLOCKS].select("part_id", *declared).unpivot("part_id", declared, "measure", "value")
    logs = t[RECEIPTS].select("part_id", F.lit("log_count").alias("measure"), F.col("log_count").alias("value"))
    values = lengths.unionByName(counts).unionByName(logs)
    return profile.histogram(values, "value", ["part_id", "measure"])


def measure_summary(hist: DataFrame) -> DataFrame:
    return profile.distribution(hist, ["part_id", "measure"], U64_ZERO)


def partition_snapshot(
    t: Tables, partitions: DataFrame, files: DataFrame, hist: DataFrame, summary: DataFrame, mix: DataFrame
) -> DataFrame:
    """One row per partition: summaries, tail-only and short-run facts, type total, empty datasets."""
    wide = summary.groupBy("part_id").agg(*[
        F.first(F.when(F.col("measure") == m, F.col(c)), ignorenulls=True).alias(f"{m}_{short}")
        for m in MEASURES
        for c, short in (("count", "count"), ("minimum", "min"), ("median_value", "median"), ("maximum", "max"))
    ])
    length = F.col("measure") == "payload_length"
    short = profile.short_runs(
        hist.where(length).drop("measure"), summary.where(length).drop("measure"), ["part_id"],
        SHORT_RUN_MIN_COUNT, SHORT_RUN_MIN_MEDIAN, U64_ZERO,
    ).select("part_id", "short_runs", "threshold_length")
    late = payload_ranges(t).groupBy(*SCOPE).agg(F.count_if(F.col("first_ordinal") > U64_ZERO).alias("tail_only"))
    types = mix.groupBy("part_id").agg(
        F.sum("n").alias("total_transactions"),
        *[F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0)).alias(f"{label}_count") for label in LABELS],
    )
    # At most one name per dataset of the contract in a group.
    empty = files.groupBy("part_id").agg(
        F.count_if(F.col("row_count") == 0).alias("empty_count"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("row_count") == 0, F.col("dataset")))), ",").alias("empty_names"),
    )
    joined = reduce(lambda a, b: a.join(b, "part_id", "left"), [partitions, wide, short, late, types, empty])
    zeros = ["tail_only", "total_transactions", *[f"{m}_count" for m in MEASURES], *[f"{label}_count" for label in LABELS]]
    return joined.select(
        "part_id",
        part_date("part_id").alias("partition_date"),
        part_hour("part_id").alias("partition_hour"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in zeros],
        *[F.col(f"{m}_{s}") for m in MEASURES for s in ("min", "median", "max")],
        "short_runs",
        "threshold_length",
        "empty_count",
        F.when(F.col("empty_names") == "", "none").otherwise(F.col("empty_names")).alias("empty_names"),
        _tail_excess().alias("tail_only_excess"),
    )


def _tail_excess() -> Column:
    tail, count = F.coalesce(F.col("tail_only"), F.lit(0)), F.coalesce(F.col("payload_length_count"), F.lit(0))
    return (tail >= TAIL_ONLY_MIN_COUNT) & (count > 0) & (tail >= TAIL_ONLY_MIN_SHARE * count)


def with_peer_status(partitions: DataFrame, table_and_file_findings: DataFrame) -> DataFrame:
    """Add ``peer_eligible`` (no fail or warn finding) and ``is_peer`` (also no unusual payloads)."""
    issues = table_and_file_findings.where(F.col("status") != "metric").where(F.col("part_id").isNotNull())
    flagged = issues.select("part_id").distinct().withColumn("_issue", F.lit(True))
    joined = partitions.join(flagged, "part_id", "left").withColumn("peer_eligible", F.col("_issue").isNull()).drop("_issue")
    return joined.withColumn("is_peer", F.col("peer_eligible") & F.col("short_runs").isNull() & ~F.col("tail_only_excess"))


def _distribution_fields(measure: str) -> list[tuple[str, Column]]:
    return [
        (f"{measure}_count", F.col(f"{measure}_count")),
        (f"{measure}_min", F.col(f"{measure}_min")),
        (f"{measure}_median", F.round(f"{measure}_median", 4)),
        (f"{measure}_max", F.col(f"{measure}_max")),
    ]


def profile_findings(snapshots: Snapshots) -> DataFrame:
    """The always-present metrics and the two warnings about unusual payloads."""
    p = snapshots.partitions
    physical = as_findings(
        snapshots.physical, "dataset_physical_stats", F.col("dataset"), "row_count",
        example=example_json([
            *[(c, F.col(c)) for c in ("row_count", "file_size_bytes", "row_groups", "compressed_bytes", "uncompressed_bytes")],
            ("compression_ratio", F.round("compression_ratio", 4)),
        ]),
    )
    runs = as_findings(
        p, "payload_run_length_distribution", BLOCKS, "payload_length_count",
        example=example_json(_distribution_fields("payload_length")),
    )
    counts = as_findings(
        p, "flashblock_child_count_distribution", BLOCKS, "transaction_count_count",
        example=example_json([field for m in MEASURES[1:] for field in _distribution_fields(m)]),
    )
    total = F.col("total_transactions")
    shares = [
        (f"{label}_share", F.when(total > 0, F.round(F.col(f"{label}_count") / total, 4)).otherwise(F.lit(0.0)))
        for label in LABELS
    ]
    mix = as_findings(
        p, "transaction_type_mix", TRANSACTIONS, "total_transactions",
        example=example_json([("total_transactions", total), *[(f"{v}_count", F.col(f"{v}_count")) for v in LABELS], *shares]),
    )
    empty = as_findings(p, "empty_dataset_count", None, "empty_count", example=example_json([("datasets", F.col("empty_names"))]))
    short = as_findings(
        p.where(F.col("short_runs").isNotNull()), "short_payload_run_length", BLOCKS, "short_runs",
        example=example_json([
            ("short_payload_count", F.col("short_runs")),
            ("median_length", F.round("payload_length_median", 4)),
            ("threshold_length", F.col("threshold_length")),
        ]),
    )
    tail = as_findings(
        p.where("tail_only_excess"), "excess_tail_only_payloads", BLOCKS, "tail_only",
        example=example_json([
            ("payload_count", F.col("payload_length_count")),
            ("tail_only_ratio", F.round(F.col("tail_only") / F.col("payload_length_count"), 4)),
        ]),
    )
    return reduce(DataFrame.unionByName, [physical, runs, counts, mix, empty, short, tail])


def drift_findings(current: Snapshots, committed: Snapshots | None = None) -> DataFrame:
    """Physical and type-mix drift of current peers-in-good-standing against all such partitions.

    A cohort is the same hour of other days (daily partitions form one cohort). Committed snapshots
    serve as peers only; a partition that is audited now replaces its committed snapshot.
    """

    def peers(s: Snapshots, judged: bool) -> DataFrame:
        hour = F.coalesce(part_hour("part_id"), F.lit(-1)).alias("cohort")
        return s.partitions.where("is_peer").select("part_id", hour, "total_transactions", F.lit(judged).alias("judged"))

    everyone, physical, mix = peers(current, True), current.physical, current.mix
    if committed is not None:
        audited = current.partitions.select("part_id")
        old = committed.map(lambda frame: frame.join(audited, "part_id", "left_anti"))
        everyone = everyone.unionByName(peers(old, False))
        physical = physical.unionByName(old.physical.select(*physical.columns))
        mix = mix.unionByName(old.mix.select(*mix.columns))
    sizes = everyone.groupBy("cohort").agg((F.count(F.lit(1)) - 1).alias("peer_count"))

    series = physical.join(everyone, "part_id")
    moved = drift.metric_drift(series, ["part_id"], ["cohort"], PHYSICAL_THRESHOLDS, ["dataset"], "judged").join(sizes, "cohort")
    scope = ("comparison_scope", F.lit("same_hour"))
    physical_rows = as_findings(
        moved, "dataset_physical_drift", F.col("dataset"), "drifted",
        example=example_json([
            ("metrics", F.col("metrics")),
            ("metric", F.col("metric")),
            *[(c, F.round(c, 4)) for c in ("value", "peer_median", "drift_ratio")],
            ("peer_count", F.col("peer_count")),
            scope,
        ]),
    )
    busy = everyone.where("total_transactions > 0")
    shares = mix.join(busy.select("part_id", "cohort", "total_transactions"), "part_id").select(
        "part_id", "cohort", "label", (F.col("n") / F.col("total_transactions")).alias("share"))
    changed = drift.mix_drift(shares, busy, ["part_id"], ["cohort"], TYPE_SHARE_THRESHOLD, "judged").join(sizes, "cohort")
    mix_rows = as_findings(
        changed, "transaction_type_mix_drift", TRANSACTIONS, "drifted",
        example=example_json([
            ("type_label", F.col("label")),
            ("share", F.round("share", 4)),
            ("peer_median_share", F.round("peer_median", 4)),
            ("difference", F.round("difference", 4)),
            ("peer_count", F.col("peer_count")),
            scope,
        ]),
    )
    return physical_rows.unionByName(mix_rows)
