"""The whole audit of a lake: manifest, gates, table rules, profiles, drift."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scope import part_date, part_label
from ..operators.findings import as_findings, rule_counts, rule_frame, status_counts, with_rule_defaults
from ..session import materialize
from ..sources.listing import LakeFiles
from ..sources.manifest import build_manifest
from ..sources.tables import read_tables
from . import baseline, gate, rulepack
from .baseline import Snapshots
from .datasets import CONTRACT
from .rules import RULES

ORDER = ("partition", "rule_id", "dataset", "file", "example")
FINDING_COLUMNS = ("count", "dataset", "day", "example", "file", "message", "partition", "rule_id", "severity", "status")


@dataclass(frozen=True)
class Audit:
    """Outcome of an audit, all DataFrames."""

    manifest: DataFrame
    findings: DataFrame
    snapshots: Snapshots

    def summary(self) -> DataFrame:
        """One row: scanned files and rows, reviewed partitions, findings per status, worst severity."""
        scanned = self.manifest.where("readable").agg(
            F.count(F.lit(1)).alias("scanned_files"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("scanned_rows"))
        reviewed = self.snapshots.partitions.agg(
            F.count(F.lit(1)).alias("reviewed_partition_count"),
            F.countDistinct("partition_date").alias("reviewed_day_count"),
        )
        key = F.lit(1).alias("_one")
        frames = [f.select("*", key) for f in (scanned, reviewed, status_counts(self.findings))]
        return frames[0].join(frames[1], "_one").join(frames[2], "_one").drop("_one")

    def rule_counts(self) -> DataFrame:
        return rule_counts(self.findings)

    def reviewed_partitions(self) -> DataFrame:
        """Labels of the partitions whose tables were audited, in order."""
        return self.snapshots.partitions.orderBy("part_id").select(part_label("part_id").alias("partition"))


def table_rules(
    tables: rulepack.Tables, partitions: DataFrame, files: DataFrame, verify_hashes: bool = False, any_files: bool = True
) -> tuple[DataFrame | None, Snapshots]:
    """Rule findings (None if no file passed the gate) and peer-less profiles of gated tables."""
    found = rulepack.table_findings(tables, partitions, verify_hashes) if any_files else None
    mix = materialize(baseline.mix_snapshot(tables))
    hist = materialize(baseline.measure_histogram(tables))
    summary = materialize(baseline.measure_summary(hist))
    profile = baseline.partition_snapshot(tables, partitions, files, hist, summary, mix)
    return found, Snapshots(profile, baseline.physical_snapshot(files), mix)


def finished(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Findings with catalogue defaults, labels, and all their examples."""
    labelled = with_rule_defaults(found, rule_frame(spark, RULES)).select(
        "*", part_label("part_id").alias("partition"), part_date("part_id").alias("day"))
    return labelled.select("part_id", *FINDING_COLUMNS)


def audit(
    spark: SparkSession,
    root: str,
    date_from: date | None = None,
    date_to: date | None = None,
    verify_hashes: bool = False,
    committed: Snapshots | None = None,
) -> Audit:
    """Audit every partition of a lake between two days (both inclusive, both optional).

    ``committed`` are snapshots of earlier audits that serve as additional drift peers.

    Three frames are computed once and checkpointed because many plans read them: the manifest
    (one row per file), the findings of rules and gates (a few rows per partition), and the profiles
    (one row per partition, measure and value). The large tables are only ever scanned, never held.
    """
    manifest = materialize(build_manifest(spark, root, date_from, date_to), narrow=False).coalesce(
        spark.sparkContext.defaultParallelism
    )
    gated = materialize(gate.file_findings(manifest).unionByName(gate.gate_findings(manifest)))
    partitions = materialize(gate.passed_partitions(manifest, gated))
    files = gate.passed_files(manifest, partitions)

    paths = [tuple(row) for row in files.select("dataset", "layout", "path").toLocalIterator()]
    tables = read_tables(spark, LakeFiles(spark, root).root, paths, CONTRACT, rulepack.ORDERED_COLUMNS)
    found, raw = table_rules(tables, partitions, files, verify_hashes, bool(paths))
    found = gated if found is None else materialize(gated.unionByName(found))
    statuses = with_rule_defaults(found, rule_frame(spark, RULES))
    snapshots = Snapshots(materialize(baseline.with_peer_status(raw.partitions, statuses)), raw.physical, raw.mix)

    everything = found.unionByName(baseline.profile_findings(snapshots)).unionByName(
        baseline.drift_findings(snapshots, committed))
    # Only when nothing readable matched and nothing explains why.
    nothing = manifest.agg(F.count_if("readable").alias("n")).where("n = 0").join(
        statuses.where("status <> 'metric'").limit(1), F.lit(True), "left_anti")
    everything = everything.unionByName(as_findings(nothing, "no_matching_parquet_files", part_id=None))
    return Audit(manifest, materialize(finished(spark, everything)), snapshots)
