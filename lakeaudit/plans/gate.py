"""Partition gates: which files and partitions may be audited, and what is wrong with the rest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import relations
from ..operators.findings import as_findings, example_json
from ..sources.contracts import contract_frame, fields_equal
from .datasets import CONTRACT, REQUIRED_DATASETS


def file_findings(manifest: DataFrame) -> DataFrame:
    """Per-file findings: unsupported paths, unreadable footers, file names that contradict their directory."""
    file = F.col("file")
    parse = as_findings(manifest.where(F.col("layout").isNull()), "partition_parse_error", file=file, part_id=None)
    invalid = as_findings(manifest.where("NOT readable"), "invalid_parquet_file", F.col("dataset"), file=file)
    named = (F.col("file_date") != F.col("partition_date")) | ~F.col("file_hour").eqNullSafe(F.col("partition_hour"))
    misnamed = manifest.where(F.col("readable") & named)
    hourly = example_json([
        ("filename_day", F.col("file_date").cast("string")),
        ("filename_hour", F.col("file_hour")),
        ("partition_hour", F.col("partition_hour")),
    ])
    daily = example_json([("filename_day", F.col("file_date").cast("string"))])
    example = F.when(F.col("partition_hour").isNull(), daily).otherwise(hourly)
    mismatch = as_findings(misnamed, "partition_date_mismatch", F.col("dataset"), file=file, example=example)
    return parse.unionByName(invalid).unionByName(mismatch)


def gate_findings(manifest: DataFrame) -> DataFrame:
    """Findings on the composition of partitions, from readable files only."""
    files = manifest.where("readable")
    layouts = files.groupBy("part_id").agg(F.countDistinct("layout").alias("n")).where("n > 1")
    missing = relations.absent_members(files, ["part_id"], files, "dataset", REQUIRED_DATASETS)
    unknown = relations.unknown_members(files, ["part_id"], "dataset", REQUIRED_DATASETS)
    several = files.groupBy("part_id", "dataset").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    expected = contract_frame(manifest.sparkSession, CONTRACT)  # eight rows
    different = files.join(F.broadcast(expected), "dataset").where(~fields_equal("fields", "expected"))
    frames = [
        as_findings(layouts, "mixed_storage_layout_for_partition", count="n"),
        as_findings(missing, "missing_required_dataset", F.col("dataset")),
        as_findings(unknown, "unknown_dataset", F.col("dataset")),
        as_findings(several, "multiple_readable_files_for_dataset_partition", F.col("dataset"), "n"),
        as_findings(different, "schema_mismatch", F.col("dataset"), file=F.col("file")),
    ]
    return reduce(DataFrame.unionByName, frames)


# A partition with one of these is not audited any further.
GATING_RULES = (
    "missing_required_dataset",
    "multiple_readable_files_for_dataset_partition",
    "schema_mismatch",
)


def passed_partitions(manifest: DataFrame, gate: DataFrame) -> DataFrame:
    """``part_id`` of partitions whose tables can be audited."""
    held = gate.where(F.col("rule_id").isin(*GATING_RULES)).select("part_id").distinct()
    return manifest.where("readable").select("part_id").distinct().join(held, "part_id", "left_anti")


def passed_files(manifest: DataFrame, partitions: DataFrame) -> DataFrame:
    """Readable files of known datasets in those partitions: exactly one per dataset."""
    known = manifest.where(F.col("readable") & F.col("dataset").isin(list(CONTRACT)))
    return known.join(partitions, "part_id", "left_semi")
