"""The manifest: one row per parquet file with its parsed path and footer facts."""

from __future__ import annotations

from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import parse_path
from ..functions.scope import part_id
from .listing import RESERVED_DIRECTORY, LakeFiles, days_of, footer, list_files, with_footers


def build_manifest(spark: SparkSession, root: str, date_from: date | None = None, date_to: date | None = None) -> DataFrame:
    """Manifest of a lake. Files with an unsupported path have NULL ``layout`` and are never opened."""
    if date_from is not None and date_to is not None and date_from > date_to:
        raise ValueError("date_from must not lie after date_to")
    listed = list_files(spark, root, date_from, date_to).where(~F.col("rel_path").startswith(f"{RESERVED_DIRECTORY}/"))
    parsed = listed.withColumn("_parsed", parse_path("rel_path")).select(*listed.columns, "_parsed.*")
    day = F.col("partition_date")
    if date_from is not None:
        parsed = parsed.where(day.isNull() | (day >= F.lit(date_from)))
    if date_to is not None:
        parsed = parsed.where(day.isNull() | (day <= F.lit(date_to)))
    return (
        with_footers(parsed, supported="layout")
        .withColumn("part_id", F.when(F.col("layout").isNotNull(), part_id("partition_date", "partition_hour")))
        .withColumn("file", F.regexp_replace("path", "^file:/+", "/"))
    )


def _footer(path: str) -> dict:
    """Footer facts of one file. A file system that Python can't open is an error: no file is called corrupt for that."""
    try:
        return footer(path)
    except pa.ArrowInvalid as error:
        raise ValueError(f"footers of this file system can't be read: {path}") from error


def discover_days(spark: SparkSession, root: str, max_days_back: int | None = None) -> DataFrame:
    """Day folders ``year=/month=/day=`` of the lake, empty ones included: ``partition_date, has_files``.

    Folder names come from the file system (an empty folder has no file to list); which of them hold
    parquet files comes from the distributed listing, bounded to the last ``max_days_back`` days before
    the newest folder if given (of older folders it is not known: NULL).
    """
    files = LakeFiles(spark, root)
    days: list[tuple[date]] = []
    for year, is_dir in files.children(files.root):
        if not is_dir or days_of(year, ()) is None or not year.startswith("year="):
            continue
        for month, is_dir in files.children(f"{files.root}/{year}"):
            above = (int(year.partition("=")[2]),)
            if not is_dir or days_of(month, above) is None:
                continue
            for day, is_dir in files.children(f"{files.root}/{year}/{month}"):
                span = days_of(day, (*above, int(month.partition("=")[2])))
                if is_dir and span is not None:
                    days.append((span[0],))
    folders = spark.createDataFrame(days, "partition_date date")
    day_of_path = r"^year=(\d+)/month=(\d+)/day=(\d+)/"
    parts = [F.regexp_extract("rel_path", day_of_path, i).try_cast("int") for i in (1, 2, 3)]
    newest = max((d for d, in days), default=None)
    oldest = newest - timedelta(days=max_days_back) if newest and max_days_back is not None else None
    filled = (
        list_files(spark, root, date_from=oldest)
        .select(F.try_to_date(F.format_string("%04d-%02d-%02d", *parts), "yyyy-MM-dd").alias("partition_date"))
        .distinct()
        .withColumn("has_files", F.lit(True))
    )
    looked_at = F.lit(True) if oldest is None else F.col("partition_date") >= F.lit(oldest)
    known = F.when(looked_at, F.coalesce("has_files", F.lit(False)))  # NULL: older than the listing, not known
    return folders.join(filled, "partition_date", "left").withColumn("has_files", known)


def layout_errors(spark: SparkSession, root: str) -> list[str]:
    """Entries that break the strict ``year=/month=/day=`` tree a review needs (``tmp`` is allowed)."""
    files = LakeFiles(spark, root)
    errors: list[str] = []

    def visit(directory: str, above: tuple[int, ...]) -> None:
        for name, is_dir in files.children(directory):
            if not above and is_dir and name == RESERVED_DIRECTORY:
                continue
            here = f"{directory}/{name}"
            expected = ("year", "month", "day")[len(above)]
            if not is_dir or not name.startswith(f"{expected}=") or days_of(name, above) is None:
                errors.append(f"expected a {expected}= directory: {here}")
            elif len(above) < 2:
                visit(here, (*above, int(name.partition("=")[2])))

    visit(files.root, ())
    return errors
