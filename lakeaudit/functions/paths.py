"""Reading dataset, day and hour out of a storage path, in Catalyst.

Three layouts are supported, relative to the lake root:

* ``table_partition``: ``<dataset>/year=Y/month=M/day=D/<dataset>_YYYY-MM-DD.parquet``
* ``date_partition``: ``date=YYYY-MM-DD/<dataset>_YYYY-MM-DD.parquet``
* ``hour_partition``: ``year=Y/month=M/day=D/hour=H/<dataset>_YYYY-MM-DD_HH.parquet``

Anything else, impossible calendar days and hours outside 0..23 give no layout. Matching is strict:
directory names must spell out ``year=``, ``month=`` and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY_DIRS = r"year=(\d+)/month=(\d+)/day=(\d+)"
_FILE_DAY = r"(\d{4}-\d{2}-\d{2})"
PATTERNS = {
    "date_partition": rf"^date=([^/]+)/([^/]+)_{_FILE_DAY}\.parquet$",
    "hour_partition": rf"^{_DAY_DIRS}/hour=(\d+)/([^/]+)_{_FILE_DAY}_(\d{{2}})\.parquet$",
    "table_partition": rf"^([^/]+)/{_DAY_DIRS}/([^/]+)_{_FILE_DAY}\.parquet$",
}
_PARSED_TYPE = (
    "struct<layout:string,dataset:string,partition_date:date,partition_hour:int,file_date:date,file_hour:int>"
)


def _iso_day(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def _calendar_day(year: Column, month: Column, day: Column) -> Column:
    parts = [part.try_cast("int") for part in (year, month, day)]
    return _iso_day(F.format_string("%04d-%02d-%02d", *parts))


def parse_path(rel_path: Column | str) -> Column:
    """Struct of layout, dataset, directory day/hour and file-name day/hour; NULL if unsupported."""
    rel_path = F.col(rel_path) if isinstance(rel_path, str) else rel_path

    def group(layout: str, number: int) -> Column:
        return F.regexp_extract(rel_path, PATTERNS[layout], number)

    def parsed(layout: str, dataset: Column, day: Column, file_day: Column, hour=None, file_hour=None, extra=F.lit(True)):
        none = F.lit(None).cast("int")
        fields = [
            F.lit(layout).alias("layout"),
            dataset.alias("dataset"),
            day.alias("partition_date"),
            (none if hour is None else hour).alias("partition_hour"),
            _iso_day(file_day).alias("file_date"),
            (none if file_hour is None else file_hour).alias("file_hour"),
        ]
        valid = rel_path.rlike(PATTERNS[layout]) & day.isNotNull() & _iso_day(file_day).isNotNull() & extra
        return F.when(valid, F.struct(*fields).cast(_PARSED_TYPE))

    d, h, t = "date_partition", "hour_partition", "table_partition"
    hour = group(h, 4).try_cast("int")
    by_date = parsed(d, group(d, 2), _iso_day(group(d, 1)), group(d, 3))
    by_hour = parsed(
        h, group(h, 5), _calendar_day(group(h, 1), group(h, 2), group(h, 3)), group(h, 6),
        hour, group(h, 7).try_cast("int"), hour.between(0, 23),
    )
    by_table = parsed(
        t, group(t, 1), _calendar_day(group(t, 2), group(t, 3), group(t, 4)), group(t, 6),
        extra=(group(t, 5) == group(t, 1)) & ~group(t, 1).startswith("year="),
    )
    return F.coalesce(by_date, by_hour, by_table)
