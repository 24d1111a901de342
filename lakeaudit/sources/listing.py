"""Files of a lake and their footers, found and read by executors.

Where Python on the executors can open the lake's file system, a frontier of directories is expanded in rounds: every task
lists the directories it was dealt and those below them, up to a fixed number, and hands the rest back to be dealt anew. So a
small lake is one task and a large one soon keeps all busy. Files go to the result, directories to the next round, and both
stay in Spark; the driver only learns whether a round left directories. Footers are then
read as the last bytes of each file.

Every other scheme goes through Spark's own file systems: the session's parallel listing and its ``binaryFile`` source, with
the footer cut out of the content before it leaves the JVM. That reads each file once as a whole (2 GB at most, Spark's limit
for the source), which is the price of a store that only Spark can open. Both ways give the same rows but for files of no
bytes at all, which Spark's sources pass over and the frontier reports (as unreadable).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from datetime import date, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .contracts import FIELDS_TYPE

RESERVED_DIRECTORY = "tmp"
LISTING_SCHEMA = "path string, rel_path string, size bigint"
#: ``executors`` or ``spark`` decides the way by hand, for a scheme that Python knows but has no credentials for.
LISTING_CONF = "spark.lakeaudit.listing"
_FOUND_SCHEMA = "rel_path string, above array<int>, is_dir boolean, size bigint"
_FOOTER_SCHEMA = (
    "readable boolean, row_count bigint, file_size_bytes bigint, row_groups bigint, "
    f"compressed_bytes bigint, uncompressed_bytes bigint, fields {FIELDS_TYPE}"
)
#: Bytes at a file's end that are read first; most footers fit.
_FOOTER_TAIL = 1 << 16
#: Directories that a task lists before it hands the rest back.
DIRECTORIES_PER_TASK = 256
#: ``above`` of a directory below which names stand for no day.
_FREE = [-1]


class LakeFiles:
    """Directory names of a lake, through the Hadoop file system of the session (any scheme)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        home = self._path(root)
        self._fs = home.getFileSystem(conf)
        self.root = self._fs.makeQualified(home).toString().rstrip("/")
        if not self._fs.exists(home):
            raise ValueError(f"storage root does not exist: {root}")
        if not self._fs.getFileStatus(home).isDirectory():
            raise ValueError(f"storage root is not a directory: {root}")

    def children(self, directory: str) -> list[tuple[str, bool]]:
        """(name, is directory) of each entry, sorted."""
        statuses = self._fs.listStatus(self._path(directory))
        return sorted((s.getPath().getName(), s.isDirectory()) for s in statuses)


def days_of(name: str, above: tuple[int, ...]) -> tuple[date, date] | None:
    """Day range a directory name stands for below ``above`` (year, month); None if it names no range."""
    key, _, text = name.partition("=")
    try:
        if key == "date":
            return (date.fromisoformat(text),) * 2
        if not text.isdigit():
            return None
        parts = (*above, int(text))
        if key != ("year", "month", "day")[len(above)]:
            return None
        first = date(*parts, *(1,) * (3 - len(parts)))
    except (ValueError, IndexError):
        return None
    if len(parts) == 3:
        return first, first
    if len(parts) == 2:
        return first, (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)
    return first, date(first.year, 12, 31)


def below(name: str, rel_path: str, above: list[int], low: date, high: date) -> list[int] | None:
    """``above`` of a directory's entries, or None if it is to be left out.

    Left out are staging names, the root's ``tmp``, and directories that stand for days out of range. Names that stand for
    no day stay in, so that files under them still show up as unsupported paths; at the root they may be a dataset with a
    day tree of its own.
    """
    at_root = "/" not in rel_path
    if name.startswith(("_", ".")) or (at_root and name == RESERVED_DIRECTORY):
        return None
    days = None if above == _FREE else days_of(name, tuple(above))
    if days is None:
        return [] if at_root else _FREE
    if days[0] > high or days[1] < low:
        return None
    return _FREE if days[0] == days[1] else [*above, int(name.partition("=")[2])]


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    if urlsplit(root).scheme in ("", "file"):
        return pafs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(quote(root, safe=":/=@"))


def executors_can_open(spark: SparkSession, root: str) -> bool:
    """Whether Python finds a file system for the scheme (no file is touched)."""
    chosen = spark.conf.get(LISTING_CONF, None)
    if chosen in ("executors", "spark"):
        return chosen == "executors"
    try:
        _open(root)
    except (pa.ArrowException, OSError, ImportError):
        return False
    return True


def _expand(root: str, low: date, high: date, limit: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(root)
        waiting, n_listed = deque(), 0
        for batch in batches:
            waiting.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        while waiting:
            found = []
            if n_listed >= limit:
                found = [(directory, above, True, None) for directory, above in waiting]
                waiting.clear()
            else:
                directory, above = waiting.popleft()  # the upper ones first, so that what is handed back is alike
                n_listed += 1
                for entry in system.get_file_info(pafs.FileSelector(f"{base}/{directory}" if directory else base)):
                    name = entry.base_name
                    here = f"{directory}/{name}" if directory else name
                    if entry.type == pafs.FileType.Directory:
                        inside = below(name, here, above, low, high)
                        if inside is not None:
                            waiting.append((here, inside))
                    elif name.endswith(".parquet") and not name.startswith(("_", ".")):
                        found.append((here, _FREE, False, entry.size))
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.list_(pa.int32()), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["rel_path", "above", "is_dir", "size"])

    return expand


def _by_frontier(spark: SparkSession, root: str, low: date, high: date) -> DataFrame:
    tasks = 4 * spark.sparkContext.defaultParallelism
    frontier, files = spark.createDataFrame([("", [])], "rel_path string, above array<int>").coalesce(1), None
    while True:
        found = materialize(frontier.mapInArrow(_expand(root, low, high, DIRECTORIES_PER_TASK), _FOUND_SCHEMA), narrow=False)
        mine = found.where("NOT is_dir").select("rel_path", "size")
        files = mine if files is None else files.unionAll(mine)
        frontier = found.where("is_dir").select("rel_path", "above")
        if not frontier.limit(1).count():
            return files.select(F.concat(F.lit(f"{root}/"), "rel_path").alias("path"), "rel_path", "size")
        frontier = frontier.repartition(tasks)


def load_paths(files: LakeFiles, low: date, high: date) -> list[str]:
    """Directories down to the day level that Spark has to list, so that no day out of range is listed file by file."""
    kept: list[str] = []

    def visit(directory: str, above: list[int]) -> None:
        for name, is_dir in files.children(f"{files.root}/{directory}" if directory else files.root):
            here = f"{directory}/{name}" if directory else name
            if not is_dir:
                kept.extend([f"{files.root}/{here}"] if name.endswith(".parquet") and not name.startswith(("_", ".")) else [])
                continue
            inside = below(name, here, above, low, high)
            if inside == _FREE:
                kept.append(f"{files.root}/{here}")
            elif inside is not None:
                visit(here, inside)

    visit("", [])
    return kept


#: The bytes from a parquet footer's begin to the file's end, or the last eight where that can't be a footer.
_LENGTH = "cast(conv(concat_ws('', substring(hex(substring(content, -8, 4)), 7, 2), substring(hex(substring(content, -8, 4)), 5, 2), " \
    "substring(hex(substring(content, -8, 4)), 3, 2), substring(hex(substring(content, -8, 4)), 1, 2)), 16, 10) as bigint)"
_TAIL = f"substring(content, cast(-least(length, {_LENGTH} + 8) as int), cast(least(length, {_LENGTH} + 8) as int))"


def _by_spark(spark: SparkSession, files: LakeFiles, low: date, high: date) -> DataFrame:
    paths = load_paths(files, low, high)
    if not paths:
        return spark.createDataFrame([], f"{LISTING_SCHEMA}, footer binary")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(paths)
    rel_path = F.substring(F.col("path"), len(files.root) + 2, 2**31 - 1)
    return listing.select("path", rel_path.alias("rel_path"), F.col("length").alias("size"), F.expr(_TAIL).alias("footer"))


def list_files(spark: SparkSession, root: str, date_from: date | None = None, date_to: date | None = None) -> DataFrame:
    """Every parquet file of the lake with ``path, rel_path, size``, and ``footer`` where Spark has to read that too.

    Names starting with ``_`` or ``.`` are staging files by convention and are left out, as in Spark's file sources.
    """
    files = LakeFiles(spark, root)
    low, high = date_from or date.min, date_to or date.max
    if executors_can_open(spark, files.root):
        return _by_frontier(spark, files.root, low, high)
    return _by_spark(spark, files, low, high)


def _tail(path: str, size: int) -> bytes:
    """A file's last bytes, the whole footer among them, on the executor that runs the task.

    A file system that can't be opened or does not answer fails the task, which Spark tries again, and then the query: no
    file is called corrupt for that.
    """
    system, name = _open(path)
    with system.open_input_file(name) as source:
        source.seek(max(0, size - _FOOTER_TAIL))
        tail = source.read()
        wanted = int.from_bytes(tail[-8:-4], "little") + 8 if len(tail) >= 12 and tail.endswith(b"PAR1") else 0
        if len(tail) < wanted <= size:
            source.seek(size - wanted)
            tail = source.read()
    return tail


def _facts(tail: bytes, size: int) -> dict:
    """What a footer says; only bytes that were read and are no footer make a file unreadable."""
    try:
        meta = pq.read_metadata(pa.BufferReader(tail))
        fields = meta.schema.to_arrow_schema()
    except (pa.ArrowException, OSError):
        return {"readable": False}
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    chunks = [g.column(i) for g in groups for i in range(g.num_columns)]
    return {
        "readable": True,
        "row_count": meta.num_rows,
        "file_size_bytes": size,
        "row_groups": meta.num_row_groups,
        "compressed_bytes": sum(c.total_compressed_size for c in chunks),
        "uncompressed_bytes": sum(c.total_uncompressed_size for c in chunks),
        "fields": [{"name": f.name, "type": str(f.type), "nullable": f.nullable} for f in fields],
    }


def footer(path: str) -> dict:
    """Footer facts of one file on a file system that Python can open."""
    system, name = _open(path)
    size = system.get_file_info(name).size
    return _facts(_tail(path, size), size)


def _footer_reader(supported: str | None):
    kinds = {
        "readable": pa.bool_(),
        "fields": pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("nullable", pa.bool_())])),
    }
    names = ("readable", "row_count", "file_size_bytes", "row_groups", "compressed_bytes", "uncompressed_bytes", "fields")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c not in ("size", "footer")]
            paths, sizes = batch.column("path").to_pylist(), batch.column("size").to_pylist()
            tails = batch.column("footer").to_pylist() if "footer" in batch.schema.names else [None] * len(paths)
            opened = [True] * len(paths) if supported is None else batch.column(supported).is_valid().to_pylist()
            rows = zip(paths, sizes, tails, opened, strict=True)
            footers = [_facts(_tail(path, size) if tail is None else tail, size) if wanted else {} for path, size, tail, wanted in rows]
            columns = [pa.array([f.get(name) for f in footers], kinds.get(name, pa.int64())) for name in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *names])

    return read


def with_footers(files: DataFrame, supported: str | None = None) -> DataFrame:
    """Footer facts in place of ``size`` and ``footer``. Filter ``files`` first: nothing is pushed below this.

    Rows whose ``supported`` column is NULL pass through unopened.
    """
    tasks = 4 * files.sparkSession.sparkContext.defaultParallelism
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields if f.name not in ("size", "footer"))
    return files.repartition(tasks).mapInArrow(_footer_reader(supported), f"{schema}, {_FOOTER_SCHEMA}")
