"""Running reviews: one audited day per step, with its state committed last.

Everything a run produced lives under ``<working>/runs/<run_id>``: findings, summary, reviewed days and
snapshots. A run counts only once its row is in ``<working>/commits``; readers take state from the
newest committed run, so a run that died half way leaves no trace in it.

Commits are numbered, and the file of a number can be created once only. Of two writers that started
from the same state, the second one finds its number taken, rereads the state and decides anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.audit import Audit, audit
from ..plans.baseline import SNAPSHOT_SCHEMAS, Snapshots
from ..sinks.report import markdown, summary_payload, write_findings, write_text
from ..sources.manifest import discover_days, layout_errors
from ..sources.records import DecodingError, read_records, schema_problems
from . import review

COMMIT_SCHEMA = "sequence bigint NOT NULL, run_id string NOT NULL, latest_reviewed_day date, snapshots_run_id string"
REVIEWED_SCHEMA = "partition_date date NOT NULL"


class ReviewStateError(ValueError):
    """The lake layout or the stored review state contradicts itself."""


class Days(NamedTuple):
    """Where a review stands. ``expired`` days were never reviewed and are too old for the window."""

    found: int
    pending: int
    expired: int
    oldest_expired: date | None
    blocked: date | None
    latest: date | None


class Step(NamedTuple):
    """One review step: its state, the folder of its results, and what the audit's summary says (empty without an audit)."""

    state: str
    folder: str
    lake: str
    days: Days
    audited: dict[str, object]

    def record(self) -> dict[str, object]:
        """The step as JSON values; the audit's own names are kept."""
        known = {"state": self.state, "folder": self.folder, "lake": self.lake, "days": self.days._asdict()}
        return json.loads(json.dumps({**known, **self.audited}, default=str))


@dataclass(frozen=True)
class ReviewState:
    sequence: int
    latest: date | None
    reviewed: DataFrame | None
    snapshots: Snapshots | None
    snapshots_run_id: str | None


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create ``folder/name`` with its whole content, unless it exists: False then, and nothing is changed.

    The text is written beside the folder's visible files first. A local file system links it to its name,
    any other one renames it without overwriting; both are one step that only one writer can do.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    target, draft = path(f"{folder}/{name}"), path(f"{folder}/_drafts/{uuid.uuid4().hex}")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf()).rename(draft, target, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)


def _snapshots(spark: SparkSession, home: str) -> Snapshots:
    """Stored snapshots, which must have the declared columns."""
    parts = {}
    for name, declared in SNAPSHOT_SCHEMAS.items():
        parts[name] = spark.read.parquet(f"{home}/{name}")
        problems = schema_problems(parts[name].schema, declared)
        if problems:
            raise ReviewStateError(f"{home}/{name}: " + "; ".join(problems))
    return Snapshots(**parts)


def load_state(spark: SparkSession, working: str) -> ReviewState:
    """State of the newest committed run; an empty state before the first.

    Records with missing, extra or retyped fields are refused, and so are two commits of one number.
    """
    if not _exists(spark, f"{working}/commits"):
        return ReviewState(0, None, None, None, None)
    try:
        commits = read_records(spark, f"{working}/commits", COMMIT_SCHEMA)
        newest, *same = commits.orderBy(F.desc("sequence")).limit(2).collect() or [None]
        if newest is None:
            return ReviewState(0, None, None, None, None)
        if same and same[0]["sequence"] == newest["sequence"]:
            raise ReviewStateError(f"commit {newest['sequence']} is stored twice")
        run = f"{working}/runs/{newest['run_id']}"
        reviewed = read_records(spark, f"{run}/reviewed_days", REVIEWED_SCHEMA)
    except DecodingError as error:
        raise ReviewStateError(str(error)) from error
    snapshots = None
    if newest["snapshots_run_id"] is not None:
        snapshots = _snapshots(spark, f"{working}/runs/{newest['snapshots_run_id']}/snapshots")
    latest = newest["latest_reviewed_day"]
    return ReviewState(newest["sequence"], latest, reviewed if latest is not None else None, snapshots, newest["snapshots_run_id"])


def _checked(state: ReviewState, newest: date | None) -> None:
    reviewed = None
    if state.reviewed is not None:
        reviewed = {row["d"] for row in state.reviewed.agg(F.max("partition_date").alias("d")).collect() if row["d"]}
    snapshot_latest = None
    if state.snapshots is not None:
        snapshot_latest = state.snapshots.partitions.agg(F.max("partition_date").alias("d")).first()["d"]
    errors = review.state_errors(newest, state.latest, reviewed, snapshot_latest)
    if errors:
        raise ReviewStateError("; ".join(errors))


def _days_of(snapshots: Snapshots, oldest: date | None, latest: date | None, include_latest: bool) -> Snapshots:
    """Snapshots of the partitions whose day lies in the window."""
    kept = review.within_days(snapshots.partitions, oldest, latest, include_latest)
    ids = kept.select("part_id")
    return Snapshots(
        kept, snapshots.physical.join(ids, "part_id", "left_semi"), snapshots.mix.join(ids, "part_id", "left_semi"))


def review_next(
    spark: SparkSession,
    root: str,
    working: str,
    max_days_back: int = review.DEFAULT_MAX_DAYS_BACK,
    verify_hashes: bool = False,
    run_time: datetime | None = None,
    days: DataFrame | None = None,
) -> Step:
    """Review the next day of a ``year=/month=/day=/hour=`` lake and commit the advanced state.

    ``days`` (``partition_date, has_files``) overrides the discovered day folders. If another writer commits
    first, the step is decided anew from what it left; its own results stay in a folder that never counts.
    """
    while True:
        step = _attempt(spark, root, working, max_days_back, verify_hashes, run_time, days)
        if step is not None:
            return step


def _attempt(spark, root, working, max_days_back, verify_hashes, run_time, days) -> Step | None:
    """One step from the state as it is now; None if another writer has committed meanwhile."""
    if max_days_back < 0:
        raise ValueError("max_days_back must not be negative")
    errors = layout_errors(spark, root)
    if errors:
        raise ReviewStateError("; ".join(errors))
    days = (discover_days(spark, root, max_days_back) if days is None else days).cache()
    try:
        state = load_state(spark, working)
        window = review.review_window(days, max_days_back).first()
        _checked(state, window["newest_day"])
        reviewed = review.resolved_reviewed(days, state.reviewed, state.latest)
        plan = review.next_review(days, reviewed, max_days_back).first()
        moment = (run_time or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H-%M-%SZ")
        run_id = f"{moment}-{state.sequence + 1:06d}-{uuid.uuid4().hex[:8]}"
        report = f"{working}/runs/{run_id}"
        old_days = review.expired_days(days, reviewed, max_days_back).first()
        standing = Days(
            window["discovered_days"], plan["pending_days"], old_days["expired_days"], old_days["oldest_expired_day"], plan["blocked_day"], state.latest)
        step = Step(plan["status"], report, root, standing, {})
        oldest, target = window["oldest_day"], plan["target_day"]
        if target is None:
            write_findings(None, f"{report}/findings", spark)
            return step if _commit(spark, working, run_id, state, state.latest, reviewed, None, step) else None
        committed = _days_of(state.snapshots, oldest, target, False) if state.snapshots is not None else None
        done = audit(spark, root, target, target, verify_hashes, committed)
        latest = target if state.latest is None else max(state.latest, target)
        audited = {k: v for k, v in summary_payload(done).items() if k != "reviewed_partitions"}
        step = step._replace(days=standing._replace(latest=latest), audited=audited)
        write_findings(done.findings, f"{report}/findings")
        kept = done.snapshots
        if state.snapshots is not None:
            old = _days_of(state.snapshots, oldest, state.latest, True)
            audited = done.snapshots.partitions.select("part_id")
            kept = old.map(lambda f: f.join(audited, "part_id", "left_anti")).zip(
                done.snapshots, lambda a, b: a.unionByName(b.select(*a.columns)))
        done_days = review.advanced_reviewed(reviewed, target)
        return step if _commit(spark, working, run_id, state, latest, done_days, kept, step) else None
    finally:
        days.unpersist()


def _commit(spark, working, run_id, state, latest, reviewed, snapshots, step: Step) -> bool:
    """Write the state of the run, then the commit row that makes it count. False if its number was taken meanwhile."""
    run = f"{working}/runs/{run_id}"
    reviewed.coalesce(1).write.mode("errorifexists").json(f"{run}/reviewed_days")
    snapshots_run = state.snapshots_run_id
    if snapshots is not None:
        snapshots_run = run_id
        for name in ("partitions", "physical", "mix"):
            getattr(snapshots, name).write.mode("errorifexists").parquet(f"{run}/snapshots/{name}")
    payload = step.record()
    write_text(spark, json.dumps(payload, sort_keys=True), f"{run}/summary")
    write_text(spark, markdown(payload, step.lake, "Lake review"), f"{run}/summary_page")
    row = {"sequence": state.sequence + 1, "run_id": run_id, "latest_reviewed_day": latest, "snapshots_run_id": snapshots_run}
    return publish(spark, f"{working}/commits", f"{state.sequence + 1:012d}.json", json.dumps(row, default=str))


def drain(spark: SparkSession, root: str, working: str, **options) -> Iterator[Step]:
    """Review day after day until nothing is left to review. Yields every step, the last one included."""
    while True:
        step = review_next(spark, root, working, **options)
        yield step
        if step.state != "validated":
            return
