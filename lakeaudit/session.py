"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Building the wide plans of a rule pack is twice as fast without a stack capture per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Whether the files of an execution's shuffles go when it ends, instead of when the driver happens to collect garbage.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "lakeaudit", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings every check expects (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master falls back to a private
    folder; on a cluster such a folder would be lost together with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder is None and context.master.startswith("local"):
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="lakeaudit-checkpoint-")
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written or collected within leaves no shuffle files behind, so a chain of steps needs the disk of its largest one."""
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


def materialize(frame: DataFrame, narrow: bool = True) -> DataFrame:
    """Compute a small, many times used frame once and cut its lineage in the checkpoint folder.

    ``narrow`` merges the many near-empty result partitions of a union of aggregates first; leave it
    off when the last stage itself does the work.
    """
    spark = frame.sparkSession
    checkpoint_folder(spark)
    if narrow:
        frame = frame.coalesce(spark.sparkContext.defaultParallelism)
    return frame.checkpoint(eager=True)


def settle(frame: DataFrame) -> DataFrame:
    """Write a small frame to the checkpoint folder and read it back: unlike after a checkpoint, its shuffles are off the disk."""
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    with freeing_shuffles(spark):
        frame.coalesce(spark.sparkContext.defaultParallelism).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
