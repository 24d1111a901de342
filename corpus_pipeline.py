"""From raw documents to tokens: five stages, each written and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeaudit.llm import bpe, jaccard_join, kneser_ney, line_dedup, templates
from lakeaudit.llm.queries import vocabulary_path
from lakeaudit.llm.shared import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes that Spark hands to a Python worker at a time, unless the session says otherwise: a batch is held by the JVM, outside
#: its heap, and by the worker, and 10,000 long texts or pairs of sets are many times as much.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    return kneser_ney.drop_rejected(docs, read(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    return line_dedup.drop_shared_lines(docs, min_documents=10).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word windows."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, re-parameterised or not."""
    return templates.drop_leaks(docs, read(spark, sf_dir, "benchmark"), verbatim=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of the text decoded from them."""
    out = bpe.encode_documents(docs, vocabulary_path(), fields=("n_tokens", "ids", "decoded_sha256"))
    return out.select("doc_id", "lang", "source", "bpe.n_tokens", "bpe.ids", "bpe.decoded_sha256")


def in_small_batches(stage: Stage) -> Stage:
    """The stage, for a session that hands ``BATCH_BYTES`` to a Python worker at a time. The setting stays, as results are computed later."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", in_small_batches(keep_quality)),
    ("line dedup", in_small_batches(drop_shared_lines)),
    ("n-gram Jaccard join", in_small_batches(drop_near_copies)),
    ("benchmark decontamination", in_small_batches(drop_leaks)),
    ("BPE encoding and decoding", in_small_batches(encode)),
]

#: SQL can express neither the perplexities nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
