"""Phrases of two and three words by best-first branch and bound.

A phrase grows word by word. With a = f(phrase) and the cut after the first word w, its score is at most a / f(w), as the rest
is at least as frequent as the phrase; and a phrase is at most as frequent as each of its beginnings. So f(beginning) / f(w)
bounds the score of everything that a beginning grows into. All pairs are counted; then those beginnings are expanded whose
bound reaches the score that a language's list is expected to end at, together with all triples around the pairs above that
score, which decide what is dropped. If too few phrases survive above it, the score is lowered and only what the lower one
adds is expanded, until each language's list is settled with its ties.

Words and pairs are first counted by 64-bit hashes alone; only those whose hash is frequent leave a second pass by name, and
are counted again, exactly. That, and what is expanded, is told to the counting tasks by filters of bounded size. A filter
never forgets a phrase or a beginning, and all occurrences of a phrase share theirs, so whatever is counted is counted whole;
equal hashes and a filter's errors only add counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import Ranges, joined, mix, runs
from .line_dedup import seen_twice, twice_filter
from .shared import written

#: Bytes of text whose phrases are counted together before they leave Python.
COUNT_BYTES = 1 << 20
#: So many languages at most are broadcast (a name and a number each), after they were counted.
BROADCAST_LANGS = 1 << 17
BITS_PER_PHRASE = 16
#: The list is first expected to end at its pair number 2 * top, then at number 16 * top, then nowhere.
DEPTHS = (2, 16)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK


def _string_hashes(strings: pa.Array) -> np.ndarray:
    strings = pa.concat_arrays([strings.cast(pa.large_binary())])
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[: len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    return Ranges(data).hash(bounds[:-1], bounds[1:])


def _pair_hashes(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(lang * np.uint64(0xD1B54A32D192ED03) + first * np.uint64(0xAEF17502108EF2D9) + mix(second))


class _Run:
    """The words of some texts as codes, with the piece and language of each."""

    def __init__(self, lang: pa.Array, text: pa.Array):
        data, bounds = joined(text, b"\n")
        data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == _WORD
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[start]
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
        langs = lang.dictionary_encode()
        self.words, self.code = words.dictionary, words.indices.to_numpy().astype(np.int64)
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)[np.searchsorted(bounds, start, side="right") - 1]
        self.size = max(1, len(self.words))
        self.lang_hashes = _string_hashes(self.langs)[self.lang]
        self.plain_hashes = _string_hashes(self.words)[self.code]
        self.word_hashes = mix(self.lang_hashes + mix(self.plain_hashes))

    def pair_hashes(self, places: np.ndarray) -> np.ndarray:
        return _pair_hashes(self.lang_hashes[places], self.plain_hashes[places], self.plain_hashes[places + 1])

    def counted(self, places: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Distinct phrases of ``length`` words that begin at the places: language, words and count, all exact."""
        lang, key, counts = np.unique(self.lang[places], return_inverse=True, return_counts=True)
        parts = []
        for step in range(length):
            # A key names a language and the words so far; it is made small again after each word.
            found, key, counts = np.unique(key.astype(np.int64) * self.size + self.code[places + step], return_inverse=True, return_counts=True)
            before = found // self.size
            lang, parts = lang[before], [*[p[before] for p in parts], found % self.size]
        return lang, parts, counts

    def rows(self, places: np.ndarray, length: int, columns: int) -> pa.RecordBatch:
        lang, parts, counts = self.counted(places, length)
        words = [self.words.take(pa.array(p)).cast(pa.large_string()).cast(pa.string()) for p in parts]
        words += [pa.nulls(len(counts), pa.string())] * (columns - length)
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(lang)), *words, pa.array(counts.astype(np.int64))], names=["lang", *"wxy"[:columns], "n"])

    def together(self, length: int) -> np.ndarray:
        """Places where ``length`` words of one piece begin."""
        gap = length - 1
        return np.flatnonzero(self.piece[gap:] == self.piece[: len(self.piece) - gap])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Run]:
    for batch in batches:
        for first, end in runs(batch.column(1), COUNT_BYTES):
            yield _Run(batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first))


def _count_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of words and pairs with their counts."""
    for run in _runs(batches):
        for hashes in (run.word_hashes, run.pair_hashes(run.together(2))):
            found, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["hash", "n"])


def _count_pairs(frequent):
    """Words and pairs that the filter knows, by name; and all words of a language, without one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield run.rows(np.arange(len(run.code)), 0, 2)
            yield run.rows(np.flatnonzero(seen_twice(*frequent.value, run.word_hashes)), 1, 2)
            places = run.together(2)
            yield run.rows(places[seen_twice(*frequent.value, run.pair_hashes(places))], 2, 2)

    return count


def _count_triples(begin, end):
    """Triples whose first pair the one filter knows, or whose last pair the other one does; a filter is bits by segment."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            places = run.together(3)
            wanted = seen_twice(*begin.value, run.pair_hashes(places)) | seen_twice(*end.value, run.pair_hashes(places + 1))
            yield run.rows(places[wanted], 3, 3)

    return count


def _hash_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = _pair_hashes(*(_string_hashes(batch.column(i)) for i in range(3))).view(np.int64)
        twice = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(hashes) + 1, 2, dtype=np.int32)), pa.array(np.repeat(hashes, 2)))
        yield pa.RecordBatch.from_arrays([twice], names=["hashes"])


def _filter(hashes: DataFrame, count: int):
    """A broadcast filter (64 MiB at most) of what ``hashes`` lists; it holds what was seen twice, so each is listed twice."""
    return hashes.sparkSession.sparkContext.broadcast(twice_filter(hashes, count, BITS_PER_PHRASE))


def _pair_filter(pairs: DataFrame):
    return _filter(pairs.select("lang", "w", "x").mapInArrow(_hash_pairs, "hashes array<long>"), pairs.count())


def score(a: Column | str, left: Column | str, right: Column | str) -> Column:
    """floor(1000000 a a / (left right)), exact while a is under 3e15; a decimal overflow fails the query."""
    a, left, right = ((F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def _with_lang(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Join with facts of a language, of which there is one for each."""
    few = facts.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS
    return rows.join(F.broadcast(facts) if few else facts, "lang")


def first_of_each(rows: DataFrame, key: str, order: list[Column], top: int, spread: list[str]) -> DataFrame:
    """The first rows of each key with their ``rank``: first of parts of a key, so that no task sorts a whole one."""
    parts = ceil(sqrt(max(1, rows.count()) / top))
    part = F.pmod(F.xxhash64(*spread), F.lit(parts))
    rows = rows.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)))
    rows = rows.where(F.col("rank") <= top).drop("_part", "rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= top)


def _floors(pairs: DataFrame, langs: DataFrame, place: int | None) -> DataFrame:
    """``lang, floor``: the score of the pair at that place of a language's list, 0 for shorter lists or without a place."""
    zero = F.lit(0).cast("long")
    if place is None:
        return langs.select("lang", zero.alias("floor"))
    listed = first_of_each(pairs.select("lang", "w", "x", "score"), "lang", [F.desc("score")], place, ["w", "x"])
    ends = listed.where(F.col("rank") == place).select("lang", F.col("score").alias("floor"))
    return langs.select("lang").join(ends, "lang", "left").select("lang", F.coalesce("floor", zero).alias("floor"))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10, drop_percent: int = 50, top: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of 2 to ``max_words`` (2 or 3) words.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line breaks into pieces and those at blanks and tabs into words.
    Within a language (NULL: ``und``), n counts all words and f all occurrences of a phrase within pieces, overlaps included.
    Candidates have a = f(phrase) >= ``min_count``. A cut in two parts has l and r, their counts, and a score of
    floor(1000000 a a / (l r)); the lowest cut counts, of equal ones the first. A candidate is dropped when a longer
    candidate q contains it with 100 f(q) >= ``drop_percent`` a. Order: score and a descending, phrase ascending by bytes.
    NULL and empty texts have no words; repeated rows count each; ids are not looked at. An empty table, or one without a
    candidate, gives no rows. Counts are exact; only which triples are counted is decided by hashes.
    """
    if max_words not in (2, 3):
        raise ValueError("phrases have two or three words at most")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hashes = texts.mapInArrow(_count_hashes, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    hashes = written(hashes.where(F.col("n") >= min_count).select(F.array("hash", "hash").alias("hashes")))
    known = _filter(hashes, hashes.count())
    counts = texts.mapInArrow(_count_pairs(known), "lang string, w string, x string, n long").groupBy("lang", "w", "x").agg(F.sum("n").alias("n"))
    counts = written(counts.where((F.col("n") >= min_count) | F.col("w").isNull()))
    langs = written(counts.where("w IS NULL").select("lang", "n"))
    frequent = counts.where("w IS NOT NULL AND x IS NULL").select("lang", "w", "n")
    pairs = counts.where("x IS NOT NULL").withColumnRenamed("n", "a")
    pairs = pairs.join(frequent.withColumnRenamed("n", "l"), ["lang", "w"])
    pairs = pairs.join(frequent.select("lang", F.col("w").alias("x"), F.col("n").alias("r")), ["lang", "x"])
    # A beginning's bound is the score of a phrase as frequent as the beginning and as its own rest.
    pairs = written(pairs.select("lang", "w", "x", "a", "l", "r", score("a", "l", "r").alias("score"), score("a", "l", "a").alias("bound")))
    candidates = pairs.select("lang", F.concat_ws(" ", "w", "x").alias("phrase"), "a", "l", "r", "score")
    if max_words == 3:
        candidates = _grow(spark, texts, pairs, langs, min_count, drop_percent, top)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    listed = first_of_each(candidates, "lang", order, top, ["phrase"])
    return _with_lang(listed, langs).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _grow(spark, texts: DataFrame, pairs: DataFrame, langs: DataFrame, min_count: int, drop_percent: int, top: int) -> DataFrame:
    """Candidates that are not dropped, all of them that a language's first ``top`` can hold."""
    triples, before = None, None
    for depth in (*DEPTHS, None):
        floors = _floors(pairs, langs, depth * top if depth else None)
        if before is not None:  # a settled language stays where it was
            floors = floors.join(before.select("lang", F.col("floor").alias("was"), "settled"), "lang")
            floors = floors.select("lang", F.when(F.col("settled"), F.col("was")).otherwise(F.col("floor")).alias("floor"), "was")
        else:
            floors = floors.select("lang", "floor", F.lit(1_000_001).cast("long").alias("was"))
        floors = written(floors)
        ranged = _with_lang(pairs, floors)
        new = lambda c: (F.col(c) >= F.col("floor")) & (F.col(c) < F.col("was"))
        # A score is never above its own bound: pairs above the floor are among the beginnings.
        begin, end = _pair_filter(ranged.where(new("bound"))), _pair_filter(ranged.where(new("score")))
        fresh = texts.mapInArrow(_count_triples(begin, end), "lang string, w string, x string, y string, n long")
        fresh = fresh.groupBy("lang", "w", "x", "y").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
        triples = written(fresh if triples is None else triples.unionByName(fresh).distinct())
        found = written(_survivors(_with_lang(pairs, floors.drop("was")), triples, floors, drop_percent))
        for filter_ in (begin, end):
            filter_.unpersist()
        reached = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        before = floors.join(reached, "lang", "left").select(
            "lang", "floor", ((F.col("floor") <= 0) | (F.coalesce("n", F.lit(0)) >= top)).alias("settled"))
        before = written(before)
        if not before.where("NOT settled").limit(1).count():
            return found
    return found


def _survivors(pairs: DataFrame, triples: DataFrame, floors: DataFrame, drop_percent: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the pairs and triples at or above the floor that no longer candidate drops."""
    columns = ("lang", "phrase", "a", "l", "r", "score")
    high = pairs.where("score >= floor")
    around = triples.select("lang", "w", "x", "a").unionByName(triples.select("lang", F.col("x").alias("w"), F.col("y").alias("x"), "a"))
    around = around.groupBy("lang", "w", "x").agg(F.max("a").alias("longer"))
    kept = high.join(around, ["lang", "w", "x"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < drop_percent * F.col("a")))
    kept = kept.select("lang", F.concat_ws(" ", "w", "x").alias("phrase"), "a", "l", "r", "score")
    head = pairs.select("lang", "w", "x", F.col("l").alias("f_w"), F.col("a").alias("f_wx"))
    tail = pairs.select("lang", F.col("w").alias("x"), F.col("x").alias("y"), F.col("a").alias("f_xy"), F.col("r").alias("f_y"))
    cut = triples.join(head, ["lang", "w", "x"]).join(tail, ["lang", "x", "y"])
    cut = cut.withColumn("one", score("a", "f_w", "f_xy")).withColumn("two", score("a", "f_wx", "f_y"))
    first = F.col("one") <= F.col("two")
    cut = cut.select(
        "lang", F.concat_ws(" ", "w", "x", "y").alias("phrase"), "a", F.when(first, F.col("f_w")).otherwise(F.col("f_wx")).alias("l"),
        F.when(first, F.col("f_xy")).otherwise(F.col("f_y")).alias("r"), F.least("one", "two").alias("score"))
    cut = _with_lang(cut, floors.select("lang", "floor")).where("score >= floor")
    return kept.unionByName(cut.select(*columns))
