"""A quality classifier: perplexity under an interpolated, modified Kneser-Ney model of trusted text.

The model predicts a character from the two before it, one model for each language. Its counts come from all trusted rows:
tasks count the trigrams of their rows, and the count tables of all orders, their context totals and their discounts are
joined in shards by language and context. Lower orders count in how many contexts a character was seen, not how often.
A language's alphabet is every character of its trusted text, and a symbol for each kind of character it never saw.
Trigrams of the ``OWN_SYMBOLS`` most frequent characters are scored by a table of ``SYMBOLS``^3 entries at most, which is
broadcast; those with any other character are joined with the same model by a shuffle. Each language is cut at a quantile of
its trusted rows' perplexities.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import runs
from .shared import handing_back, lookup, row_key, with_result, without, written

#: Symbols of the broadcast table: the start of a text, six kinds of unknown characters, and a language's most frequent ones.
#: Its other characters follow as symbols of their own.
KINDS, OWN_SYMBOLS = 6, 89
SYMBOLS = 1 + KINDS + OWN_SYMBOLS
#: Bits of a symbol in an n-gram: three fill a long, and there are fewer characters than values.
BITS = 21
#: Languages that are scored together; their tables take 3.5 MB each. More take more passes over their rows.
LANGUAGES_AT_ONCE = 16
#: The share of trusted rows of a language that its threshold keeps.
QUANTILE = 0.99
#: Trusted ids up to which they are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20
#: Different values of single runs that wait to be merged into a task's counts.
TALLY_ROWS = 1 << 18
#: Different values of a task that are handed on to be added up elsewhere.
TALLY_MOST = 1 << 21
_CODES = 0x110000
_RARE = SYMBOLS
_SCORES = "key string, lang string, perplexity double, trusted boolean"
_PARTS = "key string, lang string, nats double, size long, trusted boolean, rare array<struct<gram: long, times: long>>"
#: Costs of rare trigrams are added as whole numbers of this part of a nat, so that their order doesn't matter.
_UNIT = 1 << 24


def _kind_of_code() -> np.ndarray:
    """The symbol of each code point as long as no language has it as its own: 1 to KINDS."""
    order = {"Lu": 1, "Lt": 1, "Ll": 2, "L": 3, "N": 4, "P": 5, "S": 5}
    kinds = np.full(_CODES, 6, np.uint8)
    for code in range(_CODES):
        category = unicodedata.category(chr(code))
        kinds[code] = order.get(category) or order.get(category[0], 6)
    return kinds


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], pa.RecordBatch]]:
    """Texts of one language, a few at a time, with their rows."""
    for batch in batches:
        languages = batch.column(0).to_pylist()
        for language in dict.fromkeys(languages):
            rows = batch.take(pa.array([i for i, x in enumerate(languages) if x == language]))
            for first, last in runs(rows.column(1)):
                part = rows.slice(first, last - first)
                yield language, part.column(1).to_pylist(), part


class _Tally:
    """Counts of what was seen, as large as what is different in it."""

    def __init__(self):
        self.values, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(np.unique(values, return_counts=True))
        self.held += len(self.waiting[-1][0])
        if self.held > TALLY_ROWS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate([self.values, *(v for v, _ in self.waiting)]).astype(np.int64)
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.values, places = np.unique(values, return_inverse=True)
        self.counts = np.zeros(len(self.values), np.int64)
        np.add.at(self.counts, places, counts)
        self.waiting, self.held = [], 0
        return self.values, self.counts


def _count_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, _Tally] = defaultdict(_Tally)
    for language, texts, _ in _by_language(batches):
        total[language].add(_codes("".join(texts)))
    for language, tally in total.items():
        codes, counts = tally.merge()
        yield pa.RecordBatch.from_pydict({"lang": [language] * len(codes), "code": pa.array(codes, pa.int32()), "n": pa.array(counts)})


class _Alphabet:
    """The symbols of a language: its characters, the most frequent first, and what stands for all others."""

    def __init__(self, kinds: np.ndarray, codes: list[int]):
        self.table = kinds.copy()
        self.table[codes[:OWN_SYMBOLS]] = np.arange(1 + KINDS, 1 + KINDS + len(codes[:OWN_SYMBOLS]), dtype=np.uint8)
        self.rare = np.sort(np.array(codes[OWN_SYMBOLS:], np.uint32))
        self.table[self.rare] = _RARE
        self.size = SYMBOLS + len(self.rare)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        out = self.table[codes].astype(np.int64)
        if len(self.rare):
            at = np.flatnonzero(out == _RARE)
            out[at] = SYMBOLS + np.searchsorted(self.rare, codes[at])
        return out


def _trigrams(texts: list[str], alphabet: _Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three symbols of the trigrams that end at each character, and where each text's begin (and the last end)."""
    sizes = np.array([len(t) for t in texts])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    own = alphabet.symbols(_codes("".join(texts)))
    padded = np.zeros(len(own) + 2 * len(texts), np.int64)  # two starts before each text
    places = np.arange(len(own)) + 2 * (np.repeat(np.arange(len(texts)), sizes) + 1)
    padded[places] = own
    return padded[places - 2], padded[places - 1], own, bounds


def _gram(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    return (x << 2 * BITS) | (y << BITS) | z


def _count_trigrams(alphabets):
    def counted(language: str, tally: _Tally) -> pa.RecordBatch:
        grams, counts = tally.merge()
        return pa.RecordBatch.from_pydict({"lang": [language] * len(grams), "gram": pa.array(grams, pa.int64()), "n": pa.array(counts)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, _Tally] = defaultdict(_Tally)
        for language, texts, _ in _by_language(batches):
            total[language].add(_gram(*_trigrams(texts, alphabets.value[language])[:3]))
            if sum(len(tally.values) for tally in total.values()) > TALLY_MOST:
                yield from (counted(x, tally) for x, tally in total.items())
                total.clear()
        yield from (counted(x, tally) for x, tally in total.items())

    return count


def _rare_grams(grams: np.ndarray, rare: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Of each text, its different rare trigrams and how often each is there."""
    at = np.flatnonzero(rare)
    text = np.searchsorted(bounds, at, "right") - 1
    order = np.lexsort((grams[at], text))
    gram, text = grams[at][order], text[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    entries = pa.StructArray.from_arrays([pa.array(gram[first], pa.int64()), pa.array(np.diff(np.append(first, len(gram))), pa.int64())], names=["gram", "times"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[first], np.arange(len(bounds))), pa.int32()), entries)


def _score(alphabets, tables):
    """Of each row, the cost of the trigrams that the table has, and the others."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, texts, rows in _by_language(batches):
            x, y, z, bounds = _trigrams(texts, alphabets.value[language])
            rare = np.maximum(np.maximum(x, y), z) >= SYMBOLS
            costs = tables.value[language][np.where(rare, 0, (x * SYMBOLS + y) * SYMBOLS + z)]
            sums = np.concatenate([[0.0], np.cumsum(np.where(rare, 0, costs), dtype=np.float64)])
            yield pa.RecordBatch.from_arrays([
                rows.column(2), rows.column(0), pa.array(sums[bounds[1:]] - sums[bounds[:-1]]), pa.array(np.diff(bounds), pa.int64()), rows.column(3),
                _rare_grams(_gram(x, y, z), rare, bounds),
            ], names=["key", "lang", "nats", "size", "trusted", "rare"])

    return score


def _shorter(gram: str, order: int) -> Column:
    """The last symbols of an n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << BITS * order) - 1).cast("long"))


def count_tables(trigrams: DataFrame) -> list[DataFrame]:
    """``lang, gram, n`` of orders 1, 2 and 3: how often a trigram was seen, and in how many contexts a shorter one."""
    orders = [written(trigrams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))]
    for order in (2, 1):
        orders.append(written(orders[-1].groupBy("lang", _shorter("gram", order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))))
    return orders[::-1]


def discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of one order: ``lang, gram, share``, the discounted share of its context, and ``lang, context, rest``, what is left.

    The three discounts follow from how many n-grams were seen once to four times (modified Kneser-Ney); where too few
    were seen to tell, or a discount would leave its range, it is half a count.
    """
    seen = lambda k: F.sum((F.col("n") == k).cast("double"))
    of_counts = counts.groupBy("lang").agg(*[seen(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0))
    raw = [k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0.0)) for k in (1, 2, 3)]
    discounts = of_counts.select("lang", *[F.when((d > 0) & (d < k), d).otherwise(0.5).alias(f"d{k}") for k, d in enumerate(raw, 1)])
    context = F.shiftright("gram", BITS).alias("context")
    rows = counts.select("lang", "gram", "n", context).join(discounts, "lang")
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.withColumn("d", d)
    totals = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("taken"))
    shares = rows.join(totals, ["lang", "context"]).select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"))
    return shares, totals.select("lang", "context", (F.col("taken") / F.col("total")).alias("rest"))


def _frequent(table: DataFrame, gram: str, order: int) -> DataFrame:
    """The rows of n-grams without rare symbols, and their place in a dense table."""
    symbols = [F.shiftright(gram, BITS * i).bitwiseAND(F.lit((1 << BITS) - 1).cast("long")) for i in reversed(range(order))]
    place = F.lit(0).cast("long")
    for symbol in symbols:
        place = place * SYMBOLS + symbol
        table = table.where(symbol < SYMBOLS)
    return table.withColumn("place", place)


def _spread(table: DataFrame, gram: str, value: str, order: int, sizes: dict[str, int], otherwise: float) -> dict[str, np.ndarray]:
    """The values of n-grams without rare symbols as an array for each language."""
    out = {x: np.full(SYMBOLS**order, otherwise) for x in sizes}
    for x in sizes:  # one language at a time passes through the driver: SYMBOLS^3 rows at most
        rows = _frequent(table.where(F.col("lang") == x), gram, order).select("place", value).toArrow()
        out[x][rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def _tables(model: list[tuple[DataFrame, DataFrame]], sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """Negative logarithms of the probabilities of trigrams without rare symbols: SYMBOLS^3 numbers for each language."""
    spread = {}
    for order, (shares, rests) in enumerate(model, 1):
        share = _spread(shares, "gram", "share", order, sizes, 0.0)
        rest = _spread(rests, "context", "rest", order - 1, sizes, 1.0)
        for x, size in sizes.items():
            # the next shorter context of the symbols abc is bc: all a share it
            lower = spread[x].reshape(1, -1, SYMBOLS) if order > 1 else np.full((1, 1, SYMBOLS), 1 / size)
            out = share.pop(x).reshape(-1, lower.shape[1], SYMBOLS)
            out += rest.pop(x).reshape(*out.shape[:2], 1) * lower
            spread[x] = out.reshape(-1) if order < 3 else -np.log(out.reshape(-1)).astype(np.float32)
    return spread


def _rare_costs(model: list[tuple[DataFrame, DataFrame]], sizes: dict[str, int], wanted: DataFrame) -> DataFrame:
    """The trigrams ``lang, gram`` of ``wanted`` with ``cost``, the negative logarithm of their probability in ``_UNIT`` parts.

    The same sums as in the dense tables, order by order: what was not seen has no share, a context that was not leaves all.
    """
    size = F.create_map(*[F.lit(x) for item in sizes.items() for x in item])
    out = wanted.withColumn("p", 1 / F.element_at(size, F.col("lang")))
    for order, (shares, rests) in enumerate(model, 1):
        out = out.withColumn("own", _shorter("gram", order)).withColumn("before", F.shiftright("own", BITS))
        out = out.join(shares.withColumnRenamed("gram", "own"), ["lang", "own"], "left")
        rests = rests.withColumnRenamed("context", "before")
        # of the first order there is one context for each language
        out = out.join(F.broadcast(rests) if order == 1 else rests, ["lang", "before"], "left")
        out = out.withColumn("p", F.coalesce("share", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * F.col("p")).drop("own", "before", "share", "rest")
    return out.withColumn("cost", F.round(-F.log("p") * _UNIT).cast("long")).drop("p")


def _with_rare(parts: DataFrame, model: list[tuple[DataFrame, DataFrame]], sizes: dict[str, int]) -> DataFrame:
    """The scored rows, each with the cost of its rare trigrams. Rows that agree in key and language have the same text."""
    facts = written(parts.where(F.size("rare") > 0).dropDuplicates(["key", "lang"]).select("key", "lang", "rare"))
    grams = facts.select("key", "lang", F.inline("rare"))
    wanted = grams.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("_n"))
    costs = written(_rare_costs(model, sizes, written(wanted)))
    priced = lookup(grams, costs, ["lang", "gram"], "_n", "inner")
    sums = written(priced.groupBy("key", "lang").agg((F.sum(F.col("cost") * F.col("times")) / _UNIT).alias("more")))
    return parts.drop("rare").join(sums, ["key", "lang"], "left").withColumn("nats", F.col("nats") + F.coalesce("more", F.lit(0.0)))


def perplexities(
    docs: DataFrame, trusted: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``key, lang, perplexity, trusted`` of each row that has text in a language with trusted text; trusted rows train the models."""
    spark = docs.sparkSession
    base = docs.select(_language(lang_col).alias("lang"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"), trusted.alias("trusted"))
    base = base.where("text != ''")
    good = base.where("trusted").select("lang", "text")
    codes = written(good.mapInArrow(handing_back(_count_codes), "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in codes.select("lang").distinct().collect())
    kinds, scored = _kind_of_code() if languages else None, None
    for i in range(0, len(languages), LANGUAGES_AT_ONCE):
        some = languages[i : i + LANGUAGES_AT_ONCE]
        ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "code")))["code"].alias("codes")  # no more than there are characters
        alphabets = {row.lang: _Alphabet(kinds, row.codes) for row in codes.where(F.col("lang").isin(some)).groupBy("lang").agg(ordered).collect()}
        sizes = {x: alphabet.size for x, alphabet in alphabets.items()}
        symbols = spark.sparkContext.broadcast(alphabets)
        counted = good.where(F.col("lang").isin(some)).mapInArrow(handing_back(_count_trigrams(symbols)), "lang string, gram long, n long")
        model = [tuple(written(table) for table in discounted(counts)) for counts in count_tables(counted)]
        tables = spark.sparkContext.broadcast(_tables(model, sizes))
        part = base.where(F.col("lang").isin(some)).select("lang", "text", "key", "trusted").mapInArrow(handing_back(_score(symbols, tables)), _PARTS)
        if any(size > SYMBOLS for size in sizes.values()):
            part = _with_rare(written(part), model, sizes)
        part = part.select("key", "lang", F.exp(F.col("nats") / F.col("size")).alias("perplexity"), "trusted")
        scored = part if scored is None else scored.unionByName(part)
    return scored if scored is not None else spark.createDataFrame([], _SCORES)


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, quantile: float) -> DataFrame:
    """``key, of_lang, perplexity, threshold, kept`` of each row that has a perplexity; the key is :func:`row_key` of id and text."""
    good = written(labels.where("quality = 1 AND toxic = 0").select(F.col(id_col).alias("_good")).where("_good IS NOT NULL").distinct())
    few = good.count() <= BROADCAST_IDS
    flat = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    flat = flat.join(F.broadcast(good) if few else good, F.col("_id") == F.col("_good"), "left").withColumn("_trusted", F.col("_good").isNotNull())
    scores = written(perplexities(flat, F.col("_trusted"), "_id", "_text", "_lang"))
    limits = scores.where("trusted").groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 100_000).alias("threshold"))
    # repeated rows are scored among others in their task, so the last bits of their sums may differ: one score stands for all
    rows = scores.groupBy("key", "lang").agg(F.min("perplexity").alias("perplexity")).join(limits, "lang")
    return rows.select("key", F.col("lang").alias("of_lang"), "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).alias("kept"))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE,
    result: str = "quality",
) -> DataFrame:
    """All rows with a struct column ``perplexity, threshold, kept``.

    Rows whose label has quality 1 and toxic 0 are trusted and train their language's model, all of them. A row is kept if
    its perplexity is not above the ``quantile`` of the trusted rows of its language. Rows without text have no perplexity;
    they, and rows of a language without trusted text, are kept, as nothing speaks against them. A NULL language is one of
    its own. Labels with a NULL id or value trust nothing; repeated labels trust if one does. Ids may be NULL or repeat.
    Empty tables give no rows. Other columns are passed on whatever their names; one named as the result is replaced.
    """
    found = verdicts(docs, labels, id_col, text_col, lang_col, quantile).select("key", "of_lang", F.struct("perplexity", "threshold", "kept").alias("verdict"))
    own = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_col, text_col).alias("own"), _language(lang_col).alias("own_lang"))
    joined = own.join(found, (F.col("own") == F.col("key")) & (F.col("own_lang") == F.col("of_lang")), "left")
    nothing = F.struct(F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    return with_result(joined.withColumn(result, F.coalesce("verdict", nothing)), result)


def drop_rejected(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`classify` keeps."""
    found = verdicts(docs, labels, id_col, text_col, lang_col, quantile).where("NOT kept")
    return without(docs, F.concat_ws("\x1f", row_key(id_col, text_col), _language(lang_col)), found.select(F.concat_ws("\x1f", "key", "of_lang")))


def _language(lang_col: str) -> Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
