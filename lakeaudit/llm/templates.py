"""Benchmark decontamination by templates: questions are found again with other numbers, names and units.

A text's tokens are its words; numbers, names and units become typed placeholders, whose values are kept beside them. Windows
of templates are joined by hash, and a hit counts if its slots are consistent: one value of the benchmark's window stands for
one value of the document's, and the other way round. All of it is DataFrame functions.

So that not every window of every document is hashed, each window of the benchmark is entered under one of its pairs of
neighbouring tokens, the one with the most letters, which few other places have. Documents look up their pairs; only where
one is found is the window around it cut out and compared.

Telling names, numbers and sentences apart costs most. So texts are first split into runs of letters and of digits only, and
each window has an anchor, two such runs in a row (or one) that stand in every text with the window, whatever its slots hold.
Only texts with an anchor are read closely; a text without one has no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import row_key, without, written

#: Tokens of a window; a shorter benchmark text is one window.
WINDOW = 13
#: Tokens of a window, in percent, that must not be placeholders.
LITERAL_PERCENT = 40
#: So many windows of the benchmark at most are broadcast (about 400 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1 << 17
#: So many hashes of anchors or texts at most are broadcast (16 to 32 bytes each); more are joined by a shuffle.
BROADCAST_HASHES = 1 << 20
#: Marks that stand for nothing in any text: a name's beginning, and the point or comma within a number.
NAME, POINT = "", ""
#: The beginning of a word that has a capital because a text, sentence, line or quotation begins there, or that is a name.
START = ""
NUM_SLOT, NAME_SLOT, UNIT_SLOT = "", "", ""
MARKS = NAME + POINT + START + NUM_SLOT + NAME_SLOT + UNIT_SLOT
#: Units that may follow a number (fixed list of common ones).
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces pound pounds ton tons ml cl l liter "
    "liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar "
    "dollars euro euros cent cents percent degree degrees watt watts volt volts meter meters metre metres kilometer kilometers kilogram kilograms "
    "gram grams usd eur gbp kmh mph"
).split()


def _marked(text: Column) -> Column:
    """Tokens joined by one space, in lower case. Names begin with NAME, other words with a capital with START; numbers are whole."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{MARKS}]+", "")
    # A capital after a word and a space, not after the end of a sentence or line, begins a name. What few places have is asked first.
    text = F.regexp_replace(text, r"(?=\p{Lu}\p{Ll})(?<=[\p{L}\p{N},;)] )", NAME)
    text = F.regexp_replace(text, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{N}}\p{{M}}{NAME}])", START)
    text = F.regexp_replace(text, r"[.,](?=\p{N})(?<=\p{N}[.,])", POINT)
    text = F.regexp_replace(text, r"(?=\p{N})(?<=\p{L})|(?=\p{L})(?<=\p{N})", " ")
    text = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}\p{{M}}{NAME}{POINT}{START}]+", " ")
    return F.trim(F.lower(text))


def _readings(marked: Column) -> Column:
    """The two ways to read a text, ``loose`` and ``normal``: words with START as they are, or as names. Neighbouring names are one token.

    A name does not go on beyond a START: a sentence may begin there.
    """
    strict = F.regexp_replace(F.translate(marked, START, ""), f"({NAME}[^ ]+) (?={NAME})", "$1")
    loose = F.translate(F.regexp_replace(marked, f"([{NAME}{START}][^ ]+) (?={NAME})", "$1"), START, NAME)
    return F.array(*[F.struct(F.lit(x).alias("loose"), normal.alias("normal")) for x, normal in ((False, strict), (True, loose))])


def _template(normal: Column) -> Column:
    """The same tokens with placeholders."""
    text = F.regexp_replace(normal, rf"(?<![^ ])\p{{N}}[^ ]*", NUM_SLOT)
    text = F.regexp_replace(text, rf"(?<={NUM_SLOT} )(?:{'|'.join(UNITS)})(?![^ ])", UNIT_SLOT)
    return F.regexp_replace(text, f"{NAME}[^ ]+", NAME_SLOT)


def _tokens(table: DataFrame, *keys: Column, text_col: str) -> DataFrame:
    """For both readings, ``loose`` or not: ``tokens`` of the template and ``values``, the same tokens as they stand in the text."""
    out = table.where(F.col(text_col).rlike(r"[\p{L}\p{N}]")).select(*keys, F.explode(_readings(_marked(F.col(text_col)))).alias("reading"))
    names = [k for k in out.columns if k != "reading"]
    out = out.select(*names, "reading.loose", "reading.normal")
    return out.select(*names, "loose", F.split(_template(F.col("normal")), " ").alias("tokens"), F.split("normal", " ").alias("values"))


def _is_slot(token: Column) -> Column:
    return token.isin(NUM_SLOT, NAME_SLOT, UNIT_SLOT)


def _pair(tokens: Column, i: Column) -> Column:
    """Hash of a token and the next one (the empty text after the last)."""
    return F.xxhash64(F.get(tokens, i), F.coalesce(F.get(tokens, i + 1), F.lit("")))


def _letters(tokens: Column, i: Column) -> Column:
    size = lambda t: F.when(_is_slot(t), 0).otherwise(F.coalesce(F.char_length(t), F.lit(0)))
    return size(F.get(tokens, i)) + size(F.get(tokens, i + 1))


def _runs(lowered: Column, more: str = "") -> Column:
    """The runs of letters and of digits of a text in lower case. Which sigma ends a word depends on what follows, so they count as one."""
    return F.regexp_extract_all(F.replace(lowered, F.lit("ς"), F.lit("σ")), F.lit(r"\p{L}+|\p{N}+" + more), F.lit(0))


def _anchor(runs: Column) -> Column:
    """``paired, letters, hash`` of the runs with the most letters that every text with the window has: two in a row without a slot between, or one.

    NULL for a window without letters and digits outside its slots.
    """
    paired = lambda p: p["b"].isNotNull() & ~_is_slot(p["b"])
    letters = lambda p: F.char_length(p["a"]) + F.when(paired(p), F.char_length(p["b"])).otherwise(0)
    key = lambda p: F.when(paired(p), F.xxhash64(p["a"], p["b"])).otherwise(F.xxhash64(p["a"]))
    places = F.zip_with(runs, F.slice(runs, F.lit(2), F.size(runs)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.array_max(F.transform(F.filter(places, lambda p: ~_is_slot(p["a"])), lambda p: F.struct(paired(p).alias("paired"), letters(p).alias("letters"), key(p).alias("hash"))))


def _with_anchor(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows whose text holds the anchor of some window: all that can share one. If a window has none, these are all rows."""
    if windows.where("anchor IS NULL").limit(1).count():
        return keyed
    anchors = written(windows.select("anchor", "paired").distinct())
    lowered = F.lower(F.regexp_replace("text", f"[{MARKS}]+", ""))
    texts = keyed.where("text != ''").select(F.xxhash64("text").alias("of"), _runs(lowered).alias("runs"))
    parts = [F.zip_with("runs", F.slice("runs", F.lit(2), F.size("runs")), lambda a, b: F.xxhash64(a, b))]
    if anchors.where("NOT paired").limit(1).count():
        parts.append(F.transform("runs", lambda run: F.xxhash64(run)))
    few = lambda hashes: F.broadcast(hashes) if hashes.count() <= BROADCAST_HASHES else hashes
    # Outer, as a filter by size would compute all runs twice.
    found = texts.select("of", F.explode_outer(F.concat(*parts)).alias("anchor")).join(few(anchors.select("anchor").distinct()), "anchor", "left_semi")
    found = written(found.select("of").distinct())
    return keyed.join(few(found), F.xxhash64("text") == F.col("of"), "left_semi")


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, literal_percent: int, verbatim: bool = False) -> DataFrame:
    """``item, loose, exact, pair, shift, width, hash, slots, anchor, paired`` of each window: the pair it is entered under, that pair's place
    in it, and what every text with the window has.

    With ``verbatim``, windows with too few literal tokens are kept as exact ones, entered under a pair of values.
    """
    items = _tokens(benchmark.where(F.col(id_col).isNotNull()), F.col(id_col).alias("item"), text_col=text_col)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("tokens") - window + 1, F.lit(1))))
    cut = items.select("item", "loose", "tokens", "values", start.alias("start"))
    cut = cut.select("item", "loose", F.slice("tokens", F.col("start"), window).alias("tokens"), F.slice("values", F.col("start"), window).alias("values"))
    cut = cut.withColumn("exact", F.size(F.filter("tokens", lambda t: ~_is_slot(t))) * 100 < F.size("tokens") * literal_percent)
    cut = (cut if verbatim else cut.where("NOT exact")).withColumn("under", F.when(F.col("exact"), F.col("values")).otherwise(F.col("tokens")))
    places = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 2, F.lit(0)))
    best = F.array_max(F.transform(places, lambda i: F.struct(_letters(F.col("under"), i).alias("letters"), (-i).alias("i"))))
    cut = cut.withColumn("shift", -best["i"]).withColumn("width", F.size("tokens"))
    pair = F.when(F.col("width") > 1, _pair(F.col("under"), F.col("shift"))).otherwise(F.xxhash64(F.get("under", F.lit(0))))
    cut = cut.withColumn("runs", _runs(F.array_join("under", " "), f"|[{NUM_SLOT}{NAME_SLOT}{UNIT_SLOT}]")).withColumn("anchor", _anchor(F.col("runs")))
    return cut.select(
        "item", "loose", "exact", pair.alias("pair"), "shift", "width", F.xxhash64("tokens").alias("hash"), _slots("tokens", "values").alias("slots"),
        F.col("anchor.hash").alias("anchor"), F.col("anchor.paired").alias("paired"),
    ).distinct()


def _slots(tokens: str, values: str) -> Column:
    return F.transform(F.filter(F.arrays_zip(F.col(tokens).alias("t"), F.col(values).alias("v")), lambda z: _is_slot(z["t"])), lambda z: z["v"])


def _consistent(mine: Column, theirs: Column) -> Column:
    both = F.size(F.array_distinct(F.arrays_zip(mine.alias("a"), theirs.alias("b"))))
    return (both == F.size(F.array_distinct(mine))) & (both == F.size(F.array_distinct(theirs)))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, literal_percent: int = LITERAL_PERCENT, verbatim: bool = False,
) -> DataFrame:
    """One row ``key, id, item, n_windows, n_same, first_token, last_token`` for each document and benchmark item that share a window.

    ``n_windows`` counts the places in the document; ``n_same`` those whose slot values are the benchmark's own; the tokens
    are the first and last of all shared windows. ``key`` names the row by id and text (:func:`row_key`). A window with
    more than (100 - literal_percent) percent placeholders matches nothing, or with ``verbatim`` only its own slot values.
    Texts are read twice, with capitalised words at the start of a sentence as words and as names; counts and places are
    those of the reading with more windows, in tokens of that reading. An item of fewer tokens than a window is one window; items
    without tokens or id match nothing, nor do NULL and empty texts. Repeated rows share one row of the result. Empty
    tables give no rows. Other columns are not looked at, whatever their names.
    """
    windows = written(benchmark_windows(benchmark, item_col, item_text_col, window, literal_percent, verbatim))
    single = windows.where("width = 1").limit(1).count() > 0
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = written(_with_anchor(keyed, windows).dropDuplicates(["key"]))
    windows = windows.drop("anchor", "paired")
    tokens = _tokens(keyed, F.col("key"), text_col="text")
    parts = []
    for c in ("tokens", "values") if verbatim else ("tokens",):
        following = F.concat(F.slice(c, F.lit(2), F.size(c)), F.array(F.lit("")))
        parts.append(F.zip_with(c, following, lambda a, b: F.xxhash64(a, b)))
        if single:  # items of one token are entered under it alone
            parts.append(F.transform(c, lambda t: F.xxhash64(t)))
    pairs = F.concat(*parts)
    # Only key and place go with each pair; outer, as a filter by size would compute all tokens twice.
    found = tokens.select("key", "loose", pairs.alias("pairs")).select("key", "loose", F.posexplode_outer("pairs").alias("pos", "pair"))
    found = written(found.join(F.broadcast(windows) if windows.count() <= BROADCAST_WINDOWS else windows, ["pair", "loose"]).distinct())
    keys = written(found.select("key").distinct())
    some = keyed.join(F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys, "key", "left_semi")
    hits = _tokens(some, F.col("key"), F.col("id"), text_col="text").join(found, ["key", "loose"])
    place = F.pmod(F.col("pos"), F.size("tokens"))
    hits = hits.withColumn("first_token", place - F.col("shift")).where("first_token >= 0 AND first_token + width <= size(tokens)")
    cut = lambda c: F.slice(c, F.greatest(F.col("first_token") + 1, F.lit(1)), F.col("width"))
    hits = hits.withColumn("tokens", cut("tokens")).withColumn("values", cut("values")).where(F.xxhash64("tokens") == F.col("hash"))
    hits = hits.withColumn("own", _slots("tokens", "values")).where((F.col("own") == F.col("slots")) | (~F.col("exact") & _consistent(F.col("own"), F.col("slots"))))
    places = hits.groupBy("key", "id", "item", "loose", "first_token").agg(F.max("width").alias("width"), F.max((F.col("own") == F.col("slots")).cast("int")).alias("same"))
    readings = places.groupBy("key", "id", "item", "loose").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("same").alias("n_same"), F.min("first_token").cast("long").alias("first_token"),
        F.max(F.col("first_token") + F.col("width") - 1).cast("long").alias("last_token"),
    )
    best = F.max(F.struct("n_windows", ~F.col("loose"), "n_same", "first_token", "last_token")).alias("best")
    return readings.groupBy("key", "id", "item").agg(best).select("key", "id", "item", *[f"best.{c}" for c in ("n_windows", "n_same", "first_token", "last_token")])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, that share no window with the benchmark."""
    return without(docs, row_key(id_col, text_col), leaks(docs, benchmark, id_col, text_col, **how).select("key"))
