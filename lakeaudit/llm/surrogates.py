"""Replacement of personal data by surrogates of the same type, format, script and gender.

An entity's surrogate is drawn with a secret key from its type and text alone, so one entity has one surrogate in all
documents (coreference), and nobody without the key can go back. A check over all distinct entities finds surrogates that
two entities share, or that are entities themselves, and draws again for these until none is left (distinctness). What
entities have in common, domains of addresses and last names, is settled in the same way first, so that all addresses of a
domain and all members of a family share the new one. Names of later draws have more parts (``Abel-Baker``), so there are
always enough. All of it is DataFrame functions; documents without entities are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lookup, row_key, written

#: Kinds in the order in which they are tried at a place, with what they look like (fixed patterns).
PATTERNS = {
    "email": r"[\p{L}\p{N}_%+-]+(?:\.[\p{L}\p{N}_%+-]+)*@[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?(?:\.[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?)+",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?=[A-Za-z]*\d)(?=\d*[A-Za-z])[A-Za-z0-9]{32,}(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?![\p{L}\p{N}])",
    "name": r"(?<![\p{L}\p{N}])(?:Mrs|Mr|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr|Г-н|Г-жа|Κύριος|Κυρία)\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?",
}
#: A phone number has so many digits at least (shorter groups are dates or sums).
PHONE_DIGITS = 9
ANY = "(?:" + "|".join(PATTERNS.values()) + ")"
#: Without one of these a text has no entity; most texts are passed by at this price.
HINT = r"[0-9@]|(?:Mr|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Sra|Sr|Г-н|Г-жа|Κύρι|Κυρία)"
TITLE = r"^(\S+) "
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία"]
#: First and last names that surrogates are made of, by script and gender (fixed lists).
NAMES = {
    "latin_f": "Ada Alba Alma Anna Berta Carla Clara Diana Dora Edith Elena Elsa Emma Erika Eva Flora Frida Gina Greta Hanna Helga Ida Ines Irma Ivana Jana Julia Karin Lara Lena Linda Lucia Maria Marta Mila Nadia Nina Nora Olga Paula Petra Rita Rosa Sara Sofia Stella Tania Vera Wanda Zoe".split(),
    "latin_m": "Adam Albert Alfred Anton Arno Boris Bruno Carl Conrad David Dino Edgar Emil Erik Ernst Felix Frank Georg Gustav Hans Hugo Igor Ivan Jakob Jan Jonas Karl Klaus Leo Luis Lukas Marco Mario Max Milo Nico Noah Oscar Otto Paul Pedro Peter Ralf Robert Rudolf Simon Theo Tom Victor Walter".split(),
    "latin_l": "Abel Adler Amado Bach Baker Barros Becker Blanc Bruni Calvo Carter Conti Cooper Costa Dietz Dubois Duran Ebert Egger Faber Ferri Fischer Fontana Fuchs Garnier Gomez Graf Gruber Haas Hansen Hill Huber Iversen Jansen Jensen Keller Klein Kovac Lang Lopez Marin Martin Meyer Moreau Moser Nagel Novak Olsen Parker Perez".split(),
    "cyrillic_f": "Анна Вера Галина Дарья Елена Жанна Зоя Инна Ирина Лидия Мария Нина Ольга Раиса Софья Тамара".split(),
    "cyrillic_m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Семён Тимур".split(),
    "cyrillic_l": "Белых Гончаренко Долгих Живаго Коваль Мельник Мороз Петренко Радченко Седых Соловей Ткаченко Черных Шевченко Шульга Яременко".split(),
    "greek_f": "Άννα Βασιλική Δήμητρα Ειρήνη Ελένη Ζωή Ιωάννα Μαρία".split(),
    "greek_m": "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος Πέτρος".split(),
    "greek_l": "Αλεξίου Γεωργίου Δημητρίου Ιωάννου Κωνσταντίνου Νικολάου Παύλου Πέτρου".split(),
}
#: Draws in which letters and digits keep their number; each later one adds one of the last one's kind, so no space is too small.
DRAWS = 6


def _kind(entity: Column) -> Column:
    """The kind of a matched text, or NULL if it is none after all."""
    out = None
    for kind, pattern in PATTERNS.items():
        test = entity.rlike(f"^(?:{pattern})$")
        if kind == "phone":
            test &= F.char_length(F.regexp_replace(entity, r"\D", "")) >= PHONE_DIGITS
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out


def _number(seed: Column, i: Column | int, modulus: int) -> Column:
    """A number below the modulus, drawn for place i."""
    return F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(modulus)).cast("int")


def _redrawn(text: Column, seed: Column, keep: Column) -> Column:
    """The text with each digit and letter drawn anew, within its kind, case and script; the first ``keep`` stay."""
    def draw(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        within = lambda first, size: F.char((F.lit(first) + _number(seed, i, size)).cast("long"))
        wide = lambda letters: F.substr(F.lit(letters), _number(seed, i, len(letters)) + 1, F.lit(1))
        return (
            F.when(i < keep, c).when((code >= 48) & (code <= 57), within(48, 10)).when((code >= 97) & (code <= 122), within(97, 26))
            .when((code >= 65) & (code <= 90), within(65, 26))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), wide("АБВГДЕЖЗИКЛМНОПРСТУФХ")).otherwise(wide("абвгдежзиклмнопрстуфх")))
            .when(c.rlike(r"\p{IsGreek}"), F.when(c.rlike(r"\p{Lu}"), wide("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")).otherwise(wide("αβγδεζηθικλμνξοπρστυφχψω")))
            .when(c.rlike(r"\p{Lu}"), wide("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike(r"\p{L}"), wide("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), draw), "")


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of an array of digits without its last one's part: what the last one has to bring to a multiple of ten."""
    def part(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(F.pmod(F.size(digits) - i, F.lit(2)) == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d.cast("int"))

    return F.aggregate(F.slice(F.transform(digits, part), 1, F.greatest(F.size(digits) - 1, F.lit(0))), F.lit(0), lambda total, x: total + x)


def _seed(key: str, attempt: int, *parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(str(attempt))), 256)


def _lengthened(text: Column, attempt: int) -> Column:
    return text if attempt < DRAWS else F.concat(text, F.repeat(F.right(text, F.lit(1)), F.lit(attempt - DRAWS + 1)))


def _surrogate(kind: Column, entity: Column, key: str, attempt: int) -> Column:
    """A surrogate of a number, a secret, a domain or a last name for the attempt."""
    seed = _seed(key, attempt, kind, entity)
    zero = F.lit(0)
    top = F.substring_index(entity, ".", -1)
    host = F.substr(entity, F.lit(1), F.char_length(entity) - F.char_length(top) - 1)
    domain = F.concat(_redrawn(_lengthened(host, attempt), seed, zero), F.lit("."), top)
    ip = F.concat_ws(".", *[(_number(seed, i, 254) + 1).cast("string") for i in range(4 + max(0, attempt - 4 * DRAWS))])
    long = _lengthened(entity, attempt)
    plain = _redrawn(long, seed, zero)
    # a country code stays
    phone = _redrawn(long, seed, F.char_length(F.regexp_extract(entity, r"^(\+\d{1,3})(?!\d)", 1)))
    # a card number that had a right check digit gets one
    digits, fresh = F.split(F.regexp_replace(entity, r"\D", ""), ""), F.split(F.regexp_replace(plain, r"\D", ""), "")
    check = F.pmod(-_luhn_sum(fresh), F.lit(10)).cast("string")
    right = F.pmod(_luhn_sum(digits) + F.element_at(digits, -1).cast("int"), F.lit(10)) == 0
    card = F.when(right, F.concat(F.substr(plain, F.lit(1), F.char_length(plain) - 1), check)).otherwise(plain)
    iban = F.concat(F.substring(entity, 1, 2), F.substr(plain, F.lit(3)))
    secret = F.when(entity.rlike("^[0-9a-f]+$"), F.substr(F.concat(seed, F.sha2(seed, 256)), F.lit(1), F.char_length(long))).otherwise(plain)
    secret = F.when(F.char_length(secret) == F.char_length(long), secret).otherwise(plain)
    return (
        F.when(kind == "domain", domain).when(kind == "last", _composed(F.lit("l"), entity, key, attempt)).when(kind == "ip", ip)
        .when(kind == "phone", phone).when(kind == "card", card).when(kind == "iban", iban).when(kind == "secret", secret).otherwise(plain)
    )


def _composed(which: Column, name: Column, key: str, attempt: int, *of: Column) -> Column:
    """A first (``f`` or ``m``) or last (``l``) name of the name's script, of one part more with each attempt."""
    script = F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    lists = F.create_map(*[x for k, v in NAMES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    list_, seed = lists[F.concat_ws("_", script, which)], _seed(key, attempt, which, name, *of)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(attempt)), lambda i: F.element_at(list_, F.pmod(F.xxhash64(seed, i), F.size(list_)).cast("int") + 1)), "-")


def _dependent(kind: Column, entity: Column, base: Column, key: str, attempt: int) -> Column:
    """An address at its new domain, or a person (of kind ``f`` or ``m``) with the new last name."""
    local = _redrawn(_lengthened(F.substring_index(entity, "@", 1), attempt), _seed(key, attempt, kind, entity), F.lit(0))
    first = _composed(kind, F.substring_index(entity, " ", 1), key, attempt, F.substring_index(entity, " ", -1))
    return F.when(kind == "email", F.concat(local, F.lit("@"), base)).otherwise(F.concat(first, F.lit(" "), base))


def found_entities(table: DataFrame, text_col: str, *keys: Column) -> DataFrame:
    """``found``, all matched texts in order, for rows that have any."""
    rows = table.where(F.col(text_col).rlike(HINT)).select(*keys, F.col(text_col).alias("text"))
    return rows.withColumn("found", F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))).where(F.size("found") > 0)


def _settled(entities: DataFrame, draw: Callable[[int], Column]) -> DataFrame:
    """``entities`` (a written table with ``kind, entity``, distinct) with ``surrogate``: distinct, and none is an entity.

    Each round draws for the entities whose surrogate another one has, or which is itself an entity; the one that comes first
    keeps a shared one. Few possible surrogates in an early round make large groups, so they are split as hot keys are.
    """
    done: list[DataFrame] = []
    open_, attempt = entities, 0
    known = entities.select(F.col("entity").alias("surrogate"))
    while open_.limit(1).count():
        drawn = written(open_.withColumn("surrogate", draw(attempt)))
        taken = reduce(DataFrame.unionByName, [known, *[d.select("surrogate") for d in done]]).distinct().withColumn("taken", F.lit(True))
        first = drawn.groupBy("surrogate").agg(F.min(F.struct("kind", "entity")).alias("first"), F.count(F.lit(1)).alias("_in"))
        judged = lookup(drawn, written(first.join(taken, "surrogate", "left")), ["surrogate"], "_in", "inner")
        good = F.col("taken").isNull() & (F.struct("kind", "entity") == F.col("first"))
        judged = written(judged.select(*entities.columns, "surrogate", good.alias("good")))
        done.append(judged.where("good").drop("good"))
        open_, attempt = judged.where("NOT good").select(*entities.columns), attempt + 1
    return reduce(DataFrame.unionByName, done) if done else entities.withColumn("surrogate", F.lit(None).cast("string"))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, _n, surrogate`` for ``kind, entity, _n`` (distinct): surrogates are distinct, and none is an entity.

    Domains and last names are settled first, together with all numbers; then addresses at them and persons of that name.
    A new domain or last name is none that occurs, hence no address or name made with it occurs either.
    """
    domain, names = F.substring_index("entity", "@", -1), F.regexp_replace("entity", TITLE, "")
    title = F.regexp_extract("entity", TITLE, 1)
    emails = entities.where("kind = 'email'").withColumn("part", domain)
    named = entities.where("kind = 'name'").select(
        "*", title.alias("title"), names.alias("names"), F.substring_index(names, " ", -1).alias("part"),
        F.when(F.regexp_replace(title, r"\.$", "").isin(FEMALE), "f").otherwise("m").alias("gender"),
    )
    parts = [
        rows.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).select(F.lit(kind).alias("kind"), F.col("part").alias("entity"), "_n")
        for kind, rows in (("domain", emails), ("last", named))
    ]
    kind, entity = F.col("kind"), F.col("entity")
    single = entities.where("kind NOT IN ('email', 'name')").select("kind", "entity", "_n")
    level = written(_settled(written(single.unionByName(parts[0]).unionByName(parts[1])), lambda attempt: _surrogate(kind, entity, key, attempt)))

    def based(rows: DataFrame, part: str) -> DataFrame:
        facts = level.where(kind == part).select(entity.alias("part"), F.col("surrogate").alias("base"), F.col("_n").alias("_in"))
        return lookup(rows, facts, ["part"], "_in", "inner")

    named = written(based(named, "last"))
    several = F.col("names").contains(" ")
    persons = named.where(several).groupBy("gender", "names", "base").agg(F.count(F.lit(1)).alias("_n"))
    both = based(emails, "domain").select("kind", "entity", "base", "_n").unionByName(
        persons.select(F.col("gender").alias("kind"), F.col("names").alias("entity"), "base", "_n"))
    second = written(_settled(written(both), lambda attempt: _dependent(kind, entity, F.col("base"), key, attempt)))
    # a person has as many rows as titles; a title stays as it was
    persons = second.where("kind <> 'email'").select(kind.alias("gender"), entity.alias("names"), F.col("surrogate").alias("person"))
    full = named.where(several).join(persons, ["gender", "names"]).unionByName(named.where(~several).withColumn("person", F.col("base")))
    full = full.withColumn("surrogate", F.concat_ws(" ", "title", "person"))
    columns = ["kind", "entity", "_n", "surrogate"]
    frames = [level.where("kind NOT IN ('domain', 'last')"), second.where("kind = 'email'"), full]
    return written(reduce(DataFrame.unionByName, [f.select(*columns) for f in frames]))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", result: str = "pii") -> DataFrame:
    """All rows with entities in the text replaced, and a struct column ``n_entities, kinds`` (a map of kinds to counts).

    Entities are e-mail and IPv4 addresses, IBANs, long secrets of letters and digits, card, social security and phone
    numbers, and names after a title. Equal entities get equal surrogates in all rows, different ones different ones. Numbers
    keep their length (up to ``DRAWS`` collisions), separators and country code, cards with a right check digit get one, names
    keep title, gender and script, and share a last name where they did; addresses keep their top-level domain and share a
    domain where they did. NULL texts stay NULL,
    empty ones empty, texts without entities as they are. Ids may be NULL or repeat; repeated rows are replaced alike. An
    empty table gives no rows. Other columns are passed on whatever their names; one named as the result is replaced.
    """
    own = row_key(id_col, text_col)
    found = written(found_entities(docs, text_col, own.alias("key")).select("key", F.explode(F.array_distinct("found")).alias("entity")).distinct())
    counts = found.groupBy("entity").agg(F.count(F.lit(1)).alias("_n")).select(_kind(F.col("entity")).alias("kind"), "entity", "_n")
    table = surrogate_table(written(counts.where("kind IS NOT NULL")), key)
    known = lookup(found, table, ["entity"], "_n", "inner")
    maps = known.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("new"), F.map_from_entries(F.collect_list(F.struct("entity", "kind"))).alias("kind_of"),
    )
    row = F.struct(*docs.columns).alias("row")
    hint = F.coalesce(F.col(text_col).rlike(HINT), F.lit(False))
    nothing = F.struct(F.lit(0).cast("long").alias("n_entities"), F.create_map().cast("map<string,long>").alias("kinds"))
    plain = docs.where(~hint).select(row, nothing.alias(result))
    rows = docs.where(hint).select(row, own.alias("key"), F.col(text_col).alias("text")).join(maps, "key", "left")
    matches = F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))
    rows = rows.withColumn("found", F.when(F.col("new").isNotNull(), matches))
    # what stands between the entities, and their surrogates; a match of no kind stays
    between = F.split("text", ANY, -1)
    pieces = F.zip_with(between, "found", lambda a, e: F.concat(a, F.coalesce(F.col("new")[e], e, F.lit(""))))
    fresh = F.when(F.col("new").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    kinds = F.filter(F.transform("found", lambda e: F.col("kind_of")[e]), lambda k: k.isNotNull())
    counted = F.transform(F.array_distinct(kinds), lambda k: F.struct(k.alias("kind"), F.size(F.filter(kinds, lambda x: x == k)).cast("long").alias("n")))
    about = F.struct(F.size(kinds).cast("long").alias("n_entities"), F.map_from_entries(counted).alias("kinds"))
    fields = [fresh.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    changed = rows.select(F.struct(*fields).alias("row"), F.when(F.col("new").isNull(), nothing).otherwise(about).alias(result))
    both = plain.unionByName(changed)
    names = [c for c in docs.columns if c.lower() != result.lower()]
    return both.select(*[F.col("row").getField(n).alias(n) for n in names], result)
