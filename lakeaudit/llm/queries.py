"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, compact_windows, exact_dedup, jaccard_join, kneser_ney, line_dedup, prefix_trie, quality_rules, suffix_array, surrogates, templates, warc
from .shared import read, written

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneser_ney.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "lang", "quality.perplexity", "quality.threshold", "quality.kept")


def op2_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compact_windows.similar_passages(read(spark, sf_dir, "documents"))
    return out.withColumnsRenamed({"id": "doc_id", "other_id": "other_doc_id"})


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_shared_lines(read(spark, sf_dir, "documents"), min_documents=10, min_chars=1)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM shared)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (k NOT IN (SELECT k FROM shared)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), verbatim=True)
    return found.drop("key").withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(warc.write_archives(warc.page_records(read(spark, sf_dir, "pages"), min_bytes=0)))
    page_id = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1)
    records = warc.read_archives(archives)
    return records.select(
        page_id("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", page_id("refers_to").cast("long")).alias("refers_to"), "error",
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path(), fields=("n_tokens", "ids_sha256", "decoded_sha256"))
    return out.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = surrogates.replace_entities(docs, spark.conf.get("spark.lakeaudit.surrogate.key", "demonstration key"))
    return out.select("doc_id", "text", "pii.n_entities", F.to_json("pii.kinds").alias("kinds"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "exact_dedup.keep_id", "exact_dedup.group_size", "exact_dedup.kept", F.col("exact_dedup.content").alias("text_sha256"))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), size=3, percent=90).withColumnRenamed("id", "doc_id")


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_array.drop_repeated_bytes(read(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    removed = F.aggregate("suffix_dedup.spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return out.select(
        "doc_id", "suffix_dedup.n_bytes", removed.alias("n_removed"), F.size("suffix_dedup.spans").cast("long").alias("n_spans"),
        F.sha2("suffix_dedup.kept", 256).alias("kept_sha256"),
        # A cut may split a character: its remains are replaced by U+FFFD in this column, and only here.
        F.make_valid_utf8(F.col("suffix_dedup.kept").cast("string")).alias("text"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), max_words=3, min_count=10, drop_percent=50, top=2000)


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
phrases AS (SELECT lang, words[i:i + k - 1] AS phrase, k FROM starts, (VALUES (1), (2), (3)) AS lengths(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM phrases GROUP BY lang, phrase),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, cut, lf.a AS l, rf.a AS r,
         ((1000000::HUGEINT * c.a * c.a) // (lf.a::HUGEINT * rf.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND a >= 10) c
  JOIN f lf ON lf.lang = c.lang AND lf.phrase = c.phrase[1:cut] JOIN f rf ON rf.lang = c.lang AND rf.phrase = c.phrase[cut + 1:]),
candidates AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, unnest([phrase[1:2], phrase[2:3]]) AS phrase, a FROM candidates WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a),
listed AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ') COLLATE "binary") AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM listed JOIN totals USING (lang) WHERE rank <= 2000
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = written(prefix_trie.conversations(read(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(prefix_trie.spliced(own, group=5, modulus=9)).drop("path")


OP12_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'digest': md5(concat(strlen(role), ':', role, text)), 'bytes': strlen(text)}
         ORDER BY turn NULLS FIRST, md5(concat(strlen(role), ':', role, text))) AS path
  FROM turns GROUP BY conv_id),
bytes_left AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS rest, 4294967295::BIGINT AS crc FROM own
  UNION ALL
  SELECT conv_id, rest[2:], list_reduce(list_concat([xor(crc, ascii(rest)::BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)
  FROM bytes_left WHERE rest <> ''),
cuts AS (SELECT conv_id, xor(crc, 4294967295::BIGINT) % 9 AS h FROM bytes_left WHERE rest = ''),
rebuilt AS (
  SELECT own.conv_id, list_concat(coalesce(base.path[1:h], []), own.path[h + 1:]) AS path
  FROM own JOIN cuts USING (conv_id) LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 5),
steps AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt),
beginnings AS (SELECT conv_id, depth, len(path) = depth AS ends, path[1:depth] AS node FROM steps),
nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN any_value(depth) = 0 THEN 0 ELSE any_value(node[depth].bytes) END AS saved
  FROM beginnings GROUP BY node),
families AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN families USING (node)),
above AS (SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS d FROM full_nodes),
subtrees AS (
  SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtrees s ON s.node = n.node
LEFT JOIN full_nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "quality_rules.*")


OP13_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM docs),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split),
word_counts AS (SELECT doc_id, words[i] AS word, count(*) AS times FROM places GROUP BY ALL),
windows AS (SELECT doc_id, i, words[i:i + 2] AS three FROM places WHERE i + 2 <= len(words)),
pairs AS (SELECT doc_id, max(times) AS top_pair FROM (
  SELECT doc_id, words[i:i + 1] AS two, count(*) AS times FROM places WHERE i + 1 <= len(words) GROUP BY ALL) GROUP BY doc_id),
often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM often) GROUP BY doc_id),
line_at AS (SELECT doc_id, unnest(lines) AS line FROM split),
worded AS (SELECT doc_id, line, count(*) AS times FROM line_at WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
line_counts AS (
  SELECT doc_id, sum(times) AS n_lines, sum(times - 1) AS n_dup_lines,
         sum(times) FILTER (regexp_matches(line, '^[\x20\x09-\x0D]*[-*•‣●◦]')) AS bullets,
         sum(times) FILTER (regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS ellipses
  FROM worded GROUP BY doc_id),
most AS (
  SELECT doc_id, max(times) AS most, sum(times) FILTER (NOT regexp_matches(word, '\p{L}')) AS bare,
         sum(times) FILTER (regexp_matches(word, '^[^\p{L}]*\p{Lu}{2}[^\p{Ll}]*$')) AS capitals
  FROM word_counts GROUP BY doc_id),
stats AS (
  SELECT doc_id, text, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(bullets, 0) AS bullets, coalesce(ellipses, 0) AS ellipses,
         coalesce(most, 0) AS most, coalesce(top_pair, 0) AS top_pair, coalesce(bare, 0) AS bare, coalesce(capitals, 0) AS capitals,
         length(text) - length(replace(text, '!', '')) AS exclamations
  FROM split LEFT JOIN repeats USING (doc_id) LEFT JOIN line_counts USING (doc_id) LEFT JOIN most USING (doc_id) LEFT JOIN pairs USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR word_chars NOT BETWEEN 3 * n_words AND 12 * n_words OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR 5 * bare > n_words OR 10 * capitals > 4 * n_words OR 4 * exclamations > n_words OR 10 * bullets > 9 * n_lines
            OR 10 * ellipses > 3 * n_lines OR 10 * most > 3 * n_words OR 10 * top_pair > n_words) AS kept
FROM judged
"""


QUERIES: dict[str, Query] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_compact_windows": op2_compact_windows,
    "op3_line_dedup": op3_line_dedup,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_warc": op5_warc,
    "op6_bpe": op6_bpe,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_suffix_array": op10_suffix_array,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op8_exact_dedup": OP8_SQL, "op11_collocations": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_quality_rules": OP13_SQL}
