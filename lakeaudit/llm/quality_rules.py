"""Quality rules as a short-circuit cascade, ordered by what they reject for what they cost.

Every rule is first run on a bounded sample: each task times it there and notes whom it rejects. The order is then chosen
greedily: the next rule is the one that rejects most of what the earlier ones leave, for its seconds. In the cascade a rule
only sees the texts that all rules before it passed. A text is kept when no rule rejects it, so the order changes the work
and never the verdict.

Base statistics are measured for all texts, as they are part of the result; rules that only read them cost next to nothing.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import runs
from .shared import with_result

#: Texts that the order of the rules is chosen on, in expectation; the sample is Bernoulli, with a fixed seed.
SAMPLE_TEXTS = 4000
SEED = 11
BLANKS = "[\x20\x09-\x0d]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Texts:
    """Texts without NULLs, with their words and lines side by side: value, and the text each belongs to."""

    text: pa.Array
    stats: dict[str, np.ndarray]
    words: pa.Array
    word_text: np.ndarray
    lines: pa.Array
    line_text: np.ndarray

    def __len__(self) -> int:
        return len(self.text)

    def take(self, keep: np.ndarray) -> Texts:
        """The texts whose flag is set."""
        place = np.cumsum(keep) - 1
        word, line = keep[self.word_text], keep[self.line_text]
        return Texts(
            self.text.filter(pa.array(keep)), {k: v[keep] for k, v in self.stats.items()}, self.words.filter(pa.array(word)), place[self.word_text[word]],
            self.lines.filter(pa.array(line)), place[self.line_text[line]])

    def per_text(self, flags: pa.Array | np.ndarray, of: np.ndarray) -> np.ndarray:
        """How many words or lines of each text have the flag."""
        flags = flags if isinstance(flags, np.ndarray) else flags.to_numpy(zero_copy_only=False)
        return np.bincount(of[flags], minlength=len(self))


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _repeats(code: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Words that stand in a window of three that its text has twice or more; words are given as codes, so it is exact."""
    n = len(code)
    out = np.zeros(n, bool)
    if n >= 3:
        inside = np.flatnonzero((text[2:] == text[:-2]))
        base = int(code.max()) + 1
        pair = np.unique(code[inside].astype(np.int64) * base + code[inside + 1], return_inverse=True)[1]
        triple = np.unique(pair.astype(np.int64) * base + code[inside + 2], return_inverse=True)[1]
        _, at, times = np.unique(text[inside] * (int(triple.max(initial=0)) + 1) + triple, return_inverse=True, return_counts=True)
        first = inside[times[at] > 1]
        for step in range(3):
            out[first + step] = True
    return np.bincount(text[out], minlength=n_texts)


def measure(text: pa.Array) -> Texts:
    """Base statistics of texts without NULLs."""
    words, word_text = _flat(pc.split_pattern_regex(text, f"{BLANKS}+"))
    real = pc.greater(pc.binary_length(words), 0)
    words, word_text = words.filter(real), word_text[real.to_numpy(zero_copy_only=False)]
    lines, line_text = _flat(pc.split_pattern(text, "\n"))
    out = Texts(text, {}, words, word_text, lines, line_text)
    code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    worded = pc.match_substring_regex(lines, "[^\x20\x09-\x0d]").to_numpy(zero_copy_only=False)
    line = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    again = np.ones(len(lines), bool)
    again[np.unique(line_text * (int(line.max(initial=0)) + 1) + line, return_index=True)[1]] = False
    chars = np.zeros(len(text) + 1, np.int64)
    np.add.at(chars, word_text, pc.utf8_length(words).to_numpy().astype(np.int64))
    out.stats = {
        "n_words": np.bincount(word_text, minlength=len(text)),
        "word_chars": chars[:-1],
        "n_symbols": pc.count_substring_regex(text, SYMBOLS).to_numpy().astype(np.int64),
        "n_dup_lines": out.per_text(worded & again, line_text),
        "n_repeat_words": _repeats(code, word_text, len(text)),
        "n_lines": out.per_text(worded, line_text),
    }
    return out


#: A rule rejects the texts that it flags. It must judge each text by itself, whatever texts are beside it.
Rule = Callable[[Texts], np.ndarray]


def base(t: Texts) -> np.ndarray:
    """Fewer than 50 words, or over half of the words in windows of three that repeat."""
    return (t.stats["n_words"] < MIN_WORDS) | (100 * t.stats["n_repeat_words"] > MAX_REPEAT_PERCENT * t.stats["n_words"])


def word_length(t: Texts) -> np.ndarray:
    """Words of under 3 or over 12 characters in the mean."""
    return (t.stats["word_chars"] < 3 * t.stats["n_words"]) | (t.stats["word_chars"] > 12 * t.stats["n_words"])


def symbols(t: Texts) -> np.ndarray:
    """More than one symbol of markup in ten words."""
    return 10 * t.stats["n_symbols"] > t.stats["n_words"]


def repeated_lines(t: Texts) -> np.ndarray:
    """At least three lines with a word, and more than 30 % of them, are equal to an earlier one."""
    return (t.stats["n_dup_lines"] >= 3) & (10 * t.stats["n_dup_lines"] > 3 * t.stats["n_lines"])


def no_letters(t: Texts) -> np.ndarray:
    """More than 20 % of the words without a letter."""
    return 5 * (t.stats["n_words"] - t.per_text(pc.match_substring_regex(t.words, r"\p{L}"), t.word_text)) > t.stats["n_words"]


def capitals(t: Texts) -> np.ndarray:
    """More than 40 % of the words in capitals, of two letters or more."""
    return 10 * t.per_text(pc.match_substring_regex(t.words, r"^[^\p{L}]*\p{Lu}{2}[^\p{Ll}]*$"), t.word_text) > 4 * t.stats["n_words"]


def exclamations(t: Texts) -> np.ndarray:
    """More than one exclamation mark in four words."""
    return 4 * pc.count_substring(t.text, "!").to_numpy().astype(np.int64) > t.stats["n_words"]


def bullets(t: Texts) -> np.ndarray:
    """More than 90 % of the lines with a word begin with a bullet."""
    return 10 * t.per_text(pc.match_substring_regex(t.lines, "^[\x20\x09-\x0d]*[-*•‣●◦]"), t.line_text) > 9 * t.stats["n_lines"]


def ellipses(t: Texts) -> np.ndarray:
    """More than 30 % of the lines with a word end with an ellipsis."""
    return 10 * t.per_text(pc.match_substring_regex(t.lines, "(\\.\\.\\.|…)[\x20\x09-\x0d]*$"), t.line_text) > 3 * t.stats["n_lines"]


def _most(code: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
    """How often the most frequent code of each text stands in it."""
    size = int(code.max(initial=0)) + 1
    found, times = np.unique(of * size + code, return_counts=True)
    most = np.zeros(n_texts, np.int64)
    np.maximum.at(most, found // size, times)
    return most


def few_words(t: Texts) -> np.ndarray:
    """One word is more than 30 % of all words."""
    code = t.words.dictionary_encode().indices.to_numpy().astype(np.int64)
    return 10 * _most(code, t.word_text, len(t)) > 3 * t.stats["n_words"]


def few_pairs(t: Texts) -> np.ndarray:
    """One pair of neighbouring words stands more than once in ten words."""
    code = t.words.dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.flatnonzero(t.word_text[1:] == t.word_text[:-1])
    pair = np.unique(code[first] * (int(code.max(initial=0)) + 1) + code[first + 1], return_inverse=True)[1].astype(np.int64)
    return 10 * _most(pair, t.word_text[first], len(t)) > t.stats["n_words"]


RULES: dict[str, Rule] = {
    r.__name__: r for r in (base, word_length, symbols, repeated_lines, no_letters, capitals, exclamations, bullets, ellipses, few_words, few_pairs)}


def _texts(column: pa.Array) -> pa.Array:
    return column.cast(pa.string()).fill_null("")


def _trial(rules: dict[str, Rule]):
    """Of each sampled text, which rules reject it; of each rule, its seconds on a batch."""
    names = list(rules)

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(_texts(batch.column(0)))
            rejected, seconds = np.zeros(len(found), np.int64), []
            for i, name in enumerate(names):
                started = time.perf_counter()
                rejected |= rules[name](found).astype(np.int64) << i
                seconds.append(time.perf_counter() - started)
            masks, times = np.unique(rejected, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "mask": pa.array([*masks.tolist(), *[None] * len(names)], pa.int64()), "rule": pa.array([*[None] * len(masks), *names], pa.string()),
                "n": pa.array([*times.tolist(), *[0] * len(names)], pa.int64()), "seconds": pa.array([*[0.0] * len(masks), *seconds], pa.float64())})

    return trial


def greedy_order(names: list[str], seconds: dict[str, float], masks: dict[int, int]) -> list[str]:
    """Rules by texts rejected for a second, each counted on what the rules before it leave; then by cost."""
    left, order, open_ = dict(masks), [], list(enumerate(names))
    while open_:
        gain = lambda r: sum(n for m, n in left.items() if m >> r[0] & 1) / max(seconds.get(r[1], 0.0), 1e-9)  # noqa: E731, B023
        best = max(open_, key=lambda r: (gain(r), -seconds.get(r[1], 0.0)))  # noqa: B023
        open_.remove(best)
        order.append(best[1])
        left = {m: n for m, n in left.items() if not m >> best[0] & 1}
    return order


def choose_order(docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] = RULES, sample_texts: int = SAMPLE_TEXTS) -> list[str]:
    """The order of the rules by a sample of about ``sample_texts`` texts; what reaches the driver is a row per pattern and rule."""
    total = docs.count()
    sample = docs.select(text_col).sample(fraction=min(1.0, sample_texts / max(total, 1)), seed=SEED)
    found = sample.mapInArrow(_trial(rules), "mask long, rule string, n long, seconds double")
    found = found.groupBy("mask", "rule").agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds")).collect()
    seconds, masks = {r.rule: r.seconds for r in found if r.rule}, Counter({r["mask"]: r.n for r in found if r.rule is None})
    return greedy_order(list(rules), seconds, masks)


def judge(texts: Texts, rules: list[Rule]) -> np.ndarray:
    """Whether each text passes all rules; a rule sees only what the ones before it passed."""
    kept, alive = np.ones(len(texts), bool), np.arange(len(texts))
    for rule in rules:
        if not len(alive):
            break
        bad = rule(texts)
        kept[alive[bad]] = False
        if bad.any():
            alive, texts = alive[~bad], texts.take(~bad)
    return kept


def _cascade(rules: list[Rule]):
    def cascade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in runs(_texts(batch.column(1))):
                part = batch.slice(first, end - first)
                found = measure(_texts(part.column(1)))
                failed = base(found)
                kept = np.zeros(len(found), bool)
                kept[~failed] = judge(found.take(~failed), rules)
                verdict = pa.StructArray.from_arrays(
                    [*[pa.array(found.stats[s].astype(np.int64)) for s in STATS], pa.array(failed), pa.array(kept)], names=[*STATS, "base_failed", "kept"])
                yield pa.RecordBatch.from_arrays([part.column(0), verdict], names=["row", "_verdict"])

    return cascade


def apply_rules(
    docs: DataFrame, text_col: str = "text", rules: dict[str, Rule] = RULES, sample_texts: int = SAMPLE_TEXTS, result: str = "quality_rules"
) -> DataFrame:
    """All rows with a struct column ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Words are runs of anything but blanks; ``word_chars`` their code points; ``n_symbols`` the characters of ``#*$%&|<>``;
    ``n_dup_lines`` the lines with a word that equal an earlier line; ``n_repeat_words`` the words in windows of three that
    the text has twice or more. A text fails the base rules with under 50 words or over half of them repeated; then, or when
    any other rule rejects it, it is not kept. A NULL text is the empty one: all counts 0, base_failed. Each row is judged
    by its own text alone, so repeated rows, ties and NULL ids change nothing; very long texts are one run of their own. An
    empty table gives no rows. Other columns are passed on whatever their names; one named as the result is replaced.
    """
    order = [name for name in choose_order(docs, text_col, rules, sample_texts) if name != "base"]
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("_text"))
    counts = ", ".join(f"{s}: bigint" for s in STATS)
    schema = f"row {packed.schema['row'].dataType.simpleString()}, _verdict struct<{counts}, base_failed: boolean, kept: boolean>"
    out = packed.mapInArrow(_cascade([rules[name] for name in order]), schema)
    return with_result(out.withColumnRenamed("_verdict", result), result)
