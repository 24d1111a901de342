"""Byte-pair encoding by backtracking over longest token matches, and decoding with an offset table.

Merging a text pair by pair and choosing tokens greedily differ, but a sequence of tokens is what merging gives exactly when
each two neighbours are *compatible*: no merge across their border would have come before the merges that made them. So the
encoder takes the longest token that an Aho-Corasick automaton finds at a place, checks it against its left neighbour, takes
shorter ones where it does not fit, and steps back where none does. No place that failed once is tried again, so the time is
linear in the text.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import handing_back, with_result

#: Words whose tokens a task remembers; what is forgotten is encoded again.
MEMORY_WORDS = 1 << 18
#: Pairs of tokens whose compatibility a task remembers.
MEMORY_PAIRS = 1 << 19
#: Tokens that are decoded at a time.
DECODE_TOKENS = 1 << 18
#: Bytes of text that are encoded together.
RUN_BYTES = 1 << 20
#: Stands for the end-of-word mark, which is one symbol together with the character before it.
END = "￿"


def _classes(*kinds: str) -> str:
    """A regular-expression class body of all characters whose Unicode category begins with one of the letters."""
    parts, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] in kinds
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            parts.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(parts)


#: White space as Unicode defines it (fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible in Latin-1, else the next from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of a lower-casing BPE vocabulary with word ends, from a ``tokenizer.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        inner = lambda token: token.removesuffix(suffix) + END if token.endswith(suffix) and token != suffix else token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in {**vocab, **self.special}.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        texts = [inner(t) for t in self.names]
        ids = {inner(t): i for t, i in vocab.items()}
        # The pair-compatibility table: which merge joins two tokens, at which rank, and which two made a token.
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            if self.rank.get(a, -1) >= rank or self.rank.get(b, -1) >= rank or made in self.parts:
                raise ValueError("the encoder needs merges in which each token is made once, after its parts")
            self.rank_of_pair[a, b], self.parts[made], self.rank[made] = rank, (a, b), rank
        self.automaton = ahocorasick.Automaton()
        usable = {t: i for t, i in ids.items() if i in self.parts or len(t.removesuffix(END)) == 1}
        for text, i in usable.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.length = [len(t) for t in texts]
        self.shorter = [-1] * len(texts)
        for text, i in usable.items():
            self.shorter[i] = next((usable[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in usable), -1)
        self.symbols = _byte_symbols()
        letters, numbers = _classes("L"), _classes("N")
        # Fixed pattern of the vocabulary's word splitter.
        self.words = re.compile(f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^{SPACE}{letters}{numbers}]+").findall
        self.split_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.odd = re.compile("|".join(["[\x1c-\x1f]", *(re.escape(t) for t in self.special)])).search
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known: dict[int, bool] = {}
        # The offset tables: all names, and all ids in decimal, each with the space that joins them before it.
        self.name_table = pa.array([" " + t for t in self.names], pa.string())
        self.number_table = pa.array([f" {i}" for i in range(len(self.names))], pa.string())

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between a and b alone.

        Backwards in time, the later made of the two border tokens is taken apart, down to single symbols. At each step the
        two that met at the border must not have had a merge that came before the merge which took one of them in. Of equal
        merges the left one comes first: one inside a wins, one inside b loses against the border's.
        """
        into_a = into_b = len(self.rank) + 1  # rank of the merge that took the border token in
        while True:
            across = self.rank_of_pair.get((a, b))
            if across is not None and across < into_a and across <= into_b:
                return False
            made_a, made_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                into_a, a = made_a, self.parts[a][1]
            elif made_b > made_a:
                into_b, b = made_b, self.parts[b][0]
            else:  # the same merge on both sides: the right one happened later
                into_b, b = made_b, self.parts[b][0]

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one piece of the splitter, which is lower-cased and not empty."""
        symbols = self.symbols
        text = (word if word.isascii() and word.isalnum() else "".join([symbols[b] for b in word.encode("utf-8", "replace")])) + END
        size = len(text)
        longest = [-1] * size
        length, shorter, known = self.length, self.shorter, self.known
        for last, token in self.automaton.iter(text):  # of matches with one start the longest comes last
            longest[last - length[token]] = token  # one place to the left, so that the start 0 is the last item
        longest = longest[-1:] + longest[:-1]
        tokens: list[int] = []
        starts: list[int] = []
        dead = bytearray(size + 1)
        at, left, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if left < 0:
                        break
                    pair = left << 20 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = self._know(pair, left, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == size:
                    return tokens
                starts.append(at)
                at, left, token = end, token, longest[end]
            else:
                dead[at] = 1
                token, at = shorter[tokens.pop()], starts.pop()
                left = tokens[-1] if tokens else -1

    def _know(self, pair: int, left: int, right: int) -> bool:
        if len(self.known) >= MEMORY_PAIRS:
            self.known.clear()
        self.known[pair] = fits = self.compatible(left, right)
        return fits

    def forget(self) -> None:
        """Drop what a task remembered: the worker lives on for the tasks of other steps."""
        self.recent, self.older = {}, {}
        self.known.clear()

    def normal(self, text: str) -> str:
        """NFC and lower case, character by character (a final sigma is no exception)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str) -> np.ndarray:
        out = []
        for part in self.split_special(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out += [self.recent.get(w) or self._remember(w) for w in self.words(self.normal(part))]
        return np.frombuffer(b"".join(out), "<u4")

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and end.

        The splitter's pieces never hold white space, so what stands between is split off, each distinct word is encoded
        once, and its ids are copied to where it stands. Texts with special tokens, or with one of the four control
        characters that only Arrow takes for white space, go by the pattern alone.
        """
        alone = [i for i, t in enumerate(texts) if self.odd(t)]
        plain = [self.normal(t) for t in texts]
        for i in alone:
            plain[i] = ""
        words = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        distinct = words.flatten().dictionary_encode()
        recent = self.recent
        known = [b"" if not w else recent.get(w) or self._remember(w) for w in distinct.dictionary.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(x) >> 2 for x in known])])
        table = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(known), "<u4").astype(np.int32)))
        spread = table.take(distinct.indices)
        bounds = spread.offsets.to_numpy()[words.offsets.to_numpy()] if len(spread) else np.zeros(len(texts) + 1, np.int64)
        ids = spread.flatten().to_numpy()
        if alone:
            parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in alone:
                parts[i] = self.encode(texts[i]).astype(np.int32)
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, bounds

    def _remember(self, word: str) -> bytes:
        """Ids of a word with its punctuation. Two generations of words are remembered; words in use move to the new one."""
        data = self.older.get(word)
        if data is None:
            pieces = self.words(word)
            if len(pieces) == 1 and pieces[0] == word:
                data = array("I", self.encode_word(word)).tobytes()
            else:
                data = b"".join([self.recent.get(p) or self._remember(p) for p in pieces])
        if len(self.recent) >= MEMORY_WORDS:
            self.older, self.recent = self.recent, {}
        if len(word) <= 64:
            self.recent[word] = data
        return data

    def decode(self, ids: np.ndarray) -> str:
        return _spell(self.name_table, ids, np.array([0, len(ids)]))[0].decode()


def _spell(table: pa.StringArray, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each range of ids, its entries of the table in a row, without the first space; read by offset, not id by id."""
    out: list[list[bytes]] = [[] for _ in bounds[:-1]]
    for i, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if last - first > DECODE_TOKENS:  # a very long text, in parts
            for at in range(first, last, DECODE_TOKENS):
                out[i] += _spell_all(table, ids[at : min(last, at + DECODE_TOKENS)], np.array([0, min(last - at, DECODE_TOKENS)]))
    start = 0
    for i in range(len(out) + 1):  # short ones together
        full = i == len(out) or out[i]
        if full or bounds[i + 1] - bounds[start] > DECODE_TOKENS:
            if start < i:
                for k, data in enumerate(_spell_all(table, ids[bounds[start] : bounds[i]], bounds[start : i + 1] - bounds[start])):
                    out[start + k].append(data)
            start = i + 1 if full else i
    return [(b"".join(x))[1:] for x in out]


def _spell_all(table: pa.StringArray, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    taken = table.take(pa.array(ids, pa.int32()))
    data = taken.buffers()[2]
    if data is None or not len(ids):
        return [b""] * (len(bounds) - 1)
    offsets = np.frombuffer(taken.buffers()[1], np.int32, len(ids) + 1)[bounds]
    return [data[a:b].to_pybytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


#: What can be asked for, and its type.
FIELDS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}


def _apply(path: str, fields: tuple[str, ...]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        hexes = lambda items: pa.array([sha256(x).hexdigest() for x in items], pa.string())
        try:
            for batch in batches:
                texts = batch.column(1).fill_null("")
                for first, last in _runs(pc.binary_length(texts).to_numpy()):
                    ids, bounds = bpe.encode_batch(texts.slice(first, last - first).to_pylist())
                    decoded = _spell(bpe.name_table, ids, bounds) if {"decoded", "decoded_sha256"} & {*fields} else []
                    make = {
                        "n_tokens": lambda: pa.array(np.diff(bounds), pa.int64()),
                        "ids": lambda: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                        "decoded": lambda: pa.array(decoded, pa.binary()).cast(pa.string()),
                        "ids_sha256": lambda: hexes(_spell(bpe.number_table, ids, bounds)),
                        "decoded_sha256": lambda: hexes(decoded),
                    }
                    yield pa.RecordBatch.from_pydict({"row": batch.column(0).slice(first, last - first)} | {f: make[f]() for f in fields})
        finally:
            bpe.forget()

    return apply


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``RUN_BYTES`` together."""
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= RUN_BYTES:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def encode_documents(
    docs: DataFrame, vocabulary: str, text_col: str = "text", fields: tuple[str, ...] = ("ids", "decoded"), result: str = "bpe"
) -> DataFrame:
    """All rows with a struct column of the fields asked for: ``ids`` (array of int), ``decoded``, the text decoded from
    them, ``n_tokens``, ``ids_sha256`` (of the ids in decimal joined by a space) and ``decoded_sha256``.

    ``vocabulary`` is the path of a ``tokenizer.json`` with word ends that every executor can open. Ids are what merging
    gives, without special tokens at the ends; a special token's own text becomes its id. NULL and empty texts have no ids
    and decode to the empty text. An empty table gives no rows. Other columns are passed on whatever their names; one
    named as the result is replaced.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(f, FIELDS[f]) for f in fields)])
    out = rows.mapInArrow(handing_back(_apply(vocabulary, fields)), schema)
    return with_result(out.withColumn(result, F.struct(*fields)), result)
