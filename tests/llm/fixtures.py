"""Small tables with the cases that every operator has to meet, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, `key` long"


def words_of(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def corpus(seed: int = 7, plain: int = 60) -> list[tuple]:
    """Texts with copies, near copies, shared lines and passages, NULLs, empty and long texts; columns that clash with inner names."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefghäéñ") for _ in range(rng.randint(1, 8))) for _ in range(500)]
    sentence = lambda n: " ".join(rng.choice(stock) for _ in range(n))
    shared_line, passage = "  Shared LINE of many\t", sentence(90)
    texts: list[str | None] = [None, "", " ", "\n", "a", "a b", "A  B", "\n\n"]
    for i in range(plain):
        lines = [sentence(rng.randint(1, 60)).capitalize() + "." for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), shared_line if i % 2 else shared_line.upper())
        if i % 5 == 0:
            lines.append(passage)
        texts.append("\n".join(lines))
    for _ in range(25):
        base = rng.choice([t for t in texts if t and len(t) > 40])
        texts.append(base)
        words = base.split(" ")
        words[rng.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    texts += [texts[12]] * 30 + ["x" * 5000, "ab " * 3000, sentence(4000)]
    rows = [(i, t, rng.choice(["en", "de", None]), f"s{i % 3}", len(t or ""), f"r{i}", -i) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA).repartition(5)


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
