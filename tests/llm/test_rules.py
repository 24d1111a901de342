"""Quality rules against a plain version; the order of the cascade never changes a verdict."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from lakeaudit.llm import quality_rules

from .fixtures import SCHEMA, corpus, frame

BLANK = "\x20\x09-\x0d"


def plain(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    n, chars, symbols, again = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(repeated) > 50 * n
    letters = lambda w: sum(c.isalpha() for c in w)
    loud = lambda w: re.search("^[^a-zäéñ]*$", w) and re.search("[A-ZÄÉÑ]{2}", w) and not re.search("[a-zäéñ].*[A-ZÄÉÑ]{2}", w)
    rules = (
        not 3 * n <= chars <= 12 * n, 10 * symbols > n, again >= 3 and 10 * again > 3 * len(lines), 5 * sum(not letters(w) for w in words) > n,
        10 * sum(bool(loud(w)) for w in words) > 4 * n, 4 * text.count("!") > n,
        10 * sum(bool(re.search(f"^[{BLANK}]*[-*•‣●◦]", x)) for x in lines) > 9 * len(lines),
        10 * sum(bool(re.search(f"(\\.\\.\\.|…)[{BLANK}]*$", x)) for x in lines) > 3 * len(lines),
        10 * max(Counter(words).values(), default=0) > 3 * n, 10 * max(Counter(zip(words, words[1:], strict=False)).values(), default=0) > n)
    return (n, chars, symbols, again, len(repeated), failed, not (failed or any(rules))), rules


def texts_of(seed: int) -> list[str]:
    """One kind of text for each rule, and mixtures at their thresholds."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefgäéñ") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    out = []
    for kind in range(240):
        words = [rng.choice(stock) for _ in range(rng.choice([49, 50, 51, 80, 300]))]
        share = rng.choice([0.05, 0.1, 0.19, 0.25, 0.3, 0.42, 0.95])
        change = [lambda w: w + "#", str.upper, lambda w: w + "!!", lambda w: "12", lambda w: "the", lambda w: w * 6, lambda w: "x"][kind % 7]
        words = [change(w) if rng.random() < share else w for w in words]
        if kind % 5 == 0:
            words = sum(([w, "same", "pair"] if rng.random() < share / 2 else [w] for w in words), [])
        size = rng.choice([4, 9, 1000])
        lines = [" ".join(words[i : i + size]) for i in range(0, len(words), size)]
        lines = [rng.choice(["- ", "• ", ""]) + x + rng.choice(["...", "… ", ""]) if kind % 3 == 0 else x for x in lines]
        out.append("\n".join(lines + lines[: int(len(lines) * share) if kind % 4 == 0 else 0]))
        few = [rng.choice(stock) for _ in range(9)]
        lines = [" ".join(rng.choice(stock) for _ in range(15)) for _ in range(6)] + [rng.choice(few) for _ in range(kind % 30)]
        out.append("\n".join(rng.sample(lines, len(lines))))
    return out


def test_rules(spark):
    rows = corpus() + [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(texts_of(5))]
    rows += [(None, "a " * 60, None, None, None, None, None)] * 2
    docs = frame(spark, rows)
    out = quality_rules.apply_rules(docs, sample_texts=100)
    assert out.columns == [*docs.columns, "quality_rules"]
    got = sorted(((r.doc_id, r.text, *r.quality_rules) for r in out.collect()), key=repr)
    want = [(r[0], r[1], *plain(r[1])[0]) for r in rows]
    assert got == sorted(want, key=repr)
    seen = np.array([plain(r[1])[1] for r in rows if not plain(r[1])[0][5]]).sum(axis=0)
    assert (seen > 0).all() and sum(w[-1] for w in want) > 50  # each rule rejects something that passed the base rules


def test_rules_empty_and_sample_of_nothing(spark):
    assert quality_rules.apply_rules(spark.createDataFrame([], SCHEMA)).count() == 0
    one = frame(spark, [(1, None, None, None, None, None, None)])
    assert quality_rules.choose_order(one, sample_texts=0) and quality_rules.apply_rules(one).first().quality_rules == (0, 0, 0, 0, 0, True, False)


def test_order():
    seconds = {"slow": 10.0, "cheap": 1.0, "same": 1.0, "useless": 0.1}
    masks = {0b0001: 40, 0b0110: 10, 0b0101: 5, 0b0000: 50}  # slow rejects 45, cheap 10, same 15
    assert quality_rules.greedy_order(list(seconds), seconds, masks) == ["same", "slow", "useless", "cheap"]


def test_order_never_matters_and_rejected_texts_are_not_seen():
    texts = quality_rules.measure(pa.array(texts_of(8)))
    names, seen = list(quality_rules.RULES), []
    want = quality_rules.judge(texts, list(quality_rules.RULES.values()))
    for seed in range(6):
        random.Random(seed).shuffle(names)
        assert (quality_rules.judge(texts, [quality_rules.RULES[n] for n in names]) == want).all()
    watch = lambda rule: lambda t: (seen.append(len(t)), rule(t))[1]
    quality_rules.judge(texts, [watch(quality_rules.RULES[n]) for n in names])
    assert seen == sorted(seen, reverse=True) and seen[-1] < len(texts)
