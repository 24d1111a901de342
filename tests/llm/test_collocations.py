"""Collocations against a plain version, with lists so short that the search stops early."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from lakeaudit.llm import collocations

from .fixtures import LOWER, SCHEMA, corpus, frame


def plain(rows, longest: int, least: int, percent: int, top: int) -> list[tuple]:
    counts, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    dropped = set()
    for (lang, *words), a in candidates.items():
        for k in range(2, len(words)):
            dropped |= {q for i in range(len(words) - k + 1) for q in [(lang, *words[i : i + k])] if 100 * a >= percent * candidates[q]}
    out = []
    for (lang, *words), a in candidates.items():
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        if (lang, *words) not in dropped:
            out.append((lang, -score, -a, " ".join(words).encode(), left, right, total[lang]))
    out.sort()
    place = Counter()
    for lang, *_ in out:
        place[lang] += 1
    listed, at = [], Counter()
    for lang, score, a, phrase, left, right, n in out:
        at[lang] += 1
        if at[lang] <= top:
            listed.append((lang, at[lang], phrase.decode(), -a, left, right, n, -score))
    return listed


def phrases(seed: int) -> list[tuple]:
    """Few words in a skewed mix, fixed phrases of two to four words, marks and blanks of all kinds; four languages, one NULL."""
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(60)] + ["é", "Ä", "x-y", "(a", "#", "漢字"]
    fixed = [rng.sample(stock + ["rare1", "rare2", "Rare3"], rng.randint(2, 4)) for _ in range(25)]
    rows = []
    for i in range(400):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else [stock[min(int(rng.expovariate(0.08)), len(stock) - 1)]] for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "; "] if rng.random() < 0.3 else [" "]) for p in parts for w in p)
        rows.append((i, text, rng.choice(["en", "en", "de", "zu", None]), "s", 0, "w", 1))
    return rows + [(None, "a a a a a a a a a a a a", "one", "s", 0, "w", 1), (7, None, None, None, None, None, None), (8, "", "de", None, None, None, None)]


@pytest.mark.parametrize(("top", "depths", "longest"), [(7, (2, 16), 3), (40, (1, 3), 3), (2000, (2, 16), 3), (12, (2, 16), 2)])
def test_collocations(spark, monkeypatch, top, depths, longest):
    monkeypatch.setattr(collocations, "DEPTHS", depths)
    monkeypatch.setattr(collocations, "COUNT_BYTES", 3000)
    rows = corpus() + phrases(top)
    out = collocations.collocations(frame(spark, rows), max_words=longest, top=top)
    want = plain(rows, longest, 10, 50, top)
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {len(w[2].split()) for w in want} >= set(range(2, longest + 1))


def test_only_what_can_be_listed_is_expanded(spark, monkeypatch):
    """The first round counts a part of the triples; the answer is whole all the same, ties at the end of the list included."""
    rows = phrases(3) * 3
    seen = []
    count = collocations._count_triples

    def watched(begin, end):
        seen.append(sum(int(x).bit_count() for x in begin.value[0]))
        return count(begin, end)

    monkeypatch.setattr(collocations, "_count_triples", watched)
    got = collocations.collocations(frame(spark, rows), top=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, 3, 10, 50, 3))
    few = sum(seen)
    seen.clear()
    collocations.collocations(frame(spark, rows), top=2000).count()
    assert few < sum(seen)


def test_collocations_empty_and_exact(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(frame(spark, [(1, "too few words", "en", None, None, None, None)])).count() == 0
    with pytest.raises(ValueError, match="two or three"):
        collocations.collocations(frame(spark), max_words=4)
    a, left, right = 2_999_999_999_999_999, 3_000_000_000_000_001, 3_000_000_000_000_007
    one = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.score("a", "l", "r")).first()[0]
    assert one == 1_000_000 * a * a // (left * right)
