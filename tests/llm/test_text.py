"""Tokens, archives, templates, surrogates and perplexities against plain versions."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import pyarrow as pa
import pytest

from lakeaudit.llm import bpe, kneser_ney, queries, shared, surrogates, templates, warc

from .fixtures import SCHEMA, corpus, frame

NONE = [None] * 5


# ---- BPE

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    "<|endoftext|>", "a<|startoftext|>B<|endoftext|><|endof", "it's 'S he'LL x'd", "a" * 3000, "!" * 2000, "q\x1fz\x1c", "\u0085 　é", "ΣΑΣ Σ", "İstanbul ǅ ﬁ Å",
    "日本語 한국어 🎉👍🏽‍", "²½Ⅷ٣５", "­​﻿", "</w> </w", "don't\tstop\r\n", "é ́",
]


def test_bpe_equals_library(spark):
    path = queries.vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(3)
    letters = ["abcdefghij", "aaab", "etaoinshr' ", "éñßÄÖ 0123.!?", "Σσς日本🎉 \n"]
    odd = ODD + ["".join(rng.choice(rng.choice(letters) + rng.choice(letters)) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    rows = corpus() + [(1000 + i, t, *NONE) for i, t in enumerate(odd)]
    out = bpe.encode_documents(frame(spark, rows), path, fields=("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"))
    assert out.columns == [*frame(spark, rows).columns, "bpe"]
    got = {r.doc_id: r.bpe for r in out.collect()}
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        mine = got[r[0]]
        assert (mine.ids, mine.decoded, mine.n_tokens) == (ids, text, len(ids)), r[1]
        assert mine.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), path).count() == 0


# ---- WARC


def test_bpe_task_leaves_nothing_behind(monkeypatch):
    """A worker lives on for other steps: a task forgets its words, and Arrow's pool gives back what was freed."""
    path, released = queries.vocabulary_path(), []
    batch = pa.RecordBatch.from_pydict({"row": [{"id": i} for i in range(3)], "text": ["some words of a text", None, "other words"]})
    monkeypatch.setattr(shared.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: released.append(True)))
    out = list(shared.handing_back(bpe._apply(path, ("n_tokens",)))(iter([batch])))
    assert sum(len(x) for x in out) == 3 and released == [True]
    assert not bpe.load(path).recent and not bpe.load(path).older and not bpe.load(path).known


def test_warc_round_trip(spark):
    pages = [(i, f"http://x/{i}", t) for i, t in enumerate(["a", "b", "a", None, "", "é" * 70000, "a", "b\r\n\r\nc"])] + [(None, None, "z")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    archives = warc.write_archives(warc.page_records(table))
    records = {r.record_id: r for r in warc.read_archives(archives).collect()}
    groups = defaultdict(list)
    for i, _, t in pages:
        groups[(t or "").encode()].append(i)
    assert len(records) == len(pages) and not [r for r in records.values() if r.error]
    for payload, ids in groups.items():
        for i in ids:
            r = records[f"urn:page:{i}"] if i is not None else next(x for x in records.values() if x.record_id.startswith("urn:sha1:"))
            best = max(x for x in ids if x is not None) if i is not None else None
            assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
            assert (r.record_type, r.refers_to) == (("response", None) if i == best else ("revisit", f"urn:page:{best}"))
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload


def test_warc_small_payloads_are_no_revisits(spark):
    table = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], "page_id long, url string, html string")
    got = sorted((r.record_id, r.kind) for r in warc.page_records(table, min_bytes=3).collect())
    assert [k for _, k in got] == ["response", "response", "revisit", "response"]


def test_warc_damage():
    parts = [warc.record_bytes("response", f"urn:page:{i}", "http://x", b"payload %d" % i * 100, None, "2000-01-01T00:00:00Z") for i in range(3)]
    whole = b"".join(parts)
    assert [r["error"] for r in warc.records_of("p", whole)] == [None] * 3
    cut = list(warc.records_of("p", whole[:-20]))
    assert [r.get("error") for r in cut][:2] == [None, None] and "ends" in cut[2]["error"] and cut[2]["offset"] == len(parts[0]) + len(parts[1])
    assert list(warc.records_of("p", b"no archive"))[0]["error"] and list(warc.records_of("p", b"")) == []
    wrong = warc.record_bytes("response", "urn:page:9", "u", b"abc", None, "d")
    import zlib

    text = zlib.decompress(wrong, 31).replace(b"abc", b"abd")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    assert "digest differs" in next(warc.records_of("p", pack.compress(text) + pack.flush()))["error"]


def test_warc_reads_on_after_damage():
    parts = [warc.record_bytes("response", f"urn:page:{i}", "http://x", random.Random(i).randbytes(3000), None, "2000-01-01T00:00:00Z") for i in range(6)]
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    for at, junk in ((0, b"\0" * 5), (starts[2] + 40, b"\xff" * 30), (starts[4] - 9, b"\0" * 20), (starts[3], warc.GZIP_HEAD + b"no record")):
        whole = bytearray(b"".join(parts))
        whole[at : at + len(junk)] = junk
        got = list(warc.records_of("p", bytes(whole)))
        hit = {i for i in range(6) if starts[i] < at + len(junk) and at < starts[i + 1]}
        assert [r["record_id"] for r in got if not r["error"]] == [f"urn:page:{i}" for i in range(6) if i not in hit]
        assert [r["offset"] for r in got if r["error"]] == [starts[min(hit)]] if len(hit) == 1 else True
    # junk between records, and an end that is cut off
    got = list(warc.records_of("p", parts[0] + b"junk" + parts[1] + parts[2][:-30]))
    assert [r.get("record_id") for r in got] == ["urn:page:0", None, "urn:page:1", None] and "skipped 4 bytes" in got[1]["error"]


# ---- templates


def plain_leaks(docs, items, window):
    """The same windows, found by comparing every window with every other."""
    def tokens(text):
        text = re.sub(r"(?<=[^\W_][ ])(?=[A-ZÄÖÜ][a-zäöüß])|(?<=[,;)] )(?=[A-ZÄÖÜ][a-zäöüß])", "\x01", text or "")
        text = re.sub(r"(?<=\d)[.,](?=\d)", "\x02", text)
        text = re.sub(r"(?<=\d)(?=[^\W\d_])|(?<=[^\W\d_])(?=\d)", " ", text)
        text = re.sub(r"[^\w\x01\x02]+|_", " ", text)
        values = re.sub("(\x01[^ ]+) (?=\x01)", r"\1", text).strip().lower().split()
        out = []
        for v in values:
            if v[0].isdigit():
                out.append("<num>")
            elif v in templates.UNITS and out and out[-1] == "<num>":
                out.append("<unit>")
            else:
                out.append("<name>" if v[0] == "\x01" else v)
        return out, values

    slots = lambda t, v: [b for a, b in zip(t, v, strict=True) if a[0] == "<"]
    cuts = lambda text: [(i, t[i : i + window], v[i : i + window]) for t, v in [tokens(text)] for i in range(max(1, len(t) - window + 1)) if t]
    mine = [(item, t, slots(t, v)) for item, text in items for _, t, v in cuts(text) if sum(x[0] != "<" for x in t) * 100 >= len(t) * templates.LITERAL_PERCENT]
    out = set()
    for doc, text in docs:
        t, v = tokens(text)
        for item, theirs, values in mine:
            for i in range(len(t) - len(theirs) + 1):
                own = slots(t[i : i + len(theirs)], v[i : i + len(theirs)])
                if t[i : i + len(theirs)] == theirs and len(set(zip(own, values, strict=True))) == len(set(own)) == len(set(values)):
                    out.add((doc, item, i))
    return out


@pytest.mark.parametrize("broadcast", [1 << 17, 0])
def test_templates(spark, monkeypatch, broadcast):
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", broadcast)
    question = "A train leaves at {} {} from {} and then {} walks {} miles to the old station, how many hours does {} need for it"
    items = [(1, question.format("12.5", "km", "Paris", "Anna", "30", "Anna")), (2, "short item"), (3, None), (4, ""), (5, "1 2 3"), (1, "repeated item of its own")]
    docs = [
        (1, "so we see, " + question.format("99", "kg", "Berlin", "Otto Maier", "7", "Otto Maier")), (2, "so " + question.format("99", "kg", "Rome", "Otto", "7", "Emma")),
        (3, "a short item here"), (4, None), (5, ""), (6, "nothing here 1 2 3"), (7, items[0][1]), (8, "a train leaves at noon"), (7, items[0][1]), (9, "word " * 500),
    ]
    table = frame(spark, [(i, t, *NONE) for i, t in docs])
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = Counter((d, i) for d, i, _ in plain_leaks(docs[:8] + docs[9:], items, 13))
    got = {(r.id, r.item): r.n_windows for r in templates.leaks(table, bench).collect()}
    assert got == want and {(1, 1), (7, 1), (3, 2)} <= set(got)
    assert {r.item: r.n_same for r in templates.leaks(table, bench).where("id = 7").collect()} == {1: got[7, 1]}
    kept = templates.drop_leaks(table, bench)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {a for a, _ in got})


def test_templates_of_slots(spark):
    """An item of numbers and units: a verbatim copy is found, other numbers are not."""
    items = [(1, "3 + 4 km = 7 km; 5 + 12 = 17, 8, 13, 21, 34, 55, 89, 144")]
    docs = [(1, "we see 3 + 4 km = 7 km; 5 + 12 = 17, 8, 13, 21, 34, 55, 89, 144 here"), (2, "we see 1 + 4 km = 5 km; 5 + 12 = 17, 8, 13, 21, 34, 56, 90, 146 here")]
    table, bench = frame(spark, [(i, t, *NONE) for i, t in docs]), spark.createDataFrame(items, "item_id int, text string")
    got = templates.leaks(table, bench, verbatim=True).collect()
    assert [(r.id, r.item) for r in got] == [(1, 1)] and got[0].n_same == got[0].n_windows > 0


def test_templates_of_initial_names(spark):
    """Names that begin a text or sentence are slots as well, wherever the copy has them."""
    items = [(1, "Anna has 5 apples. Ben has 3 apples. How many more does Anna have than Ben?"), (2, "Maria Lopez walks along the river")]
    docs = [
        (1, "By Karl. Otto has 7 apples. Emma has 2 apples. How many more does Otto have than Emma?"), (2, "and Otto has 7 apples. Emma has 2 apples. How many more does Otto have than Emma?"),
        (3, "Otto has 7 apples. Emma has 2 apples. How many more does Emma have than Emma?"), (4, "today Karl Graf walks along the river"), (5, items[0][1]),
    ]
    table, bench = frame(spark, [(i, t, *NONE) for i, t in docs]), spark.createDataFrame(items, "item_id int, text string")
    assert {(r.id, r.item) for r in templates.leaks(table, bench).collect()} == {(1, 1), (2, 1), (4, 2), (5, 1)}


def test_templates_read_few_texts_closely(spark, monkeypatch):
    """Only texts that can share a window are read closely, and no window is lost by that."""
    items = [
        (1, "A train leaves at 12.5 km from Paris and then Anna walks 30 miles to the old station, how many hours"), (2, "3 + 4 km = 7 km; 5 + 12 = 17, 8, 13, 21, 34, 55"),
        (3, "Ο ΔΡΌΜΟΣ.ΤΗΣ πόλης 25kg είναι μακρύς"), (4, "x1y İki Σ"), (5, "ein\ue000wort nur"), (6, "in Rome 5 at 7 of 9 by 11 on 13 as 15"), (7, "e\u03015 a\u0301b2"), (8, "zzz"),
    ]
    odd = ["ο δρόμος.της Πόλης 25 kg Είναι μακρύς", "x1y İki Σ", "x 1 Y i\u0307ki ς", "Ein wort nur", "einwort nur", "in Oslo 6 at 8 of 1 by 12 on 14 as 16", "(E\u03015 A\u0301b2)", "Zzz!", "a zzz b"]
    docs = [(i, t) for i, t in enumerate([*(t for _, t in items), *(t.upper() for _, t in items), *(f"so, {t} 1" for _, t in items), *odd, None, "", "\u0301", "nothing of that"])]
    table, bench = frame(spark, [(i, t, *NONE) for i, t in docs]), spark.createDataFrame(items, "item_id int, text string")
    found = lambda **how: sorted(tuple(r) for r in templates.leaks(table, bench, **how).collect())
    for broadcast in (0, 1 << 20):
        monkeypatch.setattr(templates, "BROADCAST_HASHES", broadcast)
        got = {verbatim: found(verbatim=verbatim) for verbatim in (False, True)}
    keyed = frame(spark, [(i, "word of no item " * 9, *NONE) for i in range(9)] + [(9, items[0][1], *NONE)])
    windows = templates.benchmark_windows(bench, "item_id", "text", 13, 40, True)
    assert [r.doc_id for r in templates._with_anchor(keyed, windows).collect()] == [9]
    none = templates.benchmark_windows(spark.createDataFrame([(1, "\u0301 " * 20 + "a")], "item_id int, text string"), "item_id", "text", 13, 40)
    assert none.where("anchor IS NULL").count() and templates._with_anchor(keyed, none).count() == 10
    monkeypatch.setattr(templates, "_with_anchor", lambda keyed, windows: keyed)
    assert got == {verbatim: found(verbatim=verbatim) for verbatim in (False, True)} and {r[2] for r in got[True]} == {i for i, _ in items}


def test_templates_empty(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id int, text string")
    assert templates.leaks(docs, bench).count() == 0 and templates.drop_leaks(frame(spark), bench).count() == len(corpus())


# ---- surrogates

PRIVATE = [
    (1, "Mail and.34@mail7.example.com or x@mail7.example.com, call +1 (017) 555-7713. Mrs. Anna Smith met Mr Smith.\nIP 129.38.82.176."),
    (2, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" card 4111 1111 1111 1111, 9807915762804490, 123-45-6789 on 2024-01-02 v1.2.3'),
    (3, None), (4, ""), (5, "clean text 2.0, 1 000 000 pages, A.B"), (6, "and.34@mail7.example.com again, Г-жа Анна Петрова"), (6, "and.34@mail7.example.com again, Г-жа Анна Петрова"),
]


def test_surrogates(spark):
    table = frame(spark, [(i, t, *NONE) for i, t in PRIVATE])
    out = surrogates.replace_entities(table, "k").collect()
    text = {r.doc_id: r.text for r in out}
    assert len(out) == len(PRIVATE) and (text[3], text[4], text[5]) == (None, "", PRIVATE[4][1])
    for secret in ("and.34@", "mail7", "017", "7713", "Anna", "Smith", "129.38", "04dbeb", "4111", "980791", "123-45", "Петрова"):
        assert not [t for t in text.values() if t and secret in t], secret
    assert re.fullmatch(
        r"Mail ([a-z]{3}\.\d\d)@([a-z]{4}\d\.[a-z]{7}\.com) or [a-z]@\2, call \+1 \(\d{3}\) \d{3}-\d{4}\. Mrs\. (\w+) (\w+) met Mr \4\.\nIP \d+\.\d+\.\d+\.\d+\.", text[1])
    assert text[6].split(" ")[0] == text[1].split(" ")[1] and re.search(r"Г-жа [А-Яё]\w+ [А-Я]\w+", text[6])
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4}),", text[2])[1].replace(" ", "")
    assert sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(card)) % 10 == 0
    assert "2024-01-02 v1.2.3" in text[2] and {r.doc_id: r.pii.n_entities for r in out} == {1: 6, 2: 4, 3: 0, 4: 0, 5: 0, 6: 2}
    again = {r.doc_id: r.text for r in surrogates.replace_entities(table, "other key").collect()}
    assert again[1] != text[1]
    assert surrogates.replace_entities(spark.createDataFrame([], SCHEMA), "k").count() == 0


def test_surrogates_stay_distinct(spark):
    """Far more names than there are in the lists, many addresses of one domain, short addresses, surrogates' likely values."""
    letters = [chr(97 + i // 676) + chr(97 + i // 26 % 26) + chr(97 + i % 26) for i in range(10000)]
    rows = [("name", f"Mr N{x}", 1) for x in letters] + [("name", f"Ms Ada N{x}", 1) for x in letters[:300]]
    rows += [("name", f"{t} {x} Smith", 1) for x in surrogates.NAMES["latin_m"] for t in ("Mr", "Mr.", "Herr")] + [("name", f"Mr {x}", 1) for x in surrogates.NAMES["latin_l"]]
    rows += [("name", f"Κύριος Α{x}", 1) for x in "αβγδεζηθικλμνξοπρστυφχψω"]
    rows += [("email", f"p{x}@corp.example.com", 1) for x in letters[:1000]] + [("email", f"{a}@{b}.org", 1) for a in "abcdefghijklmnop0123456789" for b in "abcdefghijklmnopqrstuvwxyz"]
    rows += [("ip", f"1.1.1.{i}", 1) for i in range(100)] + [("ssn", f"123-45-{i}", 1) for i in range(1000, 1300)]
    table = surrogates.surrogate_table(spark.createDataFrame(rows, "kind string, entity string, _n long"), "k").collect()
    assert sorted((r.kind, r.entity) for r in table) == sorted(r[:2] for r in rows)
    assert len({r.surrogate for r in table}) == len(table) and not {r.surrogate for r in table} & {r.entity for r in table}
    new = {r.entity: r.surrogate for r in table}
    for r in table:
        assert re.fullmatch(PLAIN[r.kind], r.surrogate), r
        if r.kind == "name":
            title, *_, last = r.entity.split(" ")
            assert r.surrogate.split(" ")[0] == title and r.surrogate.count(" ") == r.entity.count(" ")
            lists = [set(surrogates.NAMES[("greek_" if title == "Κύριος" else "latin_") + k]) for k in ("f" if title == "Ms" else "m", "l")]
            for name, of in zip(r.surrogate.split(" ")[1:], lists[-r.entity.count(" "):], strict=True):
                assert set(name.split("-")) <= of, r
    for of in (lambda e: e.split("@")[1] if "@" in e else None, lambda e: e.split(" ")[-1] if " " in e else None):
        pairs = {(of(e), of(x)) for e, x in new.items() if of(e)}
        assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    assert {len({new[f"{t} {x} Smith"].split(" ", 1)[1] for t in ("Mr", "Mr.", "Herr")}) for x in surrogates.NAMES["latin_m"]} == {1}


#: What surrogates of a kind have to look like, written down apart from the patterns that find entities.
PLAIN = {
    "name": r"\S+ [^\W\d_]+(-[^\W\d_]+)*( [^\W\d_]+(-[^\W\d_]+)*)?", "email": r"[a-z0-9]+@[a-z.]+\.(com|org)", "ip": r"\d{1,3}(\.\d{1,3}){3}", "ssn": r"\d{3}-\d\d-\d{4}",
}


def test_surrogates_equal_plain_replacement(spark):
    """The whole result against texts that are searched and put together one by one in Python, with the same table."""
    rng = random.Random(5)
    bits = ["Mr Smith", "Mrs. Anna Smith", "Г-жа Анна Петрова", "a.b@x.org", "c@x.org", "10.1.2.3", "123-45-6789", "4111 1111 1111 1111", "+1 (017) 555-7713", "2024-01-02", "v1.2.3",
            "Mr", "12", "@", "word", "\n", "é", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "GB82 WEST 1234 5698 7654 32"]
    texts = [None, "", *(" ".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(120)), "long " * 20000 + "Mr Smith " * 500]
    table = frame(spark, [(i, t, *NONE) for i, t in enumerate(texts)]).withColumnRenamed("row", "pii")
    regex = pytest.importorskip("regex")
    find = regex.compile("|".join(surrogates.PATTERNS.values()))

    def kind(text):
        return next((k for k, p in surrogates.PATTERNS.items() if regex.fullmatch(p, text) and (k != "phone" or sum(c.isdigit() for c in text) >= 9)), None)

    found = Counter(m for t in texts if t for m in set(find.findall(t)) if kind(m))
    new = surrogates.surrogate_table(spark.createDataFrame([(kind(e), e, n) for e, n in found.items()], "kind string, entity string, _n long"), "k")
    new = {r.entity: r.surrogate for r in new.collect()}
    out = surrogates.replace_entities(table, "k")
    assert out.columns == [c for c in table.columns if c != "pii"] + ["pii"]
    for r in out.collect():
        t = texts[r.doc_id]
        assert r.text == (t and find.sub(lambda m: new.get(m[0], m[0]), t))
        kinds = Counter(kind(m) for m in find.findall(t or "") if kind(m))
        assert (r.pii.n_entities, dict(r.pii.kinds)) == (sum(kinds.values()), dict(kinds))


# ---- perplexities


def plain_model(texts):
    """The model of one language in plain Python: characters as they are, one symbol for all unknown ones."""
    start = "\x02"
    counts = {3: Counter((start * 2 + t)[i : i + 3] for t in texts for i in range(len(t)))}
    for k in (2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def order(k):
        n = [0, *(sum(c == i for c in counts[k].values()) for i in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        d = [0.0]
        for i in (1, 2, 3):
            x = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else None
            d.append(x if x is not None and 0 < x < i else 0.5)
        total, taken = Counter(), Counter()
        for g, c in counts[k].items():
            total[g[:-1]] += c
            taken[g[:-1]] += d[min(c, 3)]
        return d, total, taken

    tables = {k: order(k) for k in (1, 2, 3)}

    def p(gram):
        k = len(gram)
        lower = p(gram[1:]) if k > 1 else 1 / kneser_ney.SYMBOLS
        d, total, taken = tables[k]
        if not total[gram[:-1]]:
            return lower
        c = counts[k][gram]
        return max(c - d[min(c, 3)], 0) / total[gram[:-1]] + taken[gram[:-1]] / total[gram[:-1]] * lower

    return lambda t: math.exp(-sum(math.log(p((start * 2 + t)[i : i + 3])) for i in range(len(t))) / len(t))


@pytest.mark.parametrize("at_once", [1, 16])
def test_kneser_ney(spark, monkeypatch, at_once):
    monkeypatch.setattr(kneser_ney, "LANGUAGES_AT_ONCE", at_once)
    rng = random.Random(1)
    word = {"en": ["the", "and", "thing", "ering"], "de": ["der", "und", "schein", "ung"]}
    text = lambda lang: " ".join(rng.choice(word[lang]) for _ in range(rng.randint(5, 40)))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["en", "de"] * 40)]
    rows += [(100, "ththth", "en"), (101, "dedede", "de"), (102, None, "en"), (103, "", "de"), (104, "no model", "xx"), (105, "null", None), (0, rows[0][1], "en")]
    labels = [(i, 1, 0) for i in range(0, 60)] + [(60, 1, 1), (61, 0, 0), (62, None, None), (None, 1, 0), (3, 1, 0)]
    table = frame(spark, [(i, t, lang, None, None, None, None) for i, t, lang in rows])
    out = kneser_ney.classify(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r.quality for r in out}
    for lang in ("en", "de"):
        score = plain_model([t for i, t, x in rows[:60] + rows[-1:] if x == lang])
        for i, t, x in rows:
            if x == lang and t and not set(t) - set("".join(word[lang]) + " "):
                assert got[i].perplexity == pytest.approx(score(t), rel=1e-4)
    assert not got[100].kept and not got[101].kept
    assert sum(got[i].kept for i in range(80)) >= 76
    assert all(got[i].kept and got[i].perplexity is None for i in (102, 103, 104, 105))
    kept = kneser_ney.drop_rejected(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, *_ in rows if got[i].kept)


@pytest.mark.parametrize("at_once", [1, 16])
def test_kneser_ney_of_many_characters(spark, monkeypatch, at_once):
    """More characters than the broadcast table has: all are told apart, and scrambled text is rejected."""
    monkeypatch.setattr(kneser_ney, "LANGUAGES_AT_ONCE", at_once)
    rng = random.Random(5)
    han = [chr(0x4E00 + i) for i in range(400)]
    words = {"zh": ["".join(rng.sample(han, 3)) for _ in range(300)], "en": ["the", "and", "thing", "ering"]}
    text = lambda lang: "".join(rng.choice(words[lang]) for _ in range(rng.randint(10, 40)))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["zh", "en"] * 100)]
    rows += [(300 + i, "".join(rng.sample(rows[2 * i][1], len(rows[2 * i][1]))), "zh") for i in range(40)]
    rows += [(400, rows[0][1] + "\u9f98x\U0001f389", "zh"), (401, "the \u4e00 thing", "en"), (402, None, "zh"), (0, rows[0][1], "zh"), (None, rows[2][1], "zh"), (None, rows[2][1], "zh")]
    table = frame(spark, [(i, t, lang, None, None, None, None) for i, t, lang in rows])
    out = kneser_ney.classify(table, spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(rows)
    for lang in ("zh", "en"):
        good = [t for i, t, x in rows if x == lang and i is not None and i < 200]
        monkeypatch.setattr(kneser_ney, "SYMBOLS", 7 + max(89, len(set("".join(good)))))
        score = plain_model(good)
        for r in out:
            if r.lang == lang and r.text:
                assert r.quality.perplexity == pytest.approx(score(r.text), rel=1e-4)
        monkeypatch.undo()
        monkeypatch.setattr(kneser_ney, "LANGUAGES_AT_ONCE", at_once)
    assert sum(r.quality.kept for r in out if r.doc_id is not None and 300 <= r.doc_id < 400) <= 2
    assert sum(r.quality.kept for r in out if r.doc_id is not None and r.doc_id < 200) >= 196


def test_kneser_ney_scores_every_text_once(spark):
    """Rows that come twice stay two rows, whatever they are scored with, and each row with text has a perplexity."""
    rng = random.Random(2)
    words = ["the", "and", "thing", "ering", "über", "x9"]
    # what follows two characters of the alphabet is nearly sure, so its cost is small beside the sums before it
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) + "abcdefghijklmnopqrstuvwxyz" * rng.randint(0, 300) for _ in range(150)]
    rows = [(i, t, "en", None, None, None, None) for i, t in enumerate(texts)] * 2 + [(500, "", "en", None, None, None, None)]
    rng.shuffle(rows)
    out = kneser_ney.classify(frame(spark, rows), spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    assert [r.doc_id for r in out if r.quality.perplexity is None] == [500]
    assert all(len({r.quality.perplexity for r in out if r.doc_id == i}) == 1 for i in range(150))


def test_kneser_ney_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert kneser_ney.classify(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert kneser_ney.classify(frame(spark), none).where("quality.kept").count() == len(corpus())
