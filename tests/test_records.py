"""Strict records: one test per kind of damage, and commits that two writers want."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest

from lakeaudit.sources.records import DecodingError, read_records, record_problems, schema_problems
from lakeaudit.streaming import runner
from lakeaudit.streaming.runner import ReviewStateError, load_state, publish, review_next

SCHEMA = "n bigint NOT NULL, name string, day date, ok boolean, share double, small int"
GOOD = {"n": 1, "name": "a", "day": "2026-04-05", "ok": True, "share": 0.5, "small": 3}

DAMAGE = [
    ({}, []),
    ({"name": None, "day": None, "ok": None, "share": None, "small": None}, []),
    ({"share": 2}, []),
    ({"n": None}, [("null", "n")]),
    ({"n": "1"}, [("retyped", "n")]),
    ({"n": 1.5}, [("retyped", "n")]),
    ({"n": 2**63}, [("retyped", "n")]),
    ({"small": 2**31}, [("retyped", "small")]),
    ({"name": 7}, [("retyped", "name")]),
    ({"name": {"a": 1}}, [("retyped", "name")]),
    ({"day": "2026-4-5"}, [("retyped", "day")]),
    ({"day": "2026-02-30"}, [("retyped", "day")]),
    ({"day": 20260405}, [("retyped", "day")]),
    ({"ok": "true"}, [("retyped", "ok")]),
    ({"share": "0.5"}, [("retyped", "share")]),
    ({"more": 1}, [("extra", "more")]),
    ({"N": 1}, [("extra", "N")]),
    ({"n": [1], "more": None}, [("retyped", "n"), ("extra", "more")]),
]
WHOLE = ["", "null", "[]", "7", '"n"', "{", '{"n": 1', '{"n": 1, "n": 2}', None]


def test_each_kind_of_damage(spark):
    records = [(i, json.dumps({**GOOD, **change})) for i, (change, _) in enumerate(DAMAGE)]
    missing = [(100 + i, json.dumps({k: v for k, v in GOOD.items() if k != name})) for i, name in enumerate(GOOD)]
    whole = [(200 + i, text) for i, text in enumerate(WHOLE)]
    frame = spark.createDataFrame([*records, *missing, *whole], "i int, value string")
    got = {r.i: [(p.kind, p.field) for p in r.problems] for r in record_problems(frame, SCHEMA).collect()}
    want = {i: problems for i, (_, problems) in enumerate(DAMAGE)}
    want |= {100 + i: [("missing", name)] for i, name in enumerate(GOOD)}
    want |= {200 + i: [("malformed", None)] for i in range(len(WHOLE))}
    assert got == want


def test_read_records(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    for folder, second in ((good, GOOD), (bad, {**GOOD, "n": "x", "more": 1})):
        folder.mkdir()
        (folder / "part.json").write_text(json.dumps(GOOD) + "\n" + json.dumps(second) + "\n")
    rows = read_records(spark, str(good), SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "a", date(2026, 4, 5), True, 0.5, 3)] * 2
    with pytest.raises(DecodingError, match=r"extra more \(1\); retyped n \(1\)"):
        read_records(spark, str(bad), SCHEMA)


def test_schema_problems(spark):
    stored = spark.createDataFrame([], "a int, b string, d int").schema
    assert schema_problems(stored, "a int, b string, d int") == []
    assert schema_problems(stored, "a bigint, b string, c int") == ["missing c", "extra d", "retyped a: int, not bigint"]


def test_a_name_is_published_once(spark, tmp_path):
    """Eight writers of one name: one of them succeeds, with its whole text, and no draft is left."""
    folder = str(tmp_path / "commits")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: publish(spark, folder, "1.json", str(i) * 1000), range(8)))
    assert sum(won) == 1
    assert (tmp_path / "commits/1.json").read_text() == str(won.index(True)) * 1000
    assert not any((tmp_path / "commits/_drafts").glob("[!.]*"))


def test_two_writers_of_one_sequence(spark, tmp_path, monkeypatch):
    """The second writer commits while the first is between reading the state and its own commit."""
    (tmp_path / "lake/year=2026/month=04/day=06").mkdir(parents=True)
    lake, work, commit, other = str(tmp_path / "lake"), str(tmp_path / "work"), runner._commit, []

    def late(*args):
        if not other:
            other.append(None)
            other[0] = review_next(spark, lake, work, 0)
        return commit(*args)

    monkeypatch.setattr(runner, "_commit", late)
    step = review_next(spark, lake, work, 0)
    assert step.state == other[0].state == "blocked" and step.folder != other[0].folder
    names = sorted(p.name for p in (tmp_path / "work/commits").glob("[!._]*"))
    assert names == ["000000000001.json", "000000000002.json"]
    assert load_state(spark, work).sequence == 2

    (tmp_path / "work/commits/000000000002.json").write_text('{"sequence": 2, "run_id": "x", "latest_reviewed_day": null}')
    with pytest.raises(ReviewStateError, match="missing snapshots_run_id"):
        load_state(spark, work)
