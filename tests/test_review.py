"""Incremental review: state transitions and whole runs."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest

from lakeaudit.streaming import review
from lakeaudit.streaming.runner import ReviewStateError, drain, load_state, review_next

from . import lakegen as g


def d(day):
    return date(2026, 4, day)


def frames(spark, days, reviewed):
    return (
        spark.createDataFrame([(d(n), f) for n, f in days.items()], "partition_date date, has_files boolean"),
        spark.createDataFrame([(d(n),) for n in reviewed], "partition_date date"),
    )


SCENARIOS = [
    ({5: True, 6: True}, [], 1, ("validated", 5, None, 2)),
    ({5: True, 7: True}, [5], 2, ("validated", 7, None, 1)),
    ({5: True, 7: True}, [5, 7], 2, ("idle", None, None, 0)),
    ({5: True, 6: True, 7: True}, [5, 7], 2, ("validated", 6, None, 1)),
    ({5: True, 6: False, 7: True}, [5], 2, ("validated", 7, None, 2)),
    ({5: True, 6: False, 7: True}, [5, 7], 2, ("blocked", None, 6, 1)),
    ({5: True, 8: True, 9: True, 10: True}, [5], 2, ("validated", 8, None, 3)),
    ({5: True, 6: True, 7: True, 8: True}, [], 1, ("validated", 7, None, 2)),
    ({}, [], 2, ("idle", None, None, 0)),
]


@pytest.mark.parametrize("days,reviewed,back,want", SCENARIOS)
def test_next_review(spark, days, reviewed, back, want):
    row = review.next_review(*frames(spark, days, reviewed), back).first()
    status, target, blocked, pending = want
    assert (row["status"], row["target_day"], row["blocked_day"], row["pending_days"]) == (
        status, target and d(target), blocked and d(blocked), pending)


def test_bootstrap_from_latest_day(spark):
    days, reviewed = frames(spark, {4: True, 5: True, 6: True}, [4])
    get = lambda frame: sorted(r[0] for r in frame.collect())
    assert get(review.resolved_reviewed(days, None, d(5))) == [d(4), d(5)]
    assert get(review.resolved_reviewed(days, reviewed, d(5))) == [d(4)]
    assert get(review.resolved_reviewed(days, None, None)) == []
    assert get(review.advanced_reviewed(reviewed, d(6))) == [d(4), d(6)]


def test_state_errors():
    assert review.state_errors(d(7), d(6), {d(6)}, d(6)) == []
    assert review.state_errors(None, None, None, None) == []
    assert len(review.state_errors(d(5), d(6), {d(6)}, None)) == 1
    assert len(review.state_errors(d(7), d(6), set(), None)) == 1
    assert len(review.state_errors(d(7), d(6), {d(5)}, None)) == 1
    assert len(review.state_errors(d(7), d(6), None, d(7))) == 1
    assert len(review.state_errors(d(7), None, {d(5)}, d(5))) == 2


def test_snapshot_window_is_half_open(spark):
    frame = spark.createDataFrame([(d(n),) for n in (4, 5, 6, 7)], "partition_date date")
    get = lambda f: sorted(r[0].day for r in f.collect())
    assert get(review.within_days(frame, d(5), d(7), False)) == [5, 6]
    assert get(review.within_days(frame, d(5), d(7), True)) == [5, 6, 7]
    assert get(review.within_days(frame, None, d(7), True)) == []


def test_runs_over_a_growing_lake(spark, tmp_path):
    """Clean days 5..7, then a larger day 8: the fourth run warns about drift against committed peers."""
    root, working = str(tmp_path / "lake"), str(tmp_path / "work")
    for n in (5, 6, 7):
        g.write_partition(tmp_path / "lake", g.payload_tables(d(n)), d(n))
    steps = list(drain(spark, root, working, max_days_back=3))
    assert [(s.state, s.days.latest) for s in steps] == [
        ("validated", d(5)), ("validated", d(6)), ("validated", d(7)), ("idle", d(7))]
    assert all(s.audited.get('fail_count', 0) == s.audited.get('warn_count', 0) == 0 for s in steps)

    larger = g.merged(g.payload_tables(d(8)), g.payload_tables(d(8), 9, "second", 7420))
    g.write_partition(tmp_path / "lake", larger, d(8))
    moment = datetime(2026, 4, 9, 6, tzinfo=timezone.utc)
    step = review_next(spark, root, working, 3, run_time=moment)
    assert step.state == "validated" and step.audited["rule_counts"]["dataset_physical_drift"] >= 1
    assert "2026-04-09T06-00-00Z" in step.folder

    # A run that never committed is invisible; a late gap day is picked up; the latest day stays.
    (tmp_path / "work/runs/unfinished").mkdir()
    damaged = g.payload_tables(d(9))
    damaged[g.F][0]["transaction_count"] = 9
    g.write_partition(tmp_path / "lake", damaged, d(9))
    (tmp_path / "lake/year=2026/month=04/day=10").mkdir(parents=True)
    failing, blocked = drain(spark, root, working, max_days_back=3)
    assert failing.state == "validated" and failing.audited["has_failures"]
    assert failing.days.latest == d(9)
    assert blocked.state == "blocked" and blocked.days.blocked == d(10)
    state = load_state(spark, working)
    assert state.latest == d(9)
    assert sorted(r[0].day for r in state.reviewed.collect()) == [5, 6, 7, 8, 9]
    assert sorted(r[0].day for r in state.snapshots.partitions.select("partition_date").distinct().collect()) == [7, 8, 9]


def test_layout_and_state_are_refused(spark, tmp_path):
    lake = tmp_path / "lake"
    g.write_partition(lake, {g.F: []}, d(5), "date")
    with pytest.raises(ReviewStateError):
        review_next(spark, str(lake), str(tmp_path / "work"))


def test_only_empty_days_block(spark, tmp_path):
    (tmp_path / "lake/year=2026/month=04/day=06").mkdir(parents=True)
    step = review_next(spark, str(tmp_path / "lake"), str(tmp_path / "work"), 0)
    assert (step.state, step.days.blocked, step.days.latest, step.audited) == ("blocked", d(6), None, {})
    assert step.days.found == step.days.pending == 1 and step.days.expired == 0
    assert load_state(spark, str(tmp_path / "work")).latest is None
    again = review_next(spark, str(tmp_path / "lake"), str(tmp_path / "work"), 0)
    assert again.state == "blocked" and again.folder != step.folder


def test_only_unsupported_paths_still_advance(spark, tmp_path):
    bad = tmp_path / "lake/year=2026/month=04/day=05/stray_2026-04-05.parquet"
    bad.parent.mkdir(parents=True)
    bad.write_bytes(b"bad")
    step = review_next(spark, str(tmp_path / "lake"), str(tmp_path / "work"), 0)
    assert (step.state, step.audited["reviewed_partition_count"], step.days.latest) == ("validated", 0, d(5))
    assert step.audited["rule_counts"] == {"partition_parse_error": 1}
    assert load_state(spark, str(tmp_path / "work")).snapshots.partitions.count() == 0
