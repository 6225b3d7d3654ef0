"""Streams cut into small batches give the results of the batch jobs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from sentrel.operators import rules
from sentrel.streaming import jobs
from sentrel.streaming.replay import replay, write_feed
from tests.fixtures import START, connect, event, failure, frame, random_events, serious


def ordered_feed(spark, rows, closing):
    """One file per quarter of the rows, in time order."""
    rows = sorted(rows, key=lambda row: row[2])
    size = len(rows) // 4 + 1
    path = write_feed(frame(spark, rows[:size]).coalesce(1), frame(spark, []))
    for place in range(size, len(rows), size):
        frame(spark, rows[place:place + size]).coalesce(1).write.mode("append").parquet(path)
    frame(spark, closing).coalesce(1).write.mode("append").parquet(path)
    return path


def test_brute_force_stream(spark):
    rows = random_events(7, 300, 2)
    late = START + timedelta(days=400)
    closing = [event(9001, late, username="closing"), failure(9002, late, username="closing")]
    path = ordered_feed(spark, rows, closing)
    found = replay(spark, path, lambda df: jobs.brute_force(df, lateness="2 hours"), files_per_batch=1)
    expected = rules.brute_force(frame(spark, rows)).select("lead_event_id", (F.col("evidence_count") - 1))
    got = [tuple(row) for row in found.select("event_id", "failures").collect()]
    assert len(got) == len(set(got)) > 0
    assert set(got) == {tuple(row) for row in expected.collect()}


def test_vpn_stream(spark):
    rows = random_events(8, 500, 2)
    closing = [connect(9001, START + timedelta(days=400), username="closing")]
    path = ordered_feed(spark, rows, closing)
    found = replay(spark, path, lambda df: jobs.vpn_privilege(df, lateness="2 hours"), files_per_batch=1)
    expected = rules.vpn_privilege(frame(spark, rows)).select(
        "lead_event_id", F.col("evidence_count") - 1, "normalized_event_id", "last_seen"
    )
    got = [tuple(row) for row in found.select("event_id", "actions", "last_event_id", "last_seen").collect()]
    assert len(got) == len(set(got)) > 0
    assert set(got) == {tuple(row) for row in expected.collect()}


def test_multi_high_stream_emits_each_user_once(spark):
    rows = [
        serious(i, START + timedelta(hours=hour), username=user)
        for i, (user, hour) in enumerate(
            [("a", 0), ("a", 30), ("a", 40), ("a", 54), ("a", 55), ("a", 90), ("a", 91), ("a", 92),
             ("b", 0), ("b", 24), ("b", 24), ("c", 0), ("c", 1), ("c", 26)]
        )
    ]
    closing = [serious(9001, START + timedelta(days=400), username="closing")]
    path = ordered_feed(spark, rows, closing)
    found = replay(spark, path, lambda df: jobs.multiple_high(df, lateness="1 hour"), files_per_batch=1)
    got = sorted(
        (row["lead_event_id"], row["last_event_id"], row["evidence_count"]) for row in found.collect()
    )
    expected = rules.multiple_high(frame(spark, rows)).select(
        "lead_event_id", "normalized_event_id", "evidence_count"
    )
    assert got == sorted(tuple(row) for row in expected.collect()) == [(1, 3, 3), (8, 10, 3)]


def daily_feed(spark, days):
    """One file for each day's rows, in time order."""
    path = write_feed(frame(spark, days[0]).coalesce(1), frame(spark, []))
    for rows in days[1:]:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return path


def state_rows(progress, operator):
    return [
        op["numRowsTotal"] for report in progress for op in report["stateOperators"] if op["operatorName"] == operator
    ]


def test_a_long_stream_keeps_one_window_of_events(spark):
    days = [
        [failure(day * 100 + n, START + timedelta(days=day, seconds=n)) for n in range(40)]
        + [event(day * 100 + 90, START + timedelta(days=day, minutes=5))]
        for day in range(6)
    ]
    progress = []
    found = replay(spark, daily_feed(spark, days), jobs.brute_force, files_per_batch=1, progress=progress)
    # The last day's window is still open.
    assert sorted(tuple(r) for r in found.select("event_id", "failures").collect()) == [(d * 100 + 90, 40) for d in range(5)]
    held = state_rows(progress, "symmetricHashJoin")
    assert len(held) >= 6 and max(held) <= 2 * 2 * 41


def test_a_busy_user_costs_no_more_as_the_stream_goes_on(spark):
    # Events 13 and 17 hours apart never make three in a day; the other user's do at once.
    days = [
        [serious(day * 1000 + n, START + timedelta(hours=30 * day + 13 * n), username="calm") for n in range(2)]
        + [serious(day * 1000 + 100 + n, START + timedelta(hours=30 * day, seconds=n), username="busy") for n in range(300)]
        for day in range(6)
    ]
    progress = []
    found = replay(spark, daily_feed(spark, days), jobs.multiple_high, files_per_batch=1, progress=progress)
    assert [(r["lead_event_id"], r["evidence_count"]) for r in found.collect()] == [(100, 300)]
    held = [op["numRowsTotal"] for report in progress for op in report["stateOperators"]]
    assert len(held) >= 6
    assert max(held[3:]) <= max(held[:3])
