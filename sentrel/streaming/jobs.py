"""Streaming forms of ingest, the windowed rules and incident sessions.

All need a watermark: an event that arrives later than the allowed lateness is dropped, and a
result appears only once the watermark has passed its window. For events that arrive in time
the results equal those of the batch jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sentrel.functions.payload import canonical_json
from sentrel.functions.text import blank_to_null, severity_rank
from sentrel.operators.correlate import CORRELATION_GAP_US
from sentrel.operators.rules import (
    DEFAULTS, RuleSettings, has_user, is_login, is_privilege_action, is_serious, is_vpn_connect,
)

LATENESS = "1 hour"


def dedupe_events(normalized: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Normalized records, each distinct payload once.

    The horizon for recognising a copy is the allowed lateness. Records need an event time.
    """
    return (
        normalized.withColumn("payload_key", F.sha2(canonical_json(F.col("payload")), 256))
        .withWatermark("event_timestamp", lateness)
        .dropDuplicatesWithinWatermark(
            ["dataset_id", "source_system", "event_type", "payload_key"]
        )
    )


def _interval(us: int) -> str:
    return f"INTERVAL '{us // 1_000_000}.{us % 1_000_000:06d}' SECOND"


def _windowed(
    events: DataFrame, keys: list[str], pool: Column, anchor: Column, start: str, end: str, needed: int,
    lateness: str,
) -> DataFrame:
    """Anchors with at least ``needed`` pool events between the times ``start`` and ``end``.

    An interval join of two streams, then an aggregate per anchor. Both sides are dropped from the
    state once the watermark rules out a partner, so it holds a window and the lateness of events
    however long the stream runs.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    timed = events.where(F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", lateness)
    anchors = timed.where(anchor).select(
        *keys, key.alias("key"), "event_id", F.col("event_timestamp").alias("anchor_at")
    )
    others = timed.where(pool).select(
        key.alias("pool_key"), F.col("event_id").alias("pool_id"), F.col("event_timestamp").alias("pool_at")
    )
    within = F.expr(f"key = pool_key AND pool_at >= {start} AND pool_at <= {end}")
    return (
        anchors.join(others, within)
        .groupBy(*keys, "event_id", "anchor_at")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("pool_at").alias("first_at"), F.max("pool_at").alias("last_at"),
            F.max_by("pool_id", F.struct("pool_at", "pool_id")).alias("last_id"),
        )
        .where(F.col("n") >= needed)
    )


def brute_force(
    events: DataFrame, cfg: RuleSettings = DEFAULTS, lateness: str = LATENESS
) -> DataFrame:
    """Successful logins preceded by enough failures of the same user and address.

    Returns (dataset_id, username, source_ip, event_id, event_timestamp, failures, first_seen).
    """
    found = _windowed(
        events, ["dataset_id", "username", "source_ip"], is_login("failure"), is_login("success"),
        f"anchor_at - {_interval(cfg.brute_force_window_us)}", "anchor_at", cfg.brute_force_failures, lateness,
    )
    return found.select(
        "dataset_id", "username", "source_ip", "event_id", F.col("anchor_at").alias("event_timestamp"),
        F.col("n").alias("failures"), F.col("first_at").alias("first_seen"),
    )


def vpn_privilege(
    events: DataFrame, cfg: RuleSettings = DEFAULTS, lateness: str = LATENESS
) -> DataFrame:
    """VPN connects followed by privilege actions of the same user.

    Returns (dataset_id, username, event_id, event_timestamp, actions, last_seen,
    last_event_id); a connect is settled once its hour has passed.
    """
    found = _windowed(
        events.where(has_user()), ["dataset_id", "username"], is_privilege_action(cfg), is_vpn_connect(),
        "anchor_at", f"anchor_at + {_interval(cfg.vpn_window_us)}", 1, lateness,
    )
    return found.select(
        "dataset_id", "username", "event_id", F.col("anchor_at").alias("event_timestamp"),
        F.col("n").alias("actions"), F.col("last_at").alias("last_seen"), F.col("last_id").alias("last_event_id"),
    )


def incident_sessions(
    alerts: DataFrame, gap_us: int = CORRELATION_GAP_US, lateness: str = LATENESS
) -> DataFrame:
    """Groups of alerts of one user, as sessions that stay open a day after their last event.

    Returns (dataset_id, username, first_seen, last_seen, alerts, severity_rank).
    """
    open_for = F.expr(
        f"make_interval(0, 0, 0, 0, 0, 0, CAST((unix_micros(last_seen) - unix_micros(first_seen) + {gap_us})"
        " / 1000000 AS DECIMAL(18, 6)))"
    )
    return (
        alerts.where(blank_to_null(F.col("related_username")).isNotNull())
        .withColumn("seen", F.col("first_seen"))
        .withWatermark("seen", lateness)
        .groupBy(
            "dataset_id",
            F.col("related_username").alias("username"),
            F.session_window("seen", open_for),
        )
        .agg(
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.count(F.lit(1)).alias("alerts"),
            F.max(severity_rank(F.col("severity"))).alias("severity_rank"),
        )
        .drop("session_window")
    )


_FOUND = T.StructType(
    [T.StructField("key", T.StringType())]
    + [
        T.StructField(name, T.LongType())
        for name in ("lead_event_id", "first_us", "last_us", "last_event_id", "evidence_count")
    ]
)
_EVENT = T.StructType([T.StructField("t", T.LongType()), T.StructField("event_id", T.LongType())])
_WINDOW = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("lead_t", "lead_id", "last_t", "last_id", "n")]
)
#: Events are settled together, this many milliseconds of event time at once.
SETTLE_MS = 300_000


class FirstWindow(StatefulProcessor):
    """First window of a user with enough serious events, emitted once when it is complete.

    Events are appended to a list as they come and settled in time order by timers, once the
    watermark has passed them. What is kept of settled events does not grow: fewer than ``needed``
    recent ones, or the first window's lead, last event and count. After the window is out only a
    mark stays.
    """

    def __init__(self, width_us: int, needed: int) -> None:
        self.width_us, self.needed = width_us, needed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _EVENT)
        self.recent = handle.getListState("recent", _EVENT)
        self.window = handle.getValueState("window", _WINDOW)
        self.done = handle.getValueState("done", T.StructType([T.StructField("done", T.BooleanType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, times = self.done.exists(), set()
        for batch in rows:
            if done:
                continue
            found = list(zip(batch["t"].tolist(), batch["event_id"].tolist()))
            self.waiting.appendList(found)
            times |= {(t // 1000 // SETTLE_MS + 1) * SETTLE_MS for t, _ in found}
        for at in times:
            self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.done.exists():
            return
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get())
        settled = [event for event in waiting if event[0] < watermark]
        window = self.window.get() if self.window.exists() else None
        recent = [tuple(event) for event in self.recent.get()]
        for t, event_id in settled:
            if window:
                if t > window[0] + self.width_us:
                    break
                window = (window[0], window[1], t, event_id, window[4] + 1)
                continue
            recent = [event for event in recent if event[0] >= t - self.width_us] + [(t, event_id)]
            if len(recent) >= self.needed:
                window, recent = (*recent[0], t, event_id, len(recent)), []
        if window and watermark > window[0] + self.width_us:
            self.done.update((True,))
            for state in (self.waiting, self.recent, self.window):
                state.clear()
            lead_t, lead_id, last_t, last_id, n = window
            yield pd.DataFrame([[key[0], lead_id, lead_t, last_t, last_id, n]], columns=_FOUND.fieldNames())
            return
        _put(self.waiting, waiting[len(settled):])
        _put(self.recent, recent)
        if window:
            self.window.update(window)
            self.handle.registerTimer((window[0] + self.width_us) // 1000 + 1)

    def close(self) -> None:
        pass


def _put(state, events: list[tuple]) -> None:
    if events:
        state.put(events)
    else:
        state.clear()


def multiple_high(
    events: DataFrame, cfg: RuleSettings = DEFAULTS, lateness: str = LATENESS, needed: int = 3
) -> DataFrame:
    """First window per user with enough serious events, emitted once when it is complete.

    Returns (key, lead_event_id, first_us, last_us, last_event_id, evidence_count); ``key`` is
    a JSON object of scope and user.
    """
    key = F.to_json(F.struct("dataset_id", "username"), {"ignoreNullFields": "false"})
    serious = (
        events.where(is_serious(cfg) & F.col("event_timestamp").isNotNull())
        .select(
            key.alias("key"), "event_id", "event_timestamp",
            F.unix_micros("event_timestamp").alias("t"),
        )
        .withWatermark("event_timestamp", lateness)
    )
    return serious.groupBy("key").transformWithStateInPandas(
        FirstWindow(cfg.high_window_us, needed), _FOUND, "Append", "EventTime"
    )
