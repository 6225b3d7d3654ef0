"""Registered streaming queries: the stored feed is replayed to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.operators import normalize
from sentrel.plans import investigate as inv
from sentrel.plans.registry import query
from sentrel.sources import feeds
from sentrel.sources.telemetry import canonical_events
from sentrel.streaming import jobs
from sentrel.streaming.replay import FILES, replay, write_feed

# Alerts are made from finished windows and may end hours after they begin; raw records have no order.
WHOLE_FEED = "60 days"
CLOSING_AT = "2026-01-01 00:00:00"


def _closing(rows: DataFrame, time_column: str, **changes) -> DataFrame:
    """One row per distinct shape needed to move the watermark, far after the feed."""
    late = F.lit(CLOSING_AT).cast("timestamp")
    return rows.limit(1).withColumns(
        {time_column: late, **{name: F.lit(value) for name, value in changes.items()}}
    )


def _event_feed(spark: SparkSession, sf_dir: str) -> str:
    events = canonical_events(spark, sf_dir)
    login = dict(
        source_system="CLOUD-IAM", event_type="interactive_login", action="login",
        username="closing", severity="high",
    )
    ends = [
        _closing(events, "event_timestamp", event_id=-place, outcome=outcome, **login)
        for place, outcome in ((1, "success"), (2, "failure"))
    ]
    connect = dict(source_system="vpn", action="connect", outcome="success", username="closing")
    ends.append(_closing(events, "event_timestamp", event_id=-3, severity="low", **connect))
    closing = ends[0].unionByName(ends[1]).unionByName(ends[2])
    closing = closing.withColumn("event_id", F.col("event_id").cast("bigint"))
    return write_feed(events, closing, "event_timestamp")


@query
def stream_brute_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay(spark, _event_feed(spark, sf_dir), jobs.brute_force, FILES)
    return found.select(
        "dataset_id", "username", "source_ip", "event_id",
        F.unix_micros("event_timestamp").alias("t"), "failures",
        F.unix_micros("first_seen").alias("first_us"),
    )


@query
def stream_vpn_privilege(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay(spark, _event_feed(spark, sf_dir), jobs.vpn_privilege, FILES)
    return found.select(
        "dataset_id", "username", "event_id", F.unix_micros("event_timestamp").alias("t"),
        "actions", F.unix_micros("last_seen").alias("last_us"), "last_event_id",
    )


@query
def stream_multi_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay(spark, _event_feed(spark, sf_dir), jobs.multiple_high, FILES)
    named = F.from_json("key", "dataset_id bigint, username string")
    return found.select(named.alias("k"), *[c for c in found.columns if c != "key"]).select("k.*", *found.columns[1:])


@query
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = inv.detect(canonical_events(spark, sf_dir))
    end = _closing(alerts, "first_seen", related_username="closing").withColumn(
        "last_seen", F.col("first_seen")
    )
    found = replay(
        spark, write_feed(alerts, end), lambda df: jobs.incident_sessions(df, lateness=WHOLE_FEED)
    )
    return found.select(
        "dataset_id", "username", F.unix_micros("first_seen").alias("first_us"),
        F.unix_micros("last_seen").alias("last_us"), "alerts", "severity_rank",
    )


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources normalized and deduplicated as they arrive, a third of them delivered twice."""
    records = feeds.doubled(feeds.source_records(spark, sf_dir))
    found = replay(
        spark, write_feed(records, records.limit(0)),
        lambda df: jobs.dedupe_events(normalize.normalize_records(df), lateness=WHOLE_FEED),
    )
    return found.select(
        "source_name", "record_no", "source_system", "event_type",
        F.unix_micros("event_timestamp").alias("t"),
    )
