"""Adapter: the ``events`` table read as security telemetry.

The table is a click-stream. A fixed projection turns each row into one canonical event,
compressing every week into a two-hour burst so that the minute-scale rules have something
to find. ``sources.feeds`` renders the same rows as source records for the ingest jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BURST_FACTOR = 84  # one week / two hours


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return rows.select(*columns).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("event_type").alias("kind"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _burst_time(ts: Column) -> Column:
    week = F.unix_micros(F.date_trunc("week", ts))
    offset = F.floor((F.unix_micros(ts) - week) / F.lit(BURST_FACTOR))
    return F.timestamp_micros(week + offset)


def _text(value: Column) -> Column:
    return value.cast("string")


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One canonical event per ``events`` row, over three scopes."""
    k, kind, user = F.col("k"), F.col("kind"), F.col("user_id")
    login = kind.isin("error", "signup")
    view, click = kind == "view", kind == "click"
    api = (kind == "purchase") & (k < 50)
    credential = (kind == "purchase") & (k >= 50) & (k % 5 == 4)

    source_system = (
        F.when(login, "CLOUD-IAM").when(view, "vpn").when(click, "cloud_identity")
        .when(api, "api_gateway").otherwise("endpoint-edr")
    )
    event_type = (
        F.when(login, "interactive_login").when(view, "vpn_event").when(click, "cloud_event")
        .when(api, "bulk_export").when(credential, "credential_access")
        .otherwise("process_start")
    )
    cloud_action = (
        F.when(k % 10 == 0, "CreateAccessKey").when(k % 10 == 1, "AttachUserPolicy")
        .when(k % 10 == 2, "DisableMFADevice").otherwise("ListUsers")
    )
    action = (
        F.when(login, "login")
        .when(view, F.when(k % 4 == 0, "connect").otherwise("posture_check"))
        .when(click, cloud_action).when(api, "GET /api/v1/export").otherwise("alert")
    )
    outcome = (
        F.when(kind == "error", "failure")
        .when(api, F.when(k % 5 == 0, "403").otherwise("200"))
        .otherwise("success")
    )
    asset = (
        F.when(login, F.concat(F.lit("IAM-"), _text(user % 4)))
        .when(view, F.concat(F.lit("LAPTOP-"), _text(user)))
        .when(click, F.lit("CLOUD-IAM")).when(api, F.lit("API-GATEWAY-01"))
        .otherwise(F.concat(F.lit("LAPTOP-"), _text(user % 50)))
    )
    endpoint = (kind == "purchase") & (k >= 50)
    message = (
        F.when(endpoint & (k % 10 == 7), F.concat(F.lit("Malware signature "), _text(k)))
        .when(endpoint & (k % 10 == 2), F.concat(F.lit("Store of CREDENTIALs read, code "), _text(k)))
        .when(k % 7 == 3, F.concat(F.lit("Observed code "), _text(k), F.lit(" of user "), _text(user)))
        .when(k % 7 == 5, F.lit(""))
    )
    severity = (
        F.when(F.col("value") >= 200, "critical").when(F.col("value") >= 90, "high")
        .when(F.col("value") >= 35, "medium").otherwise("low")
    )
    return _events(spark, sf_dir).select(
        "event_id",
        F.when(user % 3 != 0, user % 3).alias("dataset_id"),
        _burst_time(F.col("ts")).alias("event_timestamp"),
        source_system.alias("source_system"),
        event_type.alias("event_type"),
        F.when(k != 99, F.concat(F.lit("user-"), _text(user))).alias("username"),
        F.when(user % 5 == 0, F.lit("198.51.100.24"))
        .otherwise(F.concat(F.lit("203.0.113."), _text(user % 200))).alias("source_ip"),
        F.lit(None).cast("string").alias("destination_ip"),
        asset.alias("asset"),
        action.alias("action"),
        outcome.alias("outcome"),
        severity.alias("severity"),
        F.when(credential, F.lit("T1003.001")).alias("mitre_technique_id"),
        message.alias("normalized_message"),
    )
