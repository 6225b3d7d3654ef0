"""Browse and lookup queries over the stored tables.

Every listing is newest first with missing times at the top, as the stored order has it, and
pages by offset and limit; Spark plans those as a distributed top-k.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.operators.rules import in_scope

# Page size limits.
DEFAULT_PAGE = 50
LARGEST_PAGE = 500


def _equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def _page(df: DataFrame, order: list[Column], skip: int, limit: int) -> DataFrame:
    if skip < 0 or not 1 <= limit <= LARGEST_PAGE:
        raise ValueError(f"skip must not be negative and limit must be 1..{LARGEST_PAGE}")
    return df.orderBy(*order).offset(skip).limit(limit)


def browse_events(
    events: DataFrame,
    *,
    dataset_id: int | None = None,
    severity: str | None = None,
    username: str | None = None,
    source_system: str | None = None,
    event_type: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    skip: int = 0,
    limit: int = DEFAULT_PAGE,
) -> DataFrame:
    """Events of one scope; the time range is closed at both ends."""
    df = _equal(
        in_scope(events, dataset_id),
        severity=severity, username=username, source_system=source_system, event_type=event_type,
    )
    if start:
        df = df.where(F.col("event_timestamp") >= F.lit(start))
    if end:
        df = df.where(F.col("event_timestamp") <= F.lit(end))
    order = [F.desc_nulls_first("event_timestamp"), F.desc("event_id")]
    return _page(df, order, skip, limit)


def browse_alerts(
    alerts: DataFrame,
    *,
    dataset_id: int | None = None,
    severity: str | None = None,
    related_username: str | None = None,
    alert_rule_name: str | None = None,
    incident_id: str | None = None,
    skip: int = 0,
    limit: int = DEFAULT_PAGE,
) -> DataFrame:
    """Alerts of one scope; ties of time go to the alert created last."""
    df = _equal(
        in_scope(alerts, dataset_id),
        severity=severity, related_username=related_username, alert_rule_name=alert_rule_name,
        incident_id=incident_id,
    )
    order = [
        F.desc_nulls_first("first_seen"), F.desc("rule_no"),
        F.desc_nulls_last("anchor_ts"), F.desc("anchor_id"),
    ]
    return _page(df, order, skip, limit)


def sample_incidents(incidents: DataFrame, alerts: DataFrame) -> DataFrame:
    """Incidents of the built-in sample: no owner, and no alert owned by a dataset."""
    owned = alerts.where(F.col("dataset_id").isNotNull()).select("incident_id")
    return incidents.where(F.col("dataset_id").isNull()).join(owned, "incident_id", "left_anti")


def browse_incidents(
    incidents: DataFrame,
    alerts: DataFrame,
    *,
    dataset_id: int | None = None,
    severity: str | None = None,
    status: str | None = None,
    affected_user: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    skip: int = 0,
    limit: int = DEFAULT_PAGE,
) -> DataFrame:
    """Incidents of one scope that lie wholly inside the time range."""
    df = (
        sample_incidents(incidents, alerts)
        if dataset_id is None
        else in_scope(incidents, dataset_id)
    )
    df = _equal(df, severity=severity, status=status, affected_user=affected_user)
    if start:
        df = df.where(F.col("first_seen") >= F.lit(start))
    if end:
        df = df.where(F.col("last_seen") <= F.lit(end))
    order = [F.desc_nulls_first("first_seen"), F.desc("incident_id")]
    return _page(df, order, skip, limit)


def lookup(df: DataFrame, id_column: str, value, dataset_id: int | None = None) -> DataFrame:
    """One row by id, only if it lies in the given scope."""
    return in_scope(df, dataset_id).where(F.col(id_column) == value)


def lookup_incident(
    incidents: DataFrame, alerts: DataFrame, incident_id: str, dataset_id: int | None = None
) -> DataFrame:
    """One incident by id, only if it is shown in the given scope."""
    shown = visible_incidents(incidents, alerts)
    return lookup(shown, "incident_id", incident_id, dataset_id)


def visible_incidents(incidents: DataFrame, alerts: DataFrame) -> DataFrame:
    """Incidents that may be shown: owned ones, and unmixed sample ones."""
    return incidents.where(F.col("dataset_id").isNotNull()).unionByName(
        sample_incidents(incidents, alerts)
    )


def incident_detail(
    incidents: DataFrame, alerts: DataFrame, links: DataFrame, events: DataFrame
) -> DataFrame:
    """Alerts and evidence events of each visible incident, own scope only, one row per item.

    Items stay rows: an incident with a great deal of evidence is not folded into one value.
    """
    head = visible_incidents(incidents, alerts).select(
        "incident_id", F.col("dataset_id").alias("__scope")
    )
    own = F.col("__scope").eqNullSafe(F.col("dataset_id"))
    alert_items = (
        alerts.join(head, "incident_id").where(own)
        .select(
            "incident_id", "dataset_id", F.lit("alert").alias("item"),
            F.col("alert_id").alias("item_id"), F.col("alert_rule_name").alias("name"),
            "severity", F.col("related_username").alias("username"),
            F.col("related_asset").alias("asset"), F.col("first_seen").alias("seen"),
        )
    )
    event_items = (
        links.select("incident_id", "event_id").join(events, "event_id").join(head, "incident_id")
        .where(own)
        .select(
            "incident_id", "dataset_id", F.lit("event").alias("item"),
            F.col("event_id").cast("string").alias("item_id"),
            F.col("event_type").alias("name"), "severity", "username", "asset",
            F.col("event_timestamp").alias("seen"),
        )
    )
    return alert_items.unionByName(event_items)


def list_uploads(datasets: DataFrame, files: DataFrame) -> DataFrame:
    """Uploaded datasets with their files, newest first."""
    per_dataset = files.groupBy("dataset_id").agg(
        F.array_sort(F.collect_list(F.struct("original_filename", "size_bytes"))).alias("files")
    )
    return (
        datasets.join(per_dataset, "dataset_id", "left")
        .withColumn("files", F.coalesce("files", F.array().cast(per_dataset.schema["files"].dataType)))
        .orderBy(F.desc("created_at"), F.desc("dataset_id"))
    )
