"""Backfill of dataset ownership on stored alerts and incidents that predate it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def own_alerts(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts take the dataset of their primary event, where that event has one."""
    owner = events.where(F.col("dataset_id").isNotNull()).select(
        F.col("event_id").alias("normalized_event_id"), F.col("dataset_id").alias("__owner")
    )
    return (
        alerts.join(owner, "normalized_event_id", "left")
        .withColumn("dataset_id", F.coalesce("__owner", "dataset_id"))
        .drop("__owner")
        .select(*alerts.columns)
    )


def own_incidents(incidents: DataFrame, alerts: DataFrame) -> DataFrame:
    """Incidents take a dataset only when every one of their alerts belongs to it."""
    owner = (
        alerts.where(F.col("incident_id").isNotNull())
        .groupBy("incident_id")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.count("dataset_id").alias("owned"),
            F.min("dataset_id").alias("__owner"),
            F.max("dataset_id").alias("last_owner"),
        )
        .where((F.col("alerts") == F.col("owned")) & (F.col("__owner") == F.col("last_owner")))
        .select("incident_id", "__owner")
    )
    return (
        incidents.join(owner, "incident_id", "left")
        .withColumn("dataset_id", F.coalesce("__owner", "dataset_id"))
        .drop("__owner")
        .select(*incidents.columns)
    )
