"""Detection and correlation over all scopes, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.operators import correlate, evidence, rules
from sentrel.session import materialize


@dataclass(frozen=True)
class Investigation:
    """Stored state after detection and correlation.

    ``relevant`` are the events that some rule looks at; all evidence lies among them.
    """

    events: DataFrame
    relevant: DataFrame
    alerts: DataFrame
    incidents: DataFrame
    links: DataFrame


def detect(
    events: DataFrame, stored: DataFrame | None = None, relevant: DataFrame | None = None
) -> DataFrame:
    """New alerts of all scopes, written once: correlation reads them several times."""
    found = rules.detect(events) if relevant is None else rules.detect_in(relevant)
    if stored is not None:
        found = rules.new_alerts(found, stored)
    return materialize(found, "alerts")


def correlate_alerts(alerts: DataFrame, run_at: Column | None = None) -> DataFrame:
    return materialize(correlate.assign_incidents(alerts, run_at), "assigned-alerts")


def investigate(events: DataFrame, run_at: Column | None = None) -> Investigation:
    """Run the rules and the correlation over every scope in one pass."""
    relevant = rules.relevant_events(events)
    assigned = correlate_alerts(detect(events, relevant=relevant), run_at)
    return Investigation(
        events,
        relevant,
        assigned,
        materialize(correlate.build_incidents(assigned, run_at), "incidents"),
        materialize(evidence.incident_events(assigned, relevant), "incident-events"),
    )


def detection_counters(events: DataFrame, alerts: DataFrame, stored: DataFrame) -> DataFrame:
    """Per scope: events analyzed, alerts created, alerts skipped as already stored."""
    analyzed = events.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("events_analyzed"))
    fresh = rules.new_alerts(alerts, stored).select("dataset_id", F.lit(1).alias("new"))
    found = alerts.select("dataset_id", F.lit(0).alias("new")).unionByName(fresh)
    created = found.groupBy("dataset_id").agg(
        F.sum("new").alias("alerts_created"),
        (F.sum(F.lit(1) - F.col("new")) - F.sum("new")).alias("alerts_skipped"),
    )
    return rules.null_safe_join(analyzed, created, ["dataset_id"], "left").na.fill(
        0, ["alerts_created", "alerts_skipped"]
    )


def correlation_counters(state: Investigation) -> DataFrame:
    """Per scope: alerts analyzed and linked, incidents created, evidence links written."""
    tagged = (
        state.alerts.select("dataset_id", F.lit("alert").alias("kind"), "incident_id")
        .unionByName(state.incidents.select("dataset_id", F.lit("incident").alias("kind"), "incident_id"))
        .unionByName(state.links.select("dataset_id", F.lit("link").alias("kind"), "incident_id"))
    )

    def of(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1))

    linked = F.count(F.when((F.col("kind") == "alert") & F.col("incident_id").isNotNull(), 1))
    return tagged.groupBy("dataset_id").agg(
        of("alert").alias("alerts_analyzed"),
        of("incident").alias("incidents_created"),
        linked.alias("alerts_linked"),
        of("link").alias("incident_events_linked"),
    )
