"""Registered queries: every job run over the whole given tables, flattened for comparison.

Times are returned as epoch microseconds or text, id lists as rows.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.operators import (
    browse, correlate, dashboard, evidence, ownership, report, rules, summary,
)
from sentrel.plans import investigate as inv
from sentrel.plans.registry import Query, query
from sentrel.session import materialize, shared_dir
from sentrel.sources import sinks
from sentrel.sources.sinks import Store
from sentrel.sources.telemetry import canonical_events

GENERATED_AT = "2024-02-01 00:00:00"
RERUN_FROM = datetime(2024, 1, 15)
FIRST_SUMMARIES, SECOND_SUMMARIES = datetime(2024, 2, 1), datetime(2024, 2, 2)
BROWSE_FROM = datetime(2024, 1, 8)
BROWSE_TO = datetime(2024, 1, 22, 2, 0, 0)


def _us(name: str, alias: str) -> Column:
    return F.unix_micros(name).alias(alias)


def _flat_alerts(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "dataset_id", "alert_id", "rule_no", "alert_rule_name", "severity", "description",
        "related_username", "related_asset", "mitre_technique_id", "normalized_event_id",
        _us("first_seen", "first_us"), _us("last_seen", "last_us"), "evidence_count",
        "lead_event_id", *extra,
    )


def _flat_events(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "dataset_id", _us("event_timestamp", "t"), "source_system", "event_type",
        "username", "source_ip", "asset", "action", "outcome", "severity",
    )


def _flat_incidents(df: DataFrame) -> DataFrame:
    return df.select(
        "incident_id", "dataset_id", "status", "severity", "title", "suspected_attack_path",
        "description", "affected_user", F.array_join("affected_assets", ", ").alias("asset_text"),
        _us("first_seen", "first_us"), _us("last_seen", "last_us"), "alert_count",
    )


def _flat_pieces(df: DataFrame) -> DataFrame:
    return df.select(
        "incident_id", "section",
        F.array_join(F.col("place").cast("array<string>"), ",").alias("place"), "text",
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical event table as stored: every rule scans it, with its own columns.

    It is dealt out once, as the given table may be one row group.
    """
    return materialize(canonical_events(spark, sf_dir).repartition("event_id"), "canonical-events")


def _state(spark: SparkSession, sf_dir: str) -> inv.Investigation:
    return inv.investigate(_events(spark, sf_dir))


def _evidence(state: inv.Investigation) -> summary.Evidence:
    return summary.gather_evidence(state.incidents, state.alerts, state.links, state.relevant)


# --------------------------------------------------------------------------- rules


def _rule(position: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = rules.RULES[position]
        return _flat_alerts(rule.candidates(canonical_events(spark, sf_dir), rules.DEFAULTS))

    return run


for _position, _name in enumerate(
    (
        "rule_brute_force", "rule_unusual_ip", "rule_vpn_privilege", "rule_api_download",
        "rule_endpoint_credential", "rule_multi_high",
    )
):
    _run = _rule(_position)
    _run.__name__ = _name
    query(_run)


@query
def alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every rule and scope."""
    return _flat_alerts(rules.detect(_events(spark, sf_dir)))


@query
def alerts_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and claimed evidence per scope and rule, all scopes in one pass."""
    return rules.detect(_events(spark, sf_dir)).groupBy("dataset_id", "rule_no").agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("evidence_count").alias("evidence"),
        F.max(F.unix_micros("last_seen")).alias("last_us"),
    )


def _early_and_all(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = _events(spark, sf_dir)
    early = events.where(F.col("event_timestamp") < F.lit(RERUN_FROM))
    return events, inv.detect(early), rules.detect(events)


@query
def alerts_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun after more events arrived: only alerts not stored by the first run."""
    _, stored, found = _early_and_all(spark, sf_dir)
    return _flat_alerts(rules.new_alerts(found, stored))


@query
def alert_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids behind each alert."""
    events = _events(spark, sf_dir)
    links = evidence.alert_evidence(inv.detect(events), events)
    return links.select("dataset_id", "alert_id", "event_id")


# --------------------------------------------------------------------------- correlation


@query
def incident_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and span of each group of related alerts."""
    assigned = inv.correlate_alerts(inv.detect(_events(spark, sf_dir)))
    return assigned.groupBy("incident_id", "dataset_id").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min(F.unix_micros("first_seen")).alias("first_us"),
        F.max(F.unix_micros("last_seen")).alias("last_us"),
    )


@query
def alert_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident of every alert."""
    assigned = inv.correlate_alerts(inv.detect(_events(spark, sf_dir)))
    return assigned.select("dataset_id", "alert_id", "incident_id")


@query
def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = inv.correlate_alerts(inv.detect(_events(spark, sf_dir)))
    return _flat_incidents(correlate.build_incidents(assigned))


@query
def attack_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each suspected attack path occurs."""
    assigned = inv.correlate_alerts(inv.detect(_events(spark, sf_dir)))
    return (
        correlate.build_incidents(assigned).groupBy("dataset_id", "suspected_attack_path")
        .agg(F.count(F.lit(1)).alias("incidents"))
    )


@query
def incident_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct evidence events of each incident."""
    events = _events(spark, sf_dir)
    assigned = inv.correlate_alerts(inv.detect(events))
    return evidence.incident_events(assigned, events)


@query
def alerts_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts a later correlation run takes up, over a store with gaps and misplaced owners."""
    state = _state(spark, sf_dir)
    stored = state.alerts.withColumn(
        "incident_id", F.when(F.col("rule_no") <= 3, F.col("incident_id"))
    )
    owners = state.incidents.withColumn(
        "dataset_id", F.when(F.col("dataset_id") == 2, F.lit(None)).otherwise(F.col("dataset_id"))
    )
    return _flat_alerts(correlate.unassigned_alerts(stored, owners), "incident_id")


# --------------------------------------------------------------------------- ownership


def _legacy_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts as stored before ownership: no dataset, incidents grouped by asset."""
    return alerts.withColumn("dataset_id", F.lit(None).cast("bigint")).withColumn(
        "incident_id", F.concat(F.lit("legacy-"), F.col("related_asset"))
    )


def _legacy_incidents(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("incident_id").isNotNull()).groupBy("incident_id").agg(
        F.lit(None).cast("bigint").alias("dataset_id"),
        F.count(F.lit(1)).alias("alert_count"),
    )


@query
def ownership_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    legacy = _legacy_alerts(inv.detect(events))
    return _flat_alerts(ownership.own_alerts(legacy, events))


@query
def ownership_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    legacy = _legacy_alerts(inv.detect(events))
    owned = ownership.own_alerts(legacy, events)
    return ownership.own_incidents(_legacy_incidents(legacy), owned)


@query
def scope_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample incidents none of whose alerts belongs to a dataset, over legacy groups."""
    events = _events(spark, sf_dir)
    legacy = _legacy_alerts(inv.detect(events))
    owned = ownership.own_alerts(legacy, events)
    return browse.sample_incidents(_legacy_incidents(legacy), owned)


# --------------------------------------------------------------------------- browse


@query
def browse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = browse.browse_events(
        canonical_events(spark, sf_dir), severity="high", source_system="cloud_identity",
        start=BROWSE_FROM, end=BROWSE_TO, skip=5, limit=50,
    )
    return _flat_events(page)


@query
def browse_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.detect(_events(spark, sf_dir))
    page = browse.browse_alerts(
        found, severity="medium", alert_rule_name="Successful login from unusual IP",
        skip=10, limit=100,
    )
    return _flat_alerts(page)


@query
def browse_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    page = browse.browse_incidents(
        state.incidents, state.alerts, status="open", severity="high",
        start=BROWSE_FROM, end=BROWSE_TO, limit=40,
    )
    return _flat_incidents(page)


@query
def browse_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest events of one dataset."""
    return _flat_events(browse.browse_events(canonical_events(spark, sf_dir), dataset_id=2, limit=200))


@query
def incident_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    items = browse.incident_detail(state.incidents, state.alerts, state.links, state.relevant)
    return items.withColumn("seen", F.unix_micros("seen")).withColumnRenamed("seen", "seen_us")


# --------------------------------------------------------------------------- summaries


@query
def evidence_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.evidence_bundle(_evidence(_state(spark, sf_dir)))


@query
def affected_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.affected_entities(_evidence(_state(spark, sf_dir)))


@query
def attack_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summary.attack_timeline(_evidence(_state(spark, sf_dir)))
    return rows.withColumn("timestamp", F.unix_micros("timestamp")).withColumnRenamed("timestamp", "t")


@query
def incident_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries with their full technical text, a row for each part of it."""
    gathered = _evidence(_state(spark, sf_dir))
    rows = materialize(summary.summarize(gathered), "summaries")
    parts = summary.document_parts(summary.technical_pieces(rows, gathered.events))
    return (
        rows.drop("technical_summary")
        .join(parts.withColumnRenamed("text", "technical_summary"), "incident_id")
        .select(
            "incident_id", "part_no", "dataset_id", "model_name", "executive_summary", "technical_summary",
            F.array_join("affected_users", ", ").alias("users"),
            F.array_join("affected_assets", ", ").alias("assets"),
            F.array_join("recommended_containment_steps", "\n").alias("steps"),
            "alert_count", "event_count",
        )
    )


def _stored_summaries(incidents: DataFrame) -> DataFrame:
    """Summary store: one run for all but high incidents, a second one for critical ones."""
    base = incidents.where(F.col("severity") != "high").select("incident_id", "dataset_id", "severity")
    first = base.select(
        "incident_id", "dataset_id", F.lit(1).alias("summary_id"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("created_at"),
    )
    second = base.where(F.col("severity") == "critical").select(
        "incident_id", "dataset_id", F.lit(2).alias("summary_id"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("created_at"),
    )
    return first.unionByName(second)


@query
def latest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    newest = summary.latest_summary(_stored_summaries(state.incidents))
    return newest.select("incident_id", "dataset_id", "summary_id")


@query
def missing_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    return _flat_incidents(
        summary.missing_summaries(state.incidents, _stored_summaries(state.incidents))
    )


@query
def evidence_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    listed = evidence.alert_evidence(state.alerts, state.relevant)
    return summary.document_parts(summary.prompt_pieces(_evidence(state), listed))


def _report(spark: SparkSession, sf_dir: str, summarized: bool) -> tuple[DataFrame, DataFrame]:
    gathered = _evidence(_state(spark, sf_dir))
    stored = summary.summarize(gathered) if summarized else None
    at = F.lit(GENERATED_AT).cast("timestamp")
    return gathered.incidents, report.report_pieces(gathered, at, stored)


@query
def incident_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown report of every incident, with its summary, in parts."""
    shown, pieces = _report(spark, sf_dir, True)
    texts = summary.document_parts(pieces)
    names = shown.select("incident_id", report.report_name().alias("file_name"))
    return names.join(texts, "incident_id")


@query
def incident_report_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports without summaries, as ordered pieces of any length."""
    return _flat_pieces(_report(spark, sf_dir, False)[1])


def _summarized_twice(spark: SparkSession, sf_dir: str) -> tuple[summary.Evidence, Store]:
    """All evidence, and a store of two summary runs.

    The first run saw the evidence of each week's first hour and left the high incidents out; the second
    saw all of it, for the critical incidents only.
    """
    gathered = _evidence(_state(spark, sf_dir))
    when = F.col("event_timestamp")
    in_week = F.unix_micros(when) - F.unix_micros(F.date_trunc("week", when))
    early = summary.Evidence(
        gathered.incidents, gathered.alerts, gathered.events.where(in_week < F.lit(3_600_000_000))
    )
    store = Store(spark, f"{shared_dir(spark)}/stages/summaries-{uuid.uuid4().hex}")
    for at, seen, severity in (
        (FIRST_SUMMARIES, early, F.col("severity") != "high"),
        (SECOND_SUMMARIES, gathered, F.col("severity") == "critical"),
    ):
        wanted = seen.incidents.where(severity).select("incident_id")
        drafts = materialize(summary.summarize(seen).join(wanted, "incident_id", "left_semi"), "drafts")
        sinks.append_summaries(store, drafts, at, seen.events)
    return gathered, store


@query
def summary_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored timelines of both versions, beside the counts their summaries were stored with."""
    _, store = _summarized_twice(spark, sf_dir)
    heads = sinks.summaries(store).select("summary_id", "alert_count", "event_count")
    return sinks.summary_timeline(store).join(heads, "summary_id").select(
        "summary_id", "incident_id", "event_id", _us("event_timestamp", "t"), "source_system",
        "event_type", "username", "asset", "action", "outcome", "severity",
        F.col("normalized_message").alias("message"), "alert_count", "event_count",
    )


@query
def report_after_late_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as of the latest summaries, though evidence came after them, in parts."""
    gathered, store = _summarized_twice(spark, sf_dir)
    latest = materialize(summary.latest_summary(sinks.summaries(store)), "latest-summaries")
    at = F.lit(GENERATED_AT).cast("timestamp")
    return summary.document_parts(
        report.report_pieces(gathered, at, latest, sinks.timeline_of(store, latest))
    )


# --------------------------------------------------------------------------- dashboard


@query
def dashboard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    return dashboard.dashboard_counts(
        events=state.events, alerts=state.alerts, incidents=state.incidents,
        summaries=_stored_summaries(state.incidents), uploads=_uploads(state.events),
    )


def _uploads(events: DataFrame) -> DataFrame:
    """Uploads derived from the events: one for each scope and source, none for the sample scope."""
    return events.where(F.col("dataset_id").isNotNull()).select("dataset_id", "source_system").distinct()


def _datasets(events: DataFrame) -> DataFrame:
    """Dataset dimension derived from the events."""
    return events.where(F.col("dataset_id").isNotNull()).groupBy("dataset_id", "source_system").agg(
        F.count(F.lit(1)).alias("record_count")
    ).select(
        (F.col("dataset_id") * 10 + F.length("source_system") % 10).alias("dataset_id"),
        "source_system", "record_count",
        F.when(F.col("source_system") == "vpn", "ready_to_normalize")
        .when(F.col("source_system") == "api_gateway", "workflow_complete")
        .otherwise("normalized").alias("status"),
    )


@query
def dataset_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets (one per scope and source) that still need normalization or analysis."""
    events = _events(spark, sf_dir)
    split = events.where(F.col("dataset_id").isNotNull()).withColumn(
        "dataset_id", F.col("dataset_id") * 10 + F.length("source_system") % 10
    )
    assigned = inv.correlate_alerts(inv.detect(split))
    return dashboard.dataset_state(_datasets(events), correlate.build_incidents(assigned))


@query
def severity_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.severity_mix(canonical_events(spark, sf_dir))


@query
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a rerun: detection against the earlier store, then correlation."""
    events, stored, _ = _early_and_all(spark, sf_dir)
    state = inv.investigate(events)
    counted = inv.detection_counters(events, state.alerts, stored)
    return rules.null_safe_join(counted, inv.correlation_counters(state), ["dataset_id"], "left")


