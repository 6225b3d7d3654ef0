"""End-to-end jobs over files and stored tables.

Each step can run alone and can be repeated: appends skip what is stored already.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.operators import (
    browse, correlate, evidence, normalize, profile, report, rules, summary, uploads,
)
from sentrel.session import configure, materialize
from sentrel.sources import files, sinks
from sentrel.sources.sinks import Store


def load_sources(store: Store, folder: str) -> dict[str, int]:
    """Extract, normalize and store the built-in sources; returns the counters."""
    records = files.with_event_ids(files.read_sources(store.spark, folder))
    return sinks.append_events(store, normalize.normalize_records(records))


def inspect_upload(spark: SparkSession, path: str, dataset_id: int, source_type: str) -> DataFrame:
    """Fields of an upload with samples and suggested mappings."""
    return profile.inspect_schema(files.read_upload(spark, path, dataset_id, source_type))


def describe_upload(
    spark: SparkSession, path: str, dataset_id: int, name: str, source_type: str,
    created_at: datetime, description: str | None = None,
) -> DataFrame:
    """Dataset row of a new upload: cleaned type, record count and mapping status."""
    if not name.strip():
        raise ValueError("Dataset name is required")
    records = materialize(files.read_upload(spark, path, dataset_id, source_type), "upload")
    row = records.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(dataset_id).cast("bigint").alias("dataset_id"),
        F.lit(name.strip()).alias("name"),
        F.lit(description.strip() if description else None).cast("string").alias("description"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
        F.lit(source_type).alias("source_type"),
        "record_count",
    )
    status = profile.readiness(profile.inspect_schema(records))
    return uploads.check_source_types(
        row.join(status, "dataset_id", "left").na.fill("mapping_required", ["status"])
    ).select("dataset_id", "name", "description", "created_at", "status", "source_type", "record_count")


def register_upload(
    store: Store, path: str, dataset_id: int, name: str, source_type: str,
    created_at: datetime, description: str | None = None,
) -> None:
    """Check, profile and store a new upload: its dataset row and its files."""
    row = describe_upload(store.spark, path, dataset_id, name, source_type, created_at, description)
    found = store.spark.read.format("binaryFile").load(path).select(
        F.lit(dataset_id).cast("bigint").alias("dataset_id"),
        F.col("_metadata.file_name").alias("original_filename"),
        F.col("length").alias("size_bytes"),
    )
    sinks.append_dataset(store, row, created_at)
    sinks.append_files(store, found)


def list_uploads(store: Store) -> DataFrame:
    """Stored datasets with their files, newest first."""
    return browse.list_uploads(sinks.datasets(store), sinks.uploaded_files(store))


def map_upload(
    store: Store, path: str, dataset_id: int, source_type: str, fresh: DataFrame, changed_at: datetime
) -> None:
    """Replace a dataset's stored mappings; an empty ``fresh`` clears them."""
    suggestions = inspect_upload(store.spark, path, dataset_id, source_type)
    only = store.spark.range(dataset_id, dataset_id + 1).withColumnRenamed("id", "dataset_id")
    sinks.store_mappings(store, fresh, suggestions, changed_at, only)


def mapping_list(store: Store, dataset_id: int) -> DataFrame:
    return profile.dataset_mappings(sinks.mappings(store), dataset_id)


def preview_upload(store: Store, path: str, dataset_id: int, source_type: str, limit: int = 10) -> DataFrame:
    """The first records of an upload as its stored mappings would load them."""
    records = files.read_upload(store.spark, path, dataset_id, source_type)
    return uploads.preview(records, sinks.mappings(store), limit)


def load_upload(
    store: Store,
    path: str,
    dataset_id: int,
    source_type: str,
    mappings: DataFrame | None = None,
    strict: bool = True,
) -> dict[str, int]:
    """Normalize and store one upload; strict as the default, as one bad time voids it.

    Without ``mappings`` the stored ones of the dataset apply. A lenient load stores what it could not read as records in the table ``upload_rejects``.
    """
    chosen = sinks.mappings(store) if mappings is None else mappings
    records = files.read_upload(store.spark, path, dataset_id, source_type, strict)
    numbered = files.with_event_ids(records.withColumn("source_name", F.col("source_type")))
    normalized = uploads.timestamp_gate(uploads.normalize_uploads(numbered, chosen), strict)
    if not strict:
        sinks.append_rejects(store, files.upload_rejects(store.spark, path, dataset_id))
    return sinks.append_events(store, normalized)


def browse_stored_events(
    store: Store, start: datetime | None = None, end: datetime | None = None, **filters
) -> DataFrame:
    """A page of stored events (see ``browse.browse_events``); time bounds read only their days."""
    return browse.browse_events(sinks.events(store, start, end), start=start, end=end, **filters)


def detect(
    store: Store, dataset_id: int | None = None, everything: bool = False
) -> dict[str, int]:
    """Run the rules over one scope, or over all scopes at once; returns the counters."""
    events = sinks.events(store)
    if not everything:
        events = rules.in_scope(events, dataset_id)
    candidates = materialize(rules.detect(events), "candidates")
    fresh = sinks.append_alerts(store, candidates)
    found, created = candidates.count(), fresh.count()
    return {
        "events_analyzed": events.count(),
        "alerts_created": created,
        "alerts_skipped": found - created,
    }


def correlate_alerts(
    store: Store, run_at: datetime, dataset_id: int | None = None, everything: bool = False
) -> dict[str, int]:
    """Group free alerts into incidents and store them; returns the counters."""
    events, held = sinks.events(store), sinks.alerts(store)
    if not everything:
        events, held = rules.in_scope(events, dataset_id), rules.in_scope(held, dataset_id)
    free = materialize(
        correlate.unassigned_alerts(held, sinks.incidents(store)).drop("incident_id"), "free-alerts"
    )
    at = F.lit(run_at).cast("timestamp")
    assigned = materialize(correlate.assign_incidents(free, at), "assigned-alerts")
    built = materialize(correlate.build_incidents(assigned, at), "incidents")
    links = materialize(evidence.incident_events(assigned, events), "incident-events")
    sinks.append_incidents(store, assigned, built, links, run_at)
    return {
        "alerts_analyzed": free.count(),
        "incidents_created": built.count(),
        "alerts_linked": assigned.count(),
        "incident_events_linked": links.count(),
    }


def stored_evidence(store: Store, dataset_id: int | None = None, everything: bool = False) -> summary.Evidence:
    incidents = sinks.incidents(store)
    if not everything:
        incidents = rules.in_scope(incidents, dataset_id)
    return summary.gather_evidence(
        incidents, sinks.alerts(store), sinks.incident_links(store), sinks.events(store)
    )


def summarize(
    store: Store,
    run_at: datetime,
    dataset_id: int | None = None,
    only_missing: bool = False,
    provider: Callable[[summary.Evidence], DataFrame] = summary.summarize,
) -> dict[str, int]:
    """Store a summary for every incident of a scope; returns how many were made."""
    gathered = stored_evidence(store, dataset_id)
    checked = gathered.incidents.count()
    if only_missing:
        # The provider may be costly: it sees only the incidents that lack a summary.
        missing = materialize(
            summary.missing_summaries(gathered.incidents, sinks.summaries(store)).select("incident_id"),
            "missing-summaries",
        )
        gathered = summary.Evidence(
            *(part.join(missing, "incident_id", "left_semi")
              for part in (gathered.incidents, gathered.alerts, gathered.events))
        )
    drafts = materialize(provider(gathered), "summaries")
    sinks.append_summaries(store, drafts, run_at, gathered.events)
    return {
        "incidents_checked": checked,
        "summaries_created": drafts.count(),
    }


def write_report(store: Store, run_at: datetime, dataset_id: int | None = None) -> None:
    """Store the reports of a scope's incidents as pieces.

    Where there is a summary, the report shows the evidence as of its latest version.
    """
    latest = materialize(summary.latest_summary(sinks.summaries(store)), "latest-summaries")
    pieces = report.report_pieces(
        stored_evidence(store, dataset_id),
        F.lit(run_at).cast("timestamp"),
        latest,
        sinks.timeline_of(store, latest),
    )
    sinks.write_pieces(store, "reports", pieces, dataset_id)


def run_all(spark: SparkSession, root: str, folder: str, run_at: datetime) -> dict[str, dict[str, int]]:
    """Load the built-in sources, detect and correlate; returns each step's counters."""
    store = Store(configure(spark), root)
    return {
        "etl": load_sources(store, folder),
        "detections": detect(store),
        "incidents": correlate_alerts(store, run_at),
    }


def run_upload(
    spark: SparkSession,
    root: str,
    path: str,
    dataset_id: int,
    source_type: str,
    run_at: datetime,
    mappings: DataFrame | None = None,
) -> dict[str, dict[str, int]]:
    """Load one upload, detect and correlate in its scope, and summarize what is new.

    The status of a dataset stored with ``sinks.append_dataset`` is kept up to date.
    """
    store = Store(configure(spark), root)
    loaded = load_upload(store, path, dataset_id, source_type, mappings)
    sinks.set_status(store, dataset_id, "normalized", run_at, loaded["processed"])
    counters = {
        "etl": loaded,
        "detections": detect(store, dataset_id),
        "incidents": correlate_alerts(store, run_at, dataset_id),
        "summaries": summarize(store, run_at, dataset_id, only_missing=True),
    }
    sinks.set_status(store, dataset_id, "workflow_complete", run_at)
    return counters
