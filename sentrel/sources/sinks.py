"""Stored tables: append-only Parquet folders under one root.

Every append first drops what the table already holds, so a run can be repeated. A table is
read at the start of an append and written once; readers see either version.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions.payload import canonical_json
from sentrel.operators.profile import EDITABLE_STATUSES, replace_mappings
from sentrel.operators.rules import new_alerts
from sentrel.operators.summary import technical_pieces
from sentrel.schema import (
    ALERT_SCHEMA, DATASET_SCHEMA, EVENT_SCHEMA, INCIDENT_EVENT_SCHEMA, INCIDENT_SCHEMA,
    MAPPING_SCHEMA,
)
from sentrel.session import materialize
from sentrel.sources.records import first_of_each, not_stored

# Dataset statuses in the order a dataset goes through them.
DATASET_STATUSES = (
    "uploaded", "mapping_required", "ready_to_normalize", "normalized", "workflow_complete",
)

PIECE_SCHEMA = "incident_id string, section int, place array<bigint>, text string"


@dataclass(frozen=True)
class Store:
    """Tables of one deployment."""

    spark: SparkSession
    root: str
    #: Buckets of the raw events, for the first session that uses the store; about one for each
    #: 256 MB of raw events it is to hold.
    key_buckets: int = 32

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: T.StructType | str, dated: bool = False) -> DataFrame:
        """A table, empty if nothing was ever appended; dated ones also show ``event_date``."""
        if dated:
            schema = T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, table: str, rows: DataFrame, by_day_of: str | None = None) -> None:
        if by_day_of is None:
            rows.write.mode("append").parquet(self.path(table))
            return
        # One file per task and day would be many small files; sending each day to few tasks
        # would make a busy day slow. Spark's rebalance picks partition sizes at run time.
        dated = rows.withColumn("event_date", F.to_date(by_day_of)).hint("rebalance", "event_date")
        dated.write.mode("append").partitionBy("event_date").parquet(self.path(table))


_RAW = (
    "event_id bigint, dataset_id bigint, event_timestamp timestamp, source_system string, "
    "event_type string, raw_payload string, event_key string"
)
RAW_COLUMNS = [part.split()[0] for part in _RAW.split(", ")]


def _raw_table(store: Store) -> str:
    """Name of the raw events in this session's catalog; their files are bucketed by ``event_key``.

    The number of buckets is the store's own from its first use on, whatever later sessions ask for.
    """
    known = store.read("raw_layout", "buckets int").first()
    if known is None:
        store.append("raw_layout", store.spark.createDataFrame([(store.key_buckets,)], "buckets int"))
    buckets = known["buckets"] if known else store.key_buckets
    name = f"raw_events_{hashlib.md5(store.path('raw_events').encode()).hexdigest()}"
    place = store.path("raw_events").replace("'", "\\'")
    store.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_RAW}) USING parquet "
        f"CLUSTERED BY (event_key) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    store.spark.catalog.refreshTable(name)
    return name


def raw_events(store: Store) -> DataFrame:
    """Stored raw events; a join on ``event_key`` reads them bucket by bucket, without a shuffle."""
    return store.spark.table(_raw_table(store))


def append_raw(store: Store, rows: DataFrame) -> None:
    name = _raw_table(store)
    buckets = store.read("raw_layout", "buckets int").first()["buckets"]
    # One task writes a bucket, so a run adds one file to each.
    rows.select(RAW_COLUMNS).repartition(buckets, "event_key").write.insertInto(name)


def _last_id(store: Store) -> int:
    """The largest id handed out; runs reserve theirs in a table of their own before using them."""
    reserved = store.read("event_ids", "last_id bigint").agg(F.max("last_id")).first()[0]
    if reserved is None:
        reserved = raw_events(store).agg(F.max("event_id")).first()[0]
    return reserved or 0


def append_events(store: Store, normalized: DataFrame) -> dict[str, int]:
    """Store raw and normalized events not stored yet; returns the run's counters.

    ``normalized`` carries ``event_id``, ``payload`` and the canonical fields. The raw table
    keeps the payload as canonical JSON and the key that identifies an event; an event is known by
    its key alone, also where its time is read differently now. The normalized table is checked
    on its own, so a run that died between the two appends is completed by the next.
    """
    last_id = _last_id(store)
    known = raw_events(store).select("event_key", F.col("event_id").alias("stored_id"))
    seen = Observation()
    normalized = normalized.observe(seen, F.count(F.lit(1)).alias("processed"))
    # The canonical payload is made once, for the key and for the raw table.
    canonical = normalized.withColumn("raw_payload", canonical_json(F.col("payload"))).drop("payload")
    distinct = first_of_each(canonical, F.col("raw_payload"))
    # Joined by key at every size: only this run's rows are shuffled, to the stored buckets.
    keyed = materialize(
        distinct.hint("merge").join(known, "event_key", "left")
        .withColumn("event_id", F.coalesce("stored_id", F.col("event_id") + F.lit(last_id))),
        "keyed-events",
    )
    is_new = F.col("stored_id").isNull()
    added, largest, low, high = keyed.agg(
        F.count_if(is_new), F.max(F.when(is_new, F.col("event_id"))), F.min("stored_id"), F.max("stored_id")
    ).first()
    if added:
        store.append("event_ids", store.spark.createDataFrame([(largest,)], "last_id bigint"))
        append_raw(store, keyed.where(is_new))
    fresh, inserted = keyed.where(is_new).select(*EVENT_SCHEMA.fieldNames()), added
    if low is not None:
        held = store.read("normalized_events", EVENT_SCHEMA, dated=True).where(F.col("event_id").between(low, high))
        again = not_stored(keyed.where(~is_new), held, ["event_id"])
        # Written first: it is read from the table that it is appended to.
        fresh = materialize(
            fresh.unionByName(again.select(*EVENT_SCHEMA.fieldNames())), "normalized-events"
        )
        inserted = fresh.count()
    store.append("normalized_events", fresh, "event_timestamp")
    processed = seen.get["processed"]
    return {
        "processed": processed,
        "raw_inserted": added,
        "normalized_inserted": inserted,
        "skipped_existing": processed - inserted,
    }


def events(store: Store, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Stored events; with time bounds, those of the days between, which prunes the day folders."""
    df = store.read("normalized_events", EVENT_SCHEMA, dated=True)
    if start:
        df = df.where(F.col("event_date") >= F.to_date(F.lit(start)))
    if end:
        df = df.where(F.col("event_date") <= F.to_date(F.lit(end)))
    return df.select(*EVENT_SCHEMA.fieldNames())


_REJECT = "dataset_id bigint, file_name string, record_no bigint, reason string"


def append_rejects(store: Store, rejects: DataFrame) -> None:
    known = store.read("upload_rejects", _REJECT)
    keys = ["dataset_id", "file_name", "record_no", "reason"]
    store.append("upload_rejects", not_stored(materialize(rejects, "rejects"), known, keys))


def upload_rejects(store: Store) -> DataFrame:
    """Files, rows and lines that lenient loads left out, with the reason."""
    return store.read("upload_rejects", _REJECT)


# ---------------------------------------------------------------------------- datasets

_DATASET_VERSION = T.StructType([*DATASET_SCHEMA.fields, T.StructField("changed_at", T.TimestampType())])


def append_dataset(store: Store, dataset: DataFrame, changed_at: datetime) -> None:
    """Store a dataset row, or a later version of it."""
    stamp = F.lit(changed_at).cast("timestamp")
    rows = dataset.select(*DATASET_SCHEMA.fieldNames()).withColumn("changed_at", stamp)
    store.append("dataset_versions", rows)


def datasets(store: Store) -> DataFrame:
    """Every dataset as its latest version has it."""
    # Status order settles versions written at the same instant.
    progress = F.array_position(F.array(*(F.lit(name) for name in DATASET_STATUSES)), F.col("status"))
    row = F.struct(*DATASET_SCHEMA.fieldNames())
    return (
        store.read("dataset_versions", _DATASET_VERSION)
        .groupBy(F.col("dataset_id").alias("__id"))
        .agg(F.max_by(row, F.struct("changed_at", progress)).alias("row"))
        .select("row.*")
    )


def set_status(
    store: Store, dataset_id: int, status: str, changed_at: datetime, record_count: int | None = None
) -> None:
    """Store a dataset's new status, and its record count if given; unknown datasets are an error."""
    known = datasets(store).where(F.col("dataset_id") == dataset_id)
    if not known.head(1):
        raise LookupError(f"Dataset {dataset_id} is not stored")
    row = known.withColumn("status", F.lit(status))
    if record_count is not None:
        row = row.withColumn("record_count", F.lit(record_count).cast("bigint"))
    append_dataset(store, row, changed_at)


# ------------------------------------------------------------------- uploads and mappings

_FILE = "dataset_id bigint, original_filename string, size_bytes bigint"
_MAPPING_SET = "dataset_id bigint, changed_at timestamp"
_MAPPING_ROW = T.StructType([*MAPPING_SCHEMA.fields, T.StructField("changed_at", T.TimestampType())])


def append_files(store: Store, found: DataFrame) -> None:
    """Store the files of an upload once."""
    keys = ["dataset_id", "original_filename"]
    store.append("uploaded_files", not_stored(found, uploaded_files(store), keys))


def uploaded_files(store: Store) -> DataFrame:
    return store.read("uploaded_files", _FILE)


def mappings(store: Store) -> DataFrame:
    """The mapping rows of every dataset, as its latest stored set has them."""
    latest = (
        store.read("mapping_sets", _MAPPING_SET).groupBy("dataset_id")
        .agg(F.max("changed_at").alias("changed_at"))
    )
    rows = store.read("mapping_rows", _MAPPING_ROW)
    return rows.join(latest, ["dataset_id", "changed_at"]).select(*MAPPING_SCHEMA.fieldNames())


def store_mappings(
    store: Store, fresh: DataFrame, suggestions: DataFrame, changed_at: datetime,
    replaced: DataFrame | None = None,
) -> None:
    """Store new mapping sets and the status that follows; sets are versions, nothing is rewritten.

    ``replaced`` lists the datasets whose set changes, by default those in ``fresh``; one without
    fresh rows has an empty set from now on. Datasets that are unknown or locked are an error.
    """
    stamp = F.lit(changed_at).cast("timestamp")
    touched = (fresh if replaced is None else replaced).select("dataset_id").distinct()
    known = datasets(store)
    locked = touched.join(
        known.where(F.col("status").isin(*EDITABLE_STATUSES)), "dataset_id", "left_anti"
    ).head(1)
    if locked:
        raise LookupError(f"Dataset {locked[0]['dataset_id']} is unknown or its mappings are locked")
    _, updated = replace_mappings(mappings(store), known, fresh, suggestions, replaced)
    changed = materialize(updated.join(touched, "dataset_id", "left_semi"), "mapped-datasets")
    rows = fresh.join(touched, "dataset_id", "left_semi").select(*MAPPING_SCHEMA.fieldNames())
    store.append("mapping_rows", rows.withColumn("changed_at", stamp))
    store.append("mapping_sets", touched.withColumn("changed_at", stamp))
    append_dataset(store, changed, changed_at)


# ------------------------------------------------------------------- alerts and incidents


def append_alerts(store: Store, candidates: DataFrame) -> DataFrame:
    """Store candidates that are new; returns the stored rows of this run."""
    fresh = materialize(new_alerts(candidates, store.read("alerts", ALERT_SCHEMA)), "new-alerts")
    store.append("alerts", fresh.select(*ALERT_SCHEMA.fieldNames()))
    return fresh


_ASSIGNMENT = "dataset_id bigint, alert_id string, incident_id string, assigned_at timestamp"


def alerts(store: Store) -> DataFrame:
    """Stored alerts with their latest incident, null while unassigned.

    Assignments are a table of their own: alerts are never rewritten.
    """
    held = store.read("alerts", ALERT_SCHEMA)
    latest = (
        store.read("alert_assignments", _ASSIGNMENT)
        .groupBy(F.col("dataset_id").alias("__scope"), F.col("alert_id").alias("__alert"))
        .agg(F.max_by("incident_id", F.struct("assigned_at", "incident_id")).alias("incident_id"))
    )
    joined = held.join(
        latest,
        held["dataset_id"].eqNullSafe(latest["__scope"]) & (held["alert_id"] == latest["__alert"]),
        "left",
    )
    return joined.drop("__scope", "__alert")


def incidents(store: Store) -> DataFrame:
    return store.read("incidents", INCIDENT_SCHEMA)


def incident_links(store: Store) -> DataFrame:
    return store.read("incident_events", INCIDENT_EVENT_SCHEMA)


def append_incidents(
    store: Store, assigned: DataFrame, built: DataFrame, links: DataFrame, run_at: datetime
) -> None:
    """Store new incidents, their evidence links and the alerts' assignments."""
    store.append("incidents", not_stored(built, incidents(store), ["incident_id"]))
    store.append(
        "incident_events", not_stored(links, incident_links(store), ["incident_id", "event_id"])
    )
    store.append(
        "alert_assignments",
        assigned.select(
            "dataset_id", "alert_id", "incident_id", F.lit(run_at).cast("timestamp").alias("assigned_at")
        ),
    )


# --------------------------------------------------------------------------- summaries

SUMMARY_SCHEMA = (
    "incident_id string, dataset_id bigint, summary_id string, created_at timestamp, "
    "model_name string, executive_summary string, technical_summary string, "
    "affected_users array<string>, affected_assets array<string>, suspected_attack_path string, "
    "recommended_containment_steps array<string>, alert_count bigint, event_count bigint"
)


_TIMELINE = (
    "summary_id string, incident_id string, event_id bigint, event_timestamp timestamp, "
    "source_system string, event_type string, username string, asset string, action string, "
    "outcome string, severity string, normalized_message string"
)


def append_summaries(
    store: Store, summaries: DataFrame, created_at: datetime, evidence: DataFrame
) -> None:
    """Store summaries, and as a table of their own the timeline each of them rests on: the rows
    of its evidence as they are now. A summary is a version; later ones leave it alone.
    """
    stamp = F.lit(created_at).cast("timestamp")
    rows = summaries.withColumn("created_at", stamp).withColumn(
        "summary_id", F.concat_ws("@", "incident_id", F.unix_micros(stamp).cast("string"))
    )
    names = [part.split()[0] for part in SUMMARY_SCHEMA.split(", ")]
    store.append("summaries", rows.select(*names))
    own = [part.split()[0] for part in _TIMELINE.split(", ")]
    store.append(
        "summary_timeline",
        rows.select("summary_id", "incident_id")
        .join(evidence.select(*own[1:]), "incident_id").select(*own),
    )


def summaries(store: Store) -> DataFrame:
    return store.read("summaries", SUMMARY_SCHEMA)


def summary_timeline(store: Store) -> DataFrame:
    """Timeline of every stored summary version, as it was when the summary was made."""
    return store.read("summary_timeline", _TIMELINE)


def timeline_of(store: Store, chosen: DataFrame) -> DataFrame:
    """The stored timeline of the chosen summary versions."""
    return summary_timeline(store).join(chosen.select("summary_id"), "summary_id", "left_semi")


def technical_text(store: Store) -> DataFrame:
    """The whole technical text of every stored summary as pieces, by ``summary_id``."""
    stored = summaries(store).withColumn("incident_id", F.col("summary_id"))
    ids = summary_timeline(store).select(F.col("summary_id").alias("incident_id"), "event_id")
    return technical_pieces(stored, ids).withColumnRenamed("incident_id", "summary_id")


# ----------------------------------------------------------------------------- reports


def write_pieces(store: Store, table: str, pieces: DataFrame, dataset_id: int | None) -> None:
    """Store a scope's document pieces so that every document lies in neighbouring files, in order.

    They replace the scope's earlier documents and leave other scopes alone. The range partitioning cuts by size, also inside one document: a report of any length is
    spread over as many tasks and files as it needs.
    """
    order = ["incident_id", "section", "place"]
    scope = "sample" if dataset_id is None else str(dataset_id)
    pieces.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(
        f"{store.path(table)}/scope={scope}"
    )


def read_document(store: Store, table: str, incident_id: str) -> DataFrame:
    """The pieces of one document in order; joined, their texts are the document."""
    pieces = store.read(table, PIECE_SCHEMA).where(F.col("incident_id") == incident_id)
    return pieces.drop("scope").orderBy("section", "place")


def write_reports(documents: DataFrame, path: str, name: Column) -> None:
    """Write one Markdown file per document row, in a folder named after the report."""
    # The text writer ends each value with the line break that ends the document.
    body = F.regexp_replace("document", r"\n\z", "")
    documents.select(name.alias("report"), body.alias("value")).write.mode(
        "overwrite"
    ).partitionBy("report").text(path)
