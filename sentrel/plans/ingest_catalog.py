"""Registered ingest, normalization and profiling queries over the rendered feeds."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentrel.operators import browse, normalize, profile, uploads
from sentrel.plans import workflow
from sentrel.plans.registry import query
from sentrel.schema import NORMALIZED_COLUMNS, TARGET_FIELDS
from sentrel.session import materialize, shared_dir
from sentrel.sources import feeds, files, records, sinks
from sentrel.sources.sinks import Store
from sentrel.sources.telemetry import canonical_events


FIRST_SET, SECOND_SET = datetime(2024, 2, 1), datetime(2024, 2, 2)


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uploads as stored: rendering them is not part of any job."""
    return materialize(feeds.upload_records(spark, sf_dir), "upload-feed")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(feeds.source_records(spark, sf_dir), "source-feed")


def _flat(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys,
        F.unix_micros("event_timestamp").alias("t"),
        *NORMALIZED_COLUMNS[1:],
    )


def _one_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    of_source = _sources(spark, sf_dir).where(F.col("source_name") == source)
    return _flat(normalize.normalize_records(of_source), "record_no")


@query
def normalize_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_source(spark, sf_dir, "auth")


@query
def normalize_vpn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_source(spark, sf_dir, "vpn")


@query
def normalize_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_source(spark, sf_dir, "cloud_audit")


@query
def normalize_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_source(spark, sf_dir, "api_access")


@query
def normalize_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_source(spark, sf_dir, "endpoint_alert")


@query
def normalize_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five sources in one pass."""
    normalized = normalize.normalize_records(_sources(spark, sf_dir))
    return _flat(normalized, "source_name", "record_no")


@query
def normalize_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads by aliases alone."""
    normalized = uploads.normalize_uploads(_uploads(spark, sf_dir))
    return _flat(normalized, "dataset_id", "record_no")


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uploads.normalize_uploads(
        _uploads(spark, sf_dir), feeds.mapping_table(spark)
    )


@query
def normalize_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads with the confirmed mappings applied."""
    return _flat(_mapped(spark, sf_dir), "dataset_id", "record_no")


@query
def timestamp_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped records that cannot be loaded."""
    return uploads.timestamp_rejects(_mapped(spark, sf_dir))


@query
def mapping_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    previewed = uploads.preview(
        _uploads(spark, sf_dir), feeds.mapping_table(spark), limit=10
    )
    return _flat(previewed, "dataset_id", "scan_no", "warning")


@query
def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 records of each dataset."""
    first = uploads.first_records(_uploads(spark, sf_dir), 100)
    return first.select("dataset_id", "file_name", "record_no", "scan_no")


@query
def raw_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw event per distinct payload, over a feed that delivers a third of it twice."""
    normalized = normalize.normalize_records(
        materialize(feeds.doubled(feeds.source_records(spark, sf_dir)), "doubled-feed")
    )
    kept = records.first_of_each(normalized)
    return kept.select(
        "dataset_id", "source_system", "event_type", "file_name", "record_no",
        F.unix_micros("event_timestamp").alias("t"),
    )


@query
def raw_dedupe_other_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events after two loads; the second reads every time a day later, the first lacks a third."""
    store = Store(spark, f"{shared_dir(spark)}/stages/raw-{uuid.uuid4().hex}")
    feed = materialize(
        normalize.normalize_records(_sources(spark, sf_dir)).withColumn("event_id", F.col("record_no")), "feed"
    )
    sinks.append_events(store, feed.where(F.col("record_no") % 3 != 1))
    later = feed.withColumn("event_timestamp", F.expr("event_timestamp + interval 1 day"))
    sinks.append_events(store, later)
    return sinks.events(store).select(
        "event_id", "source_system", "event_type", F.unix_micros("event_timestamp").alias("t")
    )


@query
def ndjson_reject_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the uploads that hold no record."""
    rejects = records.ndjson_rejects(materialize(feeds.upload_lines(spark, sf_dir), "upload-lines"))
    return rejects.select("dataset_id", "file_name", "line_no", "reason")


def _file_rows(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Events as file rows; the note holds commas, quotes and a line break."""
    note = F.concat(
        F.lit('first "'), F.coalesce("asset", F.lit("")), F.lit('"\nsecond, '), F.col("event_id").cast("string")
    )
    return canonical_events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.coalesce("username", F.lit("")).alias("username"), note.alias("note"), *more,
    )


def _cells(payloads: DataFrame) -> DataFrame:
    cell = {name: F.get_json_object("payload", f"$.{name}") for name in ("event_id", "username", "note")}
    return payloads.select(
        cell["event_id"].cast("bigint").alias("event_id"), cell["username"].alias("username"), cell["note"].alias("note")
    )


@query
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events written as CSV in two column orders, with quoted line breaks, and read back."""
    rows, root = _file_rows(spark, sf_dir), f"{shared_dir(spark)}/stages/csv-{uuid.uuid4().hex}"
    even = F.col("event_id").cast("bigint") % 2 == 0
    for folder, part in (
        ("a", rows.where(even)), ("b", rows.where(~even).select("note", "event_id", "username"))
    ):
        part.write.option("header", True).option("escape", '"').csv(f"{root}/{folder}")
    return _cells(files.read_csv(spark, [f"{root}/a", f"{root}/b"]))


@query
def ndjson_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events written as lines of JSON and read back."""
    path = f"{shared_dir(spark)}/stages/ndjson-{uuid.uuid4().hex}"
    _file_rows(spark, sf_dir).select(F.to_json(F.struct("*"))).write.text(path)
    return _cells(files.read_ndjson(spark, path))


def _write_arrays(rows: DataFrame, path: str, group: str, order: str) -> None:
    """JSON objects (column ``payload``) as files that hold an array each, one for each group."""
    in_file = Window.partitionBy(group).orderBy(order)
    first, last = F.row_number().over(in_file) == 1, F.lead(order).over(in_file).isNull()
    rows.select(
        group,
        F.concat(F.when(first, "[").otherwise(","), F.col("payload"), F.when(last, "]").otherwise("")).alias("value"),
    ).write.partitionBy(group).text(path)


def _day() -> Column:
    return F.to_date("event_timestamp").alias("day")


@query
def json_array_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events written as JSON arrays, a file for each day, and read back."""
    path = f"{shared_dir(spark)}/stages/json-{uuid.uuid4().hex}"
    rows = _file_rows(spark, sf_dir, _day())
    rows = rows.withColumn("payload", F.to_json(F.struct("event_id", "username", "note")))
    _write_arrays(rows, path, "day", "event_id")
    return _cells(files.read_json(spark, path))


@query
def upload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload of all three formats, read by suffix."""
    path = f"{shared_dir(spark)}/stages/upload-{uuid.uuid4().hex}"
    rows = _file_rows(spark, sf_dir, _day())
    kind = F.col("event_id").cast("bigint") % 3
    payload = F.to_json(F.struct("event_id", "username", "note"))
    rows.where(kind == 0).drop("day").write.option("header", True).option("escape", '"').csv(f"{path}/a")
    as_json = rows.where(kind == 1).withColumn("payload", payload)
    _write_arrays(as_json, f"{path}/b-text", "day", "event_id")
    rows.where(kind == 2).select(payload).write.text(f"{path}/c-text")
    # The text writer names its files .txt; the readers are told their kind by the folder.
    read = files.read_csv(spark, f"{path}/a", suffix=".csv").unionByName(
        files.read_json(spark, f"{path}/b-text", lone_object=True)
    ).unionByName(files.read_ndjson(spark, f"{path}/c-text"))
    return _cells(read)


@query
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five sources written as their files, extracted, normalized and stored."""
    root = f"{shared_dir(spark)}/stages/sources-{uuid.uuid4().hex}"
    feed = _sources(spark, sf_dir)
    for source in files.SOURCE_FILES:
        own = feed.where(F.col("source_name") == source.source_name)
        path = f"{root}/in/{source.file_name}"
        if source.file_name.endswith(".csv"):
            cells = F.from_json("payload", feeds.csv_schema(source.source_name))
            own.select(cells.alias("cells")).select("cells.*").write.option("header", True).option(
                "escape", '"'
            ).csv(path)
        else:
            _write_arrays(own.withColumn("part", F.col("record_no") % 8), path, "part", "record_no")
    store = Store(spark, f"{root}/store")
    workflow.load_sources(store, f"{root}/in")
    return _flat(sinks.events(store))


@query
def upload_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset's records as NDJSON, loaded leniently into the store by its stored mappings (none)."""
    root = f"{shared_dir(spark)}/stages/load-{uuid.uuid4().hex}"
    own = _uploads(spark, sf_dir).where(F.col("dataset_id") == 2)
    own.select("payload").write.text(f"{root}/in/upload.ndjson")
    renamed = f"{root}/in"
    store = Store(spark, f"{root}/store")
    lines = files.read_ndjson(spark, f"{renamed}/upload.ndjson").withColumns(
        {"dataset_id": F.lit(2).cast("bigint"), "source_type": F.lit("vpn"), "source_name": F.lit("vpn")}
    )
    normalized = uploads.normalize_uploads(files.with_event_ids(lines), sinks.mappings(store))
    sinks.append_events(store, uploads.timestamp_gate(normalized, strict=False))
    return _flat(sinks.events(store), "dataset_id")


@query
def mappings_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored mappings and statuses after two datasets' sets were replaced."""
    store = Store(spark, f"{shared_dir(spark)}/stages/mappings-{uuid.uuid4().hex}")
    suggestions = materialize(profile.suggest_mappings(_fields(spark, sf_dir)), "suggestions")
    chosen = suggestions.where(F.col("target_field").isNotNull()).select(
        "dataset_id", F.col("path").alias("source_field"), "target_field",
        F.lit("direct").alias("transformation_type"), F.lit(None).cast("string").alias("default_value"),
    )
    sets = suggestions.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("record_count")).select(
        "dataset_id", F.concat(F.lit("set "), F.col("dataset_id").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("description"), F.lit(FIRST_SET).cast("timestamp").alias("created_at"),
        F.lit("mapping_required").alias("status"), F.lit("generic").alias("source_type"), "record_count",
    )
    sinks.append_dataset(store, sets, FIRST_SET)
    none = suggestions.where("false")
    sinks.store_mappings(store, chosen, none, FIRST_SET)
    again = chosen.where(F.col("dataset_id").isin(2, 4) & (F.col("target_field") != "timestamp"))
    sinks.store_mappings(store, again.withColumn("transformation_type", F.lit("uppercase")), none, SECOND_SET)
    return sinks.mappings(store).join(sinks.datasets(store), "dataset_id").select(
        "dataset_id", "source_field", "target_field", "transformation_type", "status"
    )


@query
def source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source types of the uploads as given in any case and with blanks, checked and cleaned."""
    given = _uploads(spark, sf_dir).withColumn(
        "source_type",
        F.when(F.col("record_no") % 3 == 0, F.upper("source_type"))
        .when(F.col("record_no") % 3 == 1, F.concat(F.lit(" "), F.col("source_type"), F.lit(" ")))
        .otherwise(F.col("source_type")),
    )
    return uploads.check_source_types(given).groupBy("dataset_id", "source_type").agg(F.count(F.lit(1)).alias("n"))


@query
def upload_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploaded datasets with their files, and their place in the listing."""
    feed = _uploads(spark, sf_dir)
    sets = feed.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("record_count")).select(
        "dataset_id", "record_count",
        F.expr("timestamp_micros(1704067200000000 + (dataset_id % 3) * 1000000)").alias("created_at"),
    )
    found = feed.groupBy("dataset_id", F.col("file_name").alias("original_filename")).agg(
        (F.count(F.lit(1)) * 100).alias("size_bytes")
    )
    listed = browse.list_uploads(sets, found).withColumn("place", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("place"))
    return listed.select(
        "dataset_id", "record_count", place.alias("place"),
        F.array_join(
            F.transform("files", lambda f: F.concat_ws(":", f["original_filename"], f["size_bytes"].cast("string"))), " "
        ).alias("files"),
    )


@query
def flatten_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf field of every uploaded record."""
    leaves = profile.flatten_paths(_uploads(spark, sf_dir))
    return leaves.select(
        "dataset_id", "record_no", "path", profile.render_sample(F.col("value")).alias("sample")
    )


@query
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    inspected = profile.inspect_schema(_uploads(spark, sf_dir))
    return inspected.select(
        "dataset_id", "path", F.array_join("sample_values", " | ").alias("samples"),
        "target_field", "confidence",
    )


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.first_seen(profile.flatten_paths(_uploads(spark, sf_dir)))


@query
def mapping_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.suggest_mappings(_fields(spark, sf_dir))


@query
def dataset_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.readiness(profile.suggest_mappings(_fields(spark, sf_dir)))


@query
def mapping_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of one proposal per field found in the uploads, faulty ones included."""
    # Read for the proposals and for their audit.
    fields = materialize(_fields(spark, sf_dir), "fields")
    n = F.col("ordinal")
    numbered = fields.select(
        "dataset_id", "path",
        F.expr("row_number() OVER (PARTITION BY dataset_id ORDER BY path)").alias("ordinal"),
    )
    targets = F.array(*(F.lit(name) for name in (*TARGET_FIELDS, "bogus")))
    proposals = numbered.select(
        "dataset_id", "ordinal",
        F.when(n % 11 == 5, F.lit("  ")).when(n % 7 == 3, F.concat(F.lit("nope."), F.col("path")))
        .otherwise(F.concat(F.lit(" "), F.col("path"), F.lit(" "))).alias("source_field"),
        F.get(targets, n % 13).alias("target_field"),
        F.when(n % 5 == 0, "direct").when(n % 5 == 1, " LowerCase ").when(n % 5 == 2, "uppercase")
        .when(n % 5 == 3, "").otherwise("reverse").alias("transformation_type"),
        F.lit(None).cast("string").alias("default_value"),
    )
    again = proposals.where(n % 6 == 0).withColumn("ordinal", n + 100).withColumn(
        "target_field", F.lit("message")
    )
    audited = profile.audit_mappings(proposals.unionByName(again), fields)
    return audited.select(
        "dataset_id", "ordinal", "source_field", "target_field", "transformation_type", "reason",
        "blocks",
    )
