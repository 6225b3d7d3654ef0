"""Readers for log files: JSON arrays, CSV, and newline-delimited JSON.

Every reader returns records (``file_name``, ``record_no``, ``payload`` as JSON text) in which
``record_no`` counts the records or lines of the file from 1.

Files of every format are split across tasks (see ``sources.splits``), and no list of files passes
through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentrel.schema import RECORD_SCHEMA
from sentrel.session import materialize
from sentrel.sources.records import ndjson_records, ndjson_rejects
from sentrel.sources.splits import csv_cells, csv_records, json_segments, named_like

# Upload formats by file suffix.
SUFFIXES = (".csv", ".json", ".ndjson")


@dataclass(frozen=True)
class SourceFile:
    source_name: str
    file_name: str


# The built-in sources and their files, in load order.
SOURCE_FILES: tuple[SourceFile, ...] = (
    SourceFile("auth", "auth_logs.json"),
    SourceFile("vpn", "vpn_logs.csv"),
    SourceFile("cloud_audit", "cloud_audit_logs.json"),
    SourceFile("api_access", "api_access_logs.csv"),
    SourceFile("endpoint_alert", "endpoint_alerts.json"),
)


def _numbered(rows: DataFrame, number: str) -> DataFrame:
    """Number the rows of each file from 1 in file order, without gathering a file in one task.

    A split holds consecutive rows of one file and ``monotonically_increasing_id`` counts up
    inside it, so a row's number is its place in its split plus the rows of earlier splits.
    Only the per-split counts are sorted.
    """
    tagged = rows.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("__block"),
    ).withColumn("__row", F.monotonically_increasing_id())
    splits = tagged.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("rows"), F.min("__row").alias("first_row")
    )
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = splits.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    place = F.col("before") + F.col("__row") - F.col("first_row") + 1
    return (
        tagged.join(splits, ["__file", "__block"])
        .withColumn(number, place)
        .drop("__file", "__block", "__row", "rows", "first_row", "before")
    )


def _records(df: DataFrame) -> DataFrame:
    return df.select("file_name", F.col("record_no").cast("bigint").alias("record_no"), "payload")


def _json_elements(spark: SparkSession, path: str | list[str], lone_object: bool, suffix: str | None) -> DataFrame:
    """Segments of JSON documents with the elements they hold; null where a segment is no JSON."""
    text = F.btrim(F.regexp_replace("text", "^\ufeff", ""), F.lit(" \t\r\n"))
    # A column of its own, made once for all the cases.
    segments = json_segments(spark, path, suffix).withColumn(
        "body", F.when(F.col("tail"), text).otherwise(F.concat(text, F.lit("}")))
    )
    body, first, tail = F.col("body"), F.col("place") == 0, F.col("tail")
    rest = F.when(body.startswith(","), F.concat(F.lit("["), F.substring(body, 2, 2**30)))
    of_array = (
        F.when(first & ~tail, F.concat(body, F.lit("]")))
        .when(first, body)
        .when(~tail, F.concat(rest, F.lit("]")))
        .when(body == "]", F.lit("[]"))
        # Something must follow the comma.
        .when(~F.regexp_like(body, F.lit(r"^,\s*\]$")), rest)
    )
    of_object = F.when(first & ~tail, F.concat(F.lit("["), body, F.lit("]"))).when(tail & (body == ""), F.lit("[]"))
    document = F.when(F.col("opener") == "[", F.when(~tail | body.endswith("]"), of_array))
    if lone_object:
        document = F.when(F.col("opener") == "{", of_object).otherwise(document)
    return segments.select(
        "file", "file_name", "block", "place",
        F.when(F.col("sound"), F.try_variant_get(F.try_parse_json(document), "$", "array<variant>")).alias("elements"),
    )


def read_json(
    spark: SparkSession, path: str | list[str], strict: bool = True, lone_object: bool = False,
    suffix: str | None = None,
) -> DataFrame:
    """Records of JSON files that hold an array of objects.

    A file is read by as many tasks as it has splits. ``lone_object`` also accepts a single object as
    one record. Strict: a file that is no such document, or an element that is no object, fails the
    job; otherwise it is left out, and ``json_rejects`` lists it.
    """
    segments = _json_elements(spark, path, lone_object, suffix)
    if not strict:
        return _records(_lenient_json(segments).where("is_record"))
    wanted = "an object or an array of objects" if lone_object else "a JSON array"
    wrong = F.raise_error(F.concat(F.lit(f"Expected {wanted} in "), F.col("file_name")))
    not_object = F.raise_error(
        F.concat(F.lit("Expected every record to be an object in "), F.col("file_name"))
    )
    # Every element is an object, so a segment holds one and its place is the record's.
    opened = segments.select(
        "file_name", (F.col("place") + 1).alias("record_no"),
        F.explode(F.coalesce("elements", wrong.cast("array<variant>"))).alias("element"),
    ).withColumn("text", F.to_json("element"))
    text = F.col("text")
    return _records(opened.withColumn("payload", F.when(text.startswith("{"), text).otherwise(not_object)))


def _lenient_json(segments: DataFrame) -> DataFrame:
    """Elements of the readable files, numbered, and whether they are objects."""
    segments = materialize(segments, "json-segments")
    bad = segments.where(F.col("elements").isNull()).select("file").distinct()
    good = segments.join(bad, "file", "left_anti")
    sizes = good.groupBy("file", "block").agg(F.sum(F.size("elements")).alias("size"))
    rows_before = lambda order: F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    blocks = sizes.select(
        "file", "block", rows_before(Window.partitionBy("file").orderBy("block")).alias("before")
    )
    in_block = rows_before(Window.partitionBy("file", "block").orderBy("place"))
    numbered = good.withColumn("size", F.size("elements")).withColumn("within", in_block).join(blocks, ["file", "block"])
    opened = numbered.select(
        "file_name", (F.col("before") + F.col("within") + 1).alias("first"),
        F.posexplode("elements").alias("at", "element"),
    )
    text = F.to_json("element")
    return opened.select(
        "file_name", (F.col("first") + F.col("at")).alias("record_no"), text.alias("payload"),
        F.coalesce(text.startswith("{"), F.lit(False)).alias("is_record"),
    )


def json_rejects(
    spark: SparkSession, path: str | list[str], lone_object: bool = True, suffix: str | None = None
) -> DataFrame:
    """What a lenient load leaves out: elements that are no objects, and unreadable files whole."""
    segments = materialize(_json_elements(spark, path, lone_object, suffix), "json-segments")
    files = segments.where(F.col("elements").isNull()).select("file", "file_name").distinct()
    return (
        _lenient_json(segments).where("NOT is_record")
        .select("file_name", F.col("record_no").cast("bigint").alias("record_no"), F.lit("not a JSON object").alias("reason"))
        .unionByName(
            files.select("file_name", F.lit(None).cast("bigint").alias("record_no"), F.lit("not a JSON document").alias("reason"))
        )
    )


def read_csv(
    spark: SparkSession, path: str | list[str], strict: bool = True, suffix: str | None = None
) -> DataFrame:
    """Records of CSV files with a header each, every cell as text.

    A file is read by as many tasks as it has splits, also where quoted cells hold line breaks. A
    short row has nulls for the missing cells. Strict: a row with more cells than its header fails
    the job; otherwise ``csv_rejects`` lists it.
    """
    rows = _csv_rows(spark, path, suffix)
    if not strict:
        return _records(rows.where(~F.col("overlong")))
    wrong = F.raise_error(
        F.concat(
            F.lit("More cells than columns in record "), F.col("record_no").cast("string"),
            F.lit(" of "), F.col("file_name"),
        )
    )
    # In the filter, so that no projection can prune the check.
    return _records(rows.where(F.when(F.col("overlong"), wrong.cast("boolean")).otherwise(F.lit(True))))


def csv_rejects(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """Rows with more cells than the header has columns."""
    rows = _csv_rows(spark, path, suffix).where("overlong")
    return rows.select("file_name", "record_no", F.lit("more cells than columns").alias("reason"))


def _csv_rows(spark: SparkSession, path: str | list[str], suffix: str | None) -> DataFrame:
    """Rows of all files, each with its own file's header: layouts are a table keyed by file."""
    records = materialize(csv_records(spark, path, suffix), "csv-records").withColumn("cells", csv_cells(F.col("text")))
    named = F.transform("names", lambda name, at: F.struct(name.alias("name"), at.alias("at")))
    # Of columns that share a name the last keeps it; columns without a name are dropped.
    later = lambda column: F.slice(F.col("names"), column["at"] + 2, F.size("names"))
    kept = F.filter(
        named, lambda column: (column["name"] != "") & ~F.array_contains(later(column), column["name"])
    )
    # One row per file, of a known size: the records are not shuffled by file for it.
    headers = materialize(
        records.where(F.col("record") == 1)
        .select("file", csv_cells(F.regexp_replace("text", "^\ufeff", "")).alias("names"))
        .select("file", kept.alias("columns"), F.size("names").alias("width")),
        "csv-headers",
    )
    cells = F.transform("columns", lambda column: F.struct(column["name"], F.get("cells", column["at"])))
    return records.where(F.col("record") > 1).join(headers, "file").select(
        "file_name", (F.col("record") - 1).cast("bigint").alias("record_no"),
        F.to_json(F.map_from_entries(cells)).alias("payload"), (F.size("cells") > F.col("width")).alias("overlong"),
    )


def read_lines(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """(file_name, line_no, line) of text files, blank lines counted."""
    lines = named_like(spark.read, suffix).text(path)
    return _numbered(lines, "line_no").withColumnRenamed("value", "line")


def read_ndjson(
    spark: SparkSession, path: str | list[str], strict: bool = True, suffix: str | None = None
) -> DataFrame:
    """Records of newline-delimited JSON. Strict: a bad line fails the job with its number."""
    lines = read_lines(spark, path, suffix)
    if not strict:
        return _records(ndjson_records(lines))
    message = F.raise_error(
        F.concat(
            F.lit("Invalid NDJSON on line "), F.col("line_no").cast("string"), F.lit(" of "),
            F.col("file_name"), F.lit(": "), F.col("reason"),
        )
    )
    bad = ndjson_rejects(lines).select(
        "file_name", F.col("line_no").alias("record_no"), message.cast("string").alias("payload")
    )
    return _records(ndjson_records(lines)).unionByName(_records(bad))


def read_sources(
    spark: SparkSession, folder: str, sources: tuple[SourceFile, ...] = SOURCE_FILES
) -> DataFrame:
    """Records of all built-in sources, tagged with their source, in load order.

    A source may also be a folder of files with the same suffix.
    """

    def one(source: SourceFile) -> DataFrame:
        path = f"{folder}/{source.file_name}"
        read = read_csv if source.file_name.endswith(".csv") else read_json
        return read(spark, path).withColumn("source_name", F.lit(source.source_name))

    parts = [one(source) for source in sources]
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("dataset_id", F.lit(None).cast("bigint"))
        .select(*RECORD_SCHEMA.fieldNames())
    )


def read_upload(
    spark: SparkSession,
    path: str,
    dataset_id: int,
    source_type: str,
    strict: bool = True,
) -> DataFrame:
    """Records of an uploaded file, or of all files in a folder, by suffix."""
    if strict:
        found = _unknown_files(spark, path).select("file_name").head(3)
        if found:
            names = sorted(row["file_name"] for row in found)
            raise ValueError(f"Only {', '.join(SUFFIXES)} uploads are supported, found {names}")
    parts = [
        read_csv(spark, path, strict, ".csv"),
        read_json(spark, path, strict, lone_object=True, suffix=".json"),
        read_ndjson(spark, path, strict, ".ndjson"),
    ]
    records = reduce(DataFrame.unionByName, parts)
    return records.withColumn("dataset_id", F.lit(dataset_id).cast("bigint")).withColumn(
        "source_type", F.lit(source_type)
    )


def upload_rejects(spark: SparkSession, path: str, dataset_id: int) -> DataFrame:
    """(dataset_id, file_name, record_no, reason): what a lenient ``read_upload`` leaves out.

    Files of an unknown format are listed whole, without a record number.
    """
    lines = ndjson_rejects(read_lines(spark, path, ".ndjson"))
    parts = [
        _unknown_files(spark, path).select(
            "file_name", F.lit(None).cast("bigint").alias("record_no"), F.lit("unsupported format").alias("reason")
        ),
        csv_rejects(spark, path, ".csv"),
        json_rejects(spark, path, suffix=".json"),
        lines.select("file_name", F.col("line_no").cast("bigint").alias("record_no"), "reason"),
    ]
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(dataset_id).cast("bigint").alias("dataset_id"), "file_name", "record_no", "reason"
    )


def _unknown_files(spark: SparkSession, path: str) -> DataFrame:
    """Files with content whose format is not known; only their names are read."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(path).where("length > 0").select(
        name.alias("file_name"), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).alias("suffix")
    ).where(~F.col("suffix").isin(*SUFFIXES))


def with_event_ids(records: DataFrame, sources: tuple[SourceFile, ...] = SOURCE_FILES) -> DataFrame:
    """Add ``event_id``: 1, 2, 3, ... by source, file and record number.

    Numbers follow from per-file counts, so the records themselves are never sorted. Records and
    counts are written first: files are read once, and as the size of the counts, one row per
    file, is known, they reach the records without a shuffle by file.
    """
    records = materialize(records, "numbered-records")
    rank: Column = F.lit(len(sources))
    for place, source in enumerate(sources):
        rank = F.when(F.col("source_name") == source.source_name, F.lit(place)).otherwise(rank)
    files = records.groupBy("dataset_id", "source_name", "file_name").agg(
        F.max("record_no").alias("rows")
    )
    # One row per file.
    earlier = Window.orderBy(F.asc_nulls_first("dataset_id"), rank, "source_name", "file_name").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = materialize(
        files.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).select(
            F.col("dataset_id").alias("__scope"), F.col("source_name").alias("__source"),
            F.col("file_name").alias("__file"), "before",
        ),
        "file-offsets",
    )
    joined = records.join(
        offsets,
        records["dataset_id"].eqNullSafe(offsets["__scope"])
        & records["source_name"].eqNullSafe(offsets["__source"])
        & (records["file_name"] == offsets["__file"]),
    )
    return joined.withColumn("event_id", F.col("before") + F.col("record_no")).drop(
        "__scope", "__source", "__file", "before"
    )
