"""Turning lines and payloads into records, and keeping one of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.payload import canonical_json, parse

BAD_JSON = "invalid JSON"
NOT_OBJECT = "not a JSON object"


def _texts(lines: DataFrame) -> DataFrame:
    """Non-blank lines as ``payload``; a leading byte-order mark is ignored."""
    payload = F.regexp_replace("line", "^\ufeff?\\s*", "")
    return lines.withColumn("payload", payload).where(F.col("payload") != "").drop("line")


def ndjson_records(lines: DataFrame) -> DataFrame:
    """Records of the lines (``line``, ``line_no``) that hold a JSON object."""
    good = parse(F.col("payload")).isNotNull() & F.col("payload").startswith("{")
    return _texts(lines).where(good).withColumnRenamed("line_no", "record_no")


def ndjson_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are neither blank nor an object, by line number, with the reason."""
    text = F.col("payload")
    reason = F.when(parse(text).isNull(), F.lit(BAD_JSON)).when(
        ~text.startswith("{"), F.lit(NOT_OBJECT)
    )
    return _texts(lines).withColumn("reason", reason).where("reason IS NOT NULL").drop("payload")


def first_of_each(normalized: DataFrame, canonical: Column | None = None) -> DataFrame:
    """One row per distinct payload within scope, source system and event type.

    Payloads are compared as canonical JSON (``canonical``, where a caller has it already), so key
    order does not matter; the first delivery is kept. Keeping rank one is a group limit: each
    task passes on at most one copy of a payload, however many there are.
    """
    order = Window.partitionBy("event_key").orderBy("file_name", "record_no")
    return (
        normalized.withColumn("event_key", event_key(canonical)).withColumn("copy_no", F.row_number().over(order))
        .where(F.col("copy_no") == 1)
        .drop("copy_no")
    )


def not_stored(fresh: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the stored table; missing key parts match each other."""
    known = stored.select(*(F.col(key).alias(f"__{key}") for key in keys))
    condition = F.lit(True)
    for key in keys:
        condition = condition & fresh[key].eqNullSafe(known[f"__{key}"])
    return fresh.join(known, condition, "left_anti")


def event_key(canonical: Column | None = None) -> Column:
    """Digest of what identifies an event: scope, source system, type, and payload in canonical form."""
    payload = canonical_json(F.col("payload")) if canonical is None else canonical
    parts = F.struct("dataset_id", "source_system", "event_type", payload.alias("payload"))
    return F.sha2(F.to_json(parts), 256)
