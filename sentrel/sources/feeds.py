"""The ``events`` table rendered as raw source records, for the ingest and profiling jobs.

Every row becomes one record, with the blanks, missing fields, alternative field names and
odd time formats such feeds have, chosen by the row's own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.sources.telemetry import _burst_time, _events, _text


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table may be one row group; rows are dealt out before they are rendered."""
    return _events(spark, sf_dir).repartition("event_id").withColumn("at", _burst_time(F.col("ts")))


def _iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _user() -> Column:
    return F.concat(F.lit("user-"), _text(F.col("user_id")))


def _json(**fields: Column) -> Column:
    """JSON object text; null fields are left out."""
    return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))


#: Columns of the sources that come as CSV files, all text.
CSV_COLUMNS = {
    "vpn": (
        "vpn_event_id", "time", "user", "client_ip", "assigned_private_ip", "device_name", "action", "result",
        "session_id",
    ),
    "api_access": (
        "request_id", "timestamp", "user", "source_ip", "asset", "http_method", "path", "status_code",
        "response_bytes", "records_returned", "request_category",
    ),
}


def csv_schema(source: str) -> str:
    return ", ".join(f"`{name}` string" for name in CSV_COLUMNS[source])


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the five built-in sources, no dataset."""
    k, u, kind = F.col("k"), F.col("user_id"), F.col("kind")
    at = _iso(F.col("at"))
    ip = F.concat(F.lit("203.0.113."), _text(u % 200))
    record_id = _text(F.col("event_id"))
    auth = _json(
        event_id=F.concat(F.lit("auth-"), record_id),
        timestamp=at,
        source_system=F.when(k % 7 == 0, "  ").otherwise("CLOUD-IAM"),
        event_type=F.when(k % 11 != 0, F.lit("interactive_login")),
        username=F.when(k == 99, F.lit("")).when(k % 2 == 0, F.concat(F.lit("  "), _user(), F.lit(" ")))
        .otherwise(_user()),
        source_ip=ip,
        asset=F.concat(F.lit("IAM-"), _text(u % 4)),
        action=F.lit("login"),
        outcome=F.when(kind == "error", "failure").otherwise("success"),
        severity=F.when(k % 3 == 0, F.lit("High")),
        reason=F.when(k % 4 == 0, F.lit("   ")).otherwise(F.concat(F.lit("reason "), _text(k))),
    )
    vpn = _json(
        vpn_event_id=F.concat(F.lit("vpn-"), record_id),
        time=at,
        user=_user(),
        client_ip=ip,
        assigned_private_ip=F.concat(F.lit("10.8.0."), _text(u % 250)),
        device_name=F.concat(F.lit("LAPTOP-"), _text(u)),
        action=F.when(k % 4 == 0, "connect").when(k % 4 == 1, "").otherwise("disconnect"),
        result=F.when(k % 6 != 0, F.lit("success")),
        session_id=F.when(k % 5 != 0, F.concat(F.lit("s-"), record_id)),
    )
    cloud = F.to_json(
        F.struct(
            F.concat(F.lit("audit-"), record_id).alias("audit_id"),
            at.alias("event_time"),
            F.when(k % 9 != 0, _user()).alias("actor"),
            ip.alias("source_ip"),
            F.when(k % 3 == 0, "identity").when(k % 3 == 1, "object-storage").otherwise("")
            .alias("service"),
            F.lit("CLOUD-IAM").alias("asset"),
            F.when(k % 10 == 0, "CreateAccessKey").when(k % 10 == 1, "AttachUserPolicy")
            .when(k % 10 == 2, "").otherwise("ListUsers").alias("operation"),
            F.lit("success").alias("outcome"),
            F.when(k % 8 != 0, F.concat(F.lit("res/"), _text(u % 9))).alias("target_resource"),
            F.struct(k.alias("k"), F.lit("x").alias("purpose")).alias("details"),
        )
    )
    api = _json(
        request_id=F.concat(F.lit("req-"), record_id),
        timestamp=at,
        user=_user(),
        source_ip=ip,
        asset=F.lit("API-GATEWAY-01"),
        http_method=F.when(k % 6 == 0, "").otherwise("GET"),
        path=F.when(k % 7 != 0, F.lit("/api/v1/export")),
        status_code=F.when(k % 5 == 0, 403).otherwise(200),
        response_bytes=k * 1000,
        records_returned=F.when(k % 4 != 0, k * 10),
        request_category=F.when(k % 3 != 0, F.lit("bulk_export")),
    )
    endpoint = _json(
        endpoint_event_id=F.concat(F.lit("end-"), record_id),
        observed_at=at,
        host=F.concat(F.lit("LAPTOP-"), _text(u % 50)),
        user_name=_user(),
        source_system=F.when(k % 2 == 0, F.lit("endpoint-edr")),
        event_type=F.when(k % 5 == 4, "credential_access").otherwise(" "),
        destination_ip=F.when(k % 3 == 0, F.lit("198.51.100.24")),
        action=F.lit("alert"),
        outcome=F.lit("blocked"),
        severity=F.when(k % 4 == 0, "critical").otherwise("medium"),
        mitre_technique_id=F.when(k % 5 == 4, F.lit("T1003.001")),
        message=F.when(k % 2 == 1, F.concat(F.lit("detail "), _text(k))),
    )
    return _rows(spark, sf_dir).select(
        F.lit(None).cast("bigint").alias("dataset_id"),
        F.when(kind.isin("error", "signup"), "auth").when(kind == "view", "vpn")
        .when(kind == "click", "cloud_audit").when(k < 50, "api_access")
        .otherwise("endpoint_alert").alias("source_name"),
        F.concat(F.lit("part-"), _text(F.col("event_id") % 4), F.lit(".ndjson")).alias("file_name"),
        F.col("event_id").alias("record_no"),
        F.when(kind.isin("error", "signup"), auth).when(kind == "view", vpn)
        .when(kind == "click", cloud).when(k < 50, api).otherwise(endpoint).alias("payload"),
    )


def upload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of six uploaded datasets, one per source type, with varying field names."""
    k, u, at = F.col("k"), F.col("user_id"), F.col("at")
    slot = u % 6
    source_type = (
        F.when(slot == 0, "auth").when(slot == 1, "vpn").when(slot == 2, "cloud")
        .when(slot == 3, "api").when(slot == 4, "endpoint").otherwise("generic")
    )
    fields: dict[str, Column] = {
        "timestamp": F.when(k % 3 == 0, _iso(at)).when(k % 3 == 1, ""),
        "eventTime": F.when(
            k % 3 == 1,
            F.when(k % 7 == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(_iso(at)),
        ),
        "observed_at": F.when(
            k % 3 == 2,
            F.when(k == 98, F.lit("not-a-time"))
            .when(k % 2 == 0, F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"))
            .otherwise(
                F.date_format(at + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")
            ),
        ),
        "username": F.when(k % 4 == 0, F.concat(F.lit("  "), _user(), F.lit(" "))).when(k % 4 == 1, "  "),
        "actor": F.when((k % 4 == 1) | (k % 4 == 2), _user()),
        "src_user": F.when(k % 4 == 3, F.concat(F.lit("svc-"), _text(u % 10))),
        "src_ip": F.concat(F.lit("203.0.113."), _text(u % 200)),
        "ip": F.lit("10.0.0.1"),
        "host": F.when(k % 2 == 0, F.concat(F.lit("LAPTOP-"), _text(u % 50))),
        "resource": F.when(k % 2 == 1, F.concat(F.lit("bucket/"), _text(u % 9))),
        "method": F.when(k % 5 < 2, F.lit("GET")),
        "path": F.when(
            k % 5 < 3, F.when(k % 2 == 0, "/api/v1/export").otherwise("/api/v1/profile")
        ),
        "action": F.when(k % 5 == 3, F.lit("login")),
        "operation": F.when(k % 5 == 4, F.concat(F.lit("Op"), _text(k % 10))),
        "event_type": F.when(k % 6 == 0, F.lit("custom_event")),
        "category": F.when(k % 6 == 1, F.concat(F.lit("cat-"), _text(k % 4))),
        "service": F.when(k % 2 == 0, F.lit("storage")),
        "source": F.when(k % 10 == 0, F.lit("siem")),
        "status": F.when(k % 3 == 0, F.lit(200)),
        "result": F.when(k % 3 == 1, F.lit("Failure")),
        "severity": F.when(k % 8 == 0, F.lit(" HIGH ")),
        "priority": F.when(k % 8 == 1, F.lit("Low")),
        "technique_id": F.when(k % 9 == 0, F.lit("T1003.001")),
        "message": F.when(k % 7 == 0, F.concat(F.lit("note "), _text(k))),
        "reason": F.when(k % 7 == 1, F.lit(" ")),
        "machine": F.struct(
            F.concat(F.lit("h"), _text(u % 20)).alias("hostname"),
            F.struct(F.lit("linux").alias("name")).alias("os"),
        ),
        "geo.city": F.when(k % 5 == 0, F.lit("literal")),
        "geo": F.struct(F.concat(F.lit("nested"), _text(k % 2)).alias("city")),
        "tags": F.array(F.lit("a"), F.concat(F.lit("t"), _text(k % 2))),
        "flag": k % 2 == 0,
    }
    payload = F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))
    return _rows(spark, sf_dir).select(
        (slot + 1).alias("dataset_id"),
        source_type.alias("source_type"),
        F.concat(F.lit("part-"), _text(F.col("event_id") % 4), F.lit(".ndjson")).alias("file_name"),
        F.col("event_id").alias("record_no"),
        payload.alias("payload"),
    )


def upload_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uploads as text lines, some of them blank or broken."""
    k = F.col("record_no") % 50
    broken = (
        F.when(k == 7, F.lit("   "))
        .when(k == 13, F.concat(F.substring("payload", 1, 40), F.lit("...")))
        .when(k == 21, F.lit("[1, 2]"))
        .when(k == 34, F.lit("null"))
        .when(k == 40, F.concat(F.lit("﻿"), F.col("payload")))
        .otherwise(F.col("payload"))
    )
    return upload_records(spark, sf_dir).select(
        "dataset_id", "file_name", F.col("record_no").alias("line_no"), broken.alias("line")
    )


def doubled(records: DataFrame) -> DataFrame:
    """Records with a third of them delivered again, keys in another order."""
    again = records.where(F.col("record_no") % 3 == 0).select(
        *(
            F.concat(
                F.lit('{"zz":0,'), F.substring("payload", 2, 2**30)
            ).alias("payload") if name == "payload" else F.col(name)
            for name in records.columns
        )
    )
    # The extra leading key sorts last in canonical form; appending the same key at the end of
    # the originals makes both payloads equal apart from key order.
    first = records.withColumn(
        "payload",
        F.when(
            F.col("record_no") % 3 == 0,
            F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit(',"zz":0}')),
        ).otherwise(F.col("payload")),
    )
    moved = again.withColumn("file_name", F.concat(F.lit("resent-"), F.col("file_name")))
    return first.unionByName(moved)


def mapping_table(spark: SparkSession) -> DataFrame:
    """Confirmed mappings of three of the datasets; the others are normalized automatically."""
    rows = [
        (1, "eventTime", "timestamp", "direct", None),
        (1, "machine.hostname", "asset", "uppercase", None),
        (1, "geo.city", "source_system", "direct", None),
        (1, "priority", "severity", "lowercase", "MEDIUM"),
        (1, "no.such.field", "username", "direct", None),
        (4, "timestamp", "timestamp", "direct", "2024-01-01T00:00:00Z"),
        (4, "status", "outcome", "direct", "unknown"),
        (4, "tags", "message", "uppercase", None),
        (4, "flag", "action", "direct", None),
        (6, "observed_at", "timestamp", "direct", None),
        (6, "actor", "username", "uppercase", "nobody"),
        (6, "no.such.field", "event_type", "direct", None),
    ]
    return spark.createDataFrame(
        rows,
        "dataset_id bigint, source_field string, target_field string, "
        "transformation_type string, default_value string",
    )
