"""Normalization of the five built-in log sources into canonical fields.

All sources go through one scan: each record takes the branch of its own source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.functions.payload import top_fields
from sentrel.functions.text import blank_to_null, clean, safe_timestamp
from sentrel.schema import NORMALIZED_COLUMNS

Get = Callable[[str], Column]


def iso_timestamp(value: Column, strict: bool) -> Column:
    """ISO text to timestamp. Bad text fails the job when strict, else becomes null."""
    parsed = safe_timestamp(value)
    if not strict:
        return parsed
    wrong = F.raise_error(F.concat(F.lit("Invalid ISO timestamp: "), value)).cast("timestamp")
    return F.coalesce(parsed, F.when(blank_to_null(value).isNotNull(), wrong))


@dataclass(frozen=True)
class Source:
    """A log source: its time field, the other fields it reads, and its projection.

    ``project`` gets a function from field name to cleaned text and names the canonical
    columns the source fills; the rest stay null.
    """

    time_field: str
    fields: tuple[str, ...]
    project: Callable[[Get], dict[str, Column]]


def _or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def _auth(get: Get) -> dict[str, Column]:
    same = ("username", "source_ip", "asset", "action", "outcome", "severity", "mitre_technique_id")
    return {
        **{name: get(name) for name in same},
        "source_system": _or(get("source_system"), "CLOUD-IAM"),
        "event_type": _or(get("event_type"), "auth_event"),
        "normalized_message": get("reason"),
    }


def _vpn(get: Get) -> dict[str, Column]:
    action = _or(get("action"), "vpn_event")
    return {
        "source_system": F.lit("vpn"),
        "event_type": F.concat(F.lit("vpn_"), action),
        "username": get("user"),
        "source_ip": get("client_ip"),
        "destination_ip": get("assigned_private_ip"),
        "asset": get("device_name"),
        "action": action,
        "outcome": get("result"),
        "normalized_message": F.concat(
            F.lit("VPN "), action, F.lit(" "), _or(get("result"), "unknown"),
            F.lit(" for session "), _or(get("session_id"), "unknown"),
        ),
    }


def _cloud_audit(get: Get) -> dict[str, Column]:
    operation = _or(get("operation"), "cloud_audit_event")
    same = ("source_ip", "asset", "outcome", "severity", "mitre_technique_id")
    return {
        **{name: get(name) for name in same},
        "source_system": F.concat(F.lit("cloud_"), _or(get("service"), "audit")),
        "event_type": operation,
        "username": get("actor"),
        "action": operation,
        "normalized_message": F.concat(
            _or(get("actor"), "unknown actor"), F.lit(" performed "), operation, F.lit(" on "),
            _or(get("target_resource"), "unknown resource"),
        ),
    }


def _api_access(get: Get) -> dict[str, Column]:
    request = F.concat(
        _or(get("http_method"), "REQUEST"), F.lit(" "), _or(get("path"), "unknown_path")
    )
    return {
        "source_system": F.lit("api_gateway"),
        "event_type": _or(get("request_category"), "api_access"),
        "username": get("user"),
        "source_ip": get("source_ip"),
        "asset": get("asset"),
        "action": request,
        "outcome": get("status_code"),
        "normalized_message": F.concat(
            request, F.lit(" returned "), _or(get("status_code"), "unknown"), F.lit(" with "),
            _or(get("records_returned"), "unknown"), F.lit(" records and "),
            _or(get("response_bytes"), "unknown"), F.lit(" bytes"),
        ),
    }


def _endpoint_alert(get: Get) -> dict[str, Column]:
    same = ("destination_ip", "action", "outcome", "severity", "mitre_technique_id")
    return {
        **{name: get(name) for name in same},
        "source_system": _or(get("source_system"), "endpoint-edr"),
        "event_type": _or(get("event_type"), "endpoint_event"),
        "username": get("user_name"),
        "asset": get("host"),
        "normalized_message": get("message"),
    }


# Sources in load order, and the fields each one carries. Add sources here.
SOURCES: dict[str, Source] = {
    "auth": Source(
        "timestamp",
        ("source_system", "event_type", "username", "source_ip", "asset", "action", "outcome",
         "severity", "mitre_technique_id", "reason"),
        _auth,
    ),
    "vpn": Source(
        "time",
        ("user", "client_ip", "assigned_private_ip", "device_name", "action", "result",
         "session_id"),
        _vpn,
    ),
    "cloud_audit": Source(
        "event_time",
        ("actor", "source_ip", "service", "asset", "operation", "outcome", "severity",
         "mitre_technique_id", "target_resource"),
        _cloud_audit,
    ),
    "api_access": Source(
        "timestamp",
        ("user", "source_ip", "asset", "http_method", "path", "status_code", "response_bytes",
         "records_returned", "request_category"),
        _api_access,
    ),
    "endpoint_alert": Source(
        "observed_at",
        ("host", "user_name", "source_system", "event_type", "destination_ip", "action",
         "outcome", "severity", "mitre_technique_id", "message"),
        _endpoint_alert,
    ),
}


def normalize_records(
    records: DataFrame, sources: dict[str, Source] | None = None, strict: bool = True
) -> DataFrame:
    """Records plus their canonical fields; an unknown source fails the job.

    One parse and one cleaning step serve all sources; the projections then only refer to
    the cleaned columns.
    """
    known = sources or SOURCES
    names = sorted({name for source in known.values() for name in source.fields})
    source_name = F.col("source_name")
    time_field = None
    for name, source in known.items():
        at = F.when if time_field is None else time_field.when
        time_field = at(source_name == name, F.col(f"f.`{source.time_field}`"))
    times = {source.time_field for source in known.values()}
    cleaned = (
        records.withColumn("f", top_fields(F.col("payload"), sorted({*names, *times})))
        .select(
            *records.columns,
            time_field.alias("t_text"),
            *(clean(F.col(f"f.`{name}`")).alias(f"c_{name}") for name in names),
        )
    )
    chosen = None
    for name, source in known.items():
        filled = source.project(lambda field: F.col(f"c_{field}"))
        row = F.struct(
            *(
                filled.get(column, F.lit(None)).cast("string").alias(column)
                for column in NORMALIZED_COLUMNS[1:]
            )
        )
        chosen = (F.when if chosen is None else chosen.when)(source_name == name, row)
    unknown = F.raise_error(F.concat(F.lit("Unsupported source: "), _or(source_name, "None")))
    return (
        cleaned.withColumn("n", chosen.otherwise(unknown))
        .select(
            *records.columns,
            iso_timestamp(F.col("t_text"), strict).alias("event_timestamp"),
            "n.*",
        )
    )
