"""Column layouts shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# The canonical target fields, in mapping order; only the first is required.
TARGET_FIELDS = (
    "timestamp",
    "source_system",
    "event_type",
    "username",
    "source_ip",
    "destination_ip",
    "asset",
    "action",
    "outcome",
    "severity",
    "mitre_technique_id",
    "message",
)
REQUIRED_TARGET_FIELDS = ("timestamp",)

NORMALIZED_COLUMNS = (
    "event_timestamp",
    "source_system",
    "event_type",
    "username",
    "source_ip",
    "destination_ip",
    "asset",
    "action",
    "outcome",
    "severity",
    "mitre_technique_id",
    "normalized_message",
)

# One source record: where it came from and its payload as JSON text.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.LongType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("record_no", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("dataset_id", T.LongType()),
        T.StructField("event_timestamp", T.TimestampType()),
    ]
    + [T.StructField(name, T.StringType()) for name in NORMALIZED_COLUMNS[1:]]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.LongType()),
        T.StructField("alert_id", T.StringType()),
        T.StructField("rule_no", T.IntegerType()),
        T.StructField("alert_rule_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("related_username", T.StringType()),
        T.StructField("related_asset", T.StringType()),
        T.StructField("mitre_technique_id", T.StringType()),
        T.StructField("normalized_event_id", T.LongType()),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
        # Evidence is kept by reference: a lead event plus, for windowed rules, the window
        # of pool events it stands for. See operators/evidence.py.
        T.StructField("evidence_count", T.LongType()),
        T.StructField("lead_event_id", T.LongType()),
        T.StructField("evidence_ip", T.StringType()),
        T.StructField("window_from", T.TimestampType()),
        T.StructField("window_to", T.TimestampType()),
        # Order inside one rule: the event the rule was anchored on.
        T.StructField("anchor_ts", T.TimestampType()),
        T.StructField("anchor_id", T.LongType()),
    ]
)
ALERT_COLUMNS = tuple(ALERT_SCHEMA.fieldNames())

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_id", T.StringType()),
        T.StructField("dataset_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("suspected_attack_path", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("affected_user", T.StringType()),
        T.StructField("affected_assets", T.ArrayType(T.StringType())),
        T.StructField("first_seen", T.TimestampType()),
        T.StructField("last_seen", T.TimestampType()),
        T.StructField("alert_count", T.LongType()),
    ]
)

INCIDENT_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_id", T.StringType()),
        T.StructField("dataset_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
)

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.LongType()),
        T.StructField("source_field", T.StringType()),
        T.StructField("target_field", T.StringType()),
        T.StructField("transformation_type", T.StringType()),
        T.StructField("default_value", T.StringType()),
    ]
)

DATASET_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("record_count", T.LongType()),
    ]
)
