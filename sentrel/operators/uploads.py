"""Normalization of uploaded records: automatic aliases, overridden by confirmed mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.aliases import AUTOMATIC, SOURCE_SYSTEM_DEFAULTS
from sentrel.functions.payload import dotted, first_value, parse, top_fields, variant_paths
from sentrel.functions.text import blank_to_null, clean, lower_clean, safe_timestamp
from sentrel.operators.rules import null_safe_join
from sentrel.schema import NORMALIZED_COLUMNS, TARGET_FIELDS
from sentrel.session import materialize

# Accepted source types and the largest preview.
SOURCE_TYPES = ("auth", "vpn", "cloud", "api", "endpoint", "generic")
LARGEST_PREVIEW = 10

# Target fields and the canonical columns that hold them.
_COLUMN_OF = dict(zip(TARGET_FIELDS, NORMALIZED_COLUMNS))


def clean_source_type(value: Column) -> Column:
    return F.coalesce(lower_clean(value), F.lit("generic"))


def check_source_types(datasets: DataFrame) -> DataFrame:
    """Datasets with their source type cleaned; an unknown type fails the job."""
    cleaned = F.lower(F.trim("source_type"))
    allowed = ", ".join(sorted(SOURCE_TYPES))
    message = F.concat(
        F.lit("Unsupported source_type '"), F.col("source_type"),
        F.lit(f"'. Use one of: {allowed}."),
    )
    return datasets.withColumn(
        "source_type", F.when(cleaned.isin(*SOURCE_TYPES), cleaned).otherwise(F.raise_error(message))
    )


def _default_system(source_type: Column) -> Column:
    chosen = F.lit(SOURCE_SYSTEM_DEFAULTS["generic"])
    for name, system in SOURCE_SYSTEM_DEFAULTS.items():
        chosen = F.when(source_type == name, F.lit(system)).otherwise(chosen)
    return chosen


def _automatic(records: DataFrame) -> DataFrame:
    """Records plus canonical fields found by alias, as ``auto_*`` columns.

    Built in steps so that each alias list is searched once: raw values, then cleaned ones,
    then the fields inferred from them.
    """
    kept = records.columns
    names = sorted({alias for aliases in AUTOMATIC.values() for alias in aliases})
    raw = records.withColumn("f", top_fields(F.col("payload"), names)).select(
        *kept,
        clean_source_type(F.col("source_type")).alias("kind"),
        *(
            first_value(lambda name: F.col(f"f.`{name}`"), aliases).alias(f"raw_{target}")
            for target, aliases in AUTOMATIC.items()
        ),
    )
    texts = [target for target in AUTOMATIC if target != "timestamp"]
    cleaned = raw.select(
        *kept, "kind", "raw_timestamp",
        *(clean(F.col(f"raw_{target}")).alias(target) for target in texts),
    )
    kind, path = F.col("kind"), F.col("path")
    acted = cleaned.withColumn(
        "action",
        F.when(
            F.col("http_method").isNotNull() & path.isNotNull(),
            F.concat_ws(" ", "http_method", "path"),
        ).otherwise(F.col("action")),
    ).withColumn("request", F.lower(F.concat_ws(" ", "action", "path")))
    action, asset = F.col("action"), F.col("asset")
    exports = F.col("request").contains("export") | F.col("request").contains("download")
    inferred_type = (
        F.when(kind == "auth", F.lit("interactive_login"))
        .when((kind == "vpn") & action.isNotNull(), F.concat(F.lit("vpn_"), action))
        .when((kind == "cloud") & action.isNotNull(), action)
        .when(kind == "api", F.when(exports, F.lit("bulk_export")).otherwise(F.lit("api_access")))
        .when(kind == "endpoint", F.lit("endpoint_event"))
        .otherwise(F.lit("uploaded_event"))
    )
    typed = acted.withColumn("event_type", F.coalesce("event_type", inferred_type))
    of_service = F.when(kind == "cloud", F.concat(F.lit("cloud_"), F.col("service")))
    message = F.coalesce(
        "message",
        F.concat_ws(
            " ",
            F.coalesce("username", F.lit("unknown user")),
            F.coalesce("action", "event_type"),
            F.concat(F.lit("on "), asset),
        ),
    )
    found = {
        "event_timestamp": safe_timestamp(F.col("raw_timestamp")),
        "source_system": F.coalesce("source_system", of_service, _default_system(kind)),
        "severity": F.lower("severity"),
        "normalized_message": message,
    }
    return typed.select(
        *kept, "kind",
        *(
            found.get(column, F.col(column)).alias(f"auto_{column}")
            for column in NORMALIZED_COLUMNS
        ),
    )


def mapping_rules(mappings: DataFrame) -> DataFrame:
    """One row per dataset: for every target its rule, field name already made a path."""
    whole, nested = variant_paths(F.col("source_field"))
    rule = F.struct(
        whole.alias("whole"), nested.alias("nested"), "transformation_type", "default_value"
    )
    return mappings.groupBy("dataset_id").agg(
        *(
            F.max(F.when(F.col("target_field") == target, rule)).alias(f"rule_{target}")
            for target in TARGET_FIELDS
        )
    )


def normalize_uploads(records: DataFrame, mappings: DataFrame | None = None) -> DataFrame:
    """Records (with ``source_type``) plus canonical fields.

    A confirmed rule takes its field, else its default, then its transformation. It replaces
    the automatic value even when it yields nothing; only the source system and event type
    then fall back to their defaults. The rules are one row per dataset and written first, so
    that Spark knows their size before it decides how to join them: records are not dealt by
    dataset for rules that fit every task.
    """
    rows = _automatic(records)
    if mappings is None:
        return rows.select(
            *records.columns,
            *(F.col(f"auto_{column}").alias(column) for column in NORMALIZED_COLUMNS),
        )
    rules = materialize(mapping_rules(mappings), "mapping-rules")
    rows = null_safe_join(rows, rules, ["dataset_id"], "left").withColumn("p", parse(F.col("payload")))
    carried = [name for name in rows.columns if name != "p"]
    rows = rows.select(
        *carried,
        *(
            dotted(F.col("p"), F.col(f"rule_{t}.whole"), F.col(f"rule_{t}.nested"))
            .alias(f"found_{t}")
            for t in TARGET_FIELDS
        ),
    )
    rows = rows.select(
        *carried,
        *(
            F.coalesce(blank_to_null(F.col(f"found_{t}")), F.col(f"rule_{t}.default_value"))
            .alias(f"value_{t}")
            for t in TARGET_FIELDS
        ),
    )

    def transformed(target: str) -> Column:
        kind, value = F.col(f"rule_{target}.transformation_type"), F.col(f"value_{target}")
        return (
            F.when(kind == "lowercase", F.lower(value))
            .when(kind == "uppercase", F.upper(value))
            .otherwise(value)
        )

    rows = rows.select(
        *carried, *(transformed(t).alias(f"mapped_{t}") for t in TARGET_FIELDS)
    )
    fields = []
    for target, column in _COLUMN_OF.items():
        rule, automatic = f"rule_{target}", F.col(f"auto_{column}")
        value = F.col(f"mapped_{target}")
        if target == "timestamp":
            value = safe_timestamp(value)
        elif target == "severity":
            value = F.lower(clean(value))
        else:
            value = clean(value)
        chosen = F.when(F.col(rule).isNull(), automatic).otherwise(value)
        if target == "source_system":
            chosen = F.coalesce(chosen, _default_system(F.col("kind")))
        elif target == "event_type":
            chosen = F.coalesce(chosen, F.lit("uploaded_event"))
        fields.append(chosen.alias(column))
    return rows.select(*records.columns, *fields)


def timestamp_rejects(normalized: DataFrame) -> DataFrame:
    """Records that cannot be loaded because they have no valid time, with the reason."""
    reason = F.concat(
        F.lit("A valid timestamp is required for every normalized record. File '"),
        F.col("file_name"), F.lit("', record "), F.col("record_no").cast("string"),
        F.lit(" did not produce one. Review the dataset field mapping first."),
    )
    return normalized.where(F.col("event_timestamp").isNull()).select(
        "dataset_id", "file_name", "record_no", reason.alias("reason")
    )


def timestamp_gate(normalized: DataFrame, strict: bool = False) -> DataFrame:
    """Records that may be loaded. Strict: one record without a time fails the whole run."""
    if not strict:
        return normalized.where(F.col("event_timestamp").isNotNull())
    reason = F.concat(
        F.lit("No valid timestamp in file '"), F.col("file_name"), F.lit("', record "),
        F.col("record_no").cast("string"),
    )
    return normalized.withColumn(
        "event_timestamp",
        F.coalesce("event_timestamp", F.raise_error(reason).cast("timestamp")),
    )


def first_records(records: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` records of each dataset, numbered across its files."""
    order = Window.partitionBy("dataset_id").orderBy("file_name", "record_no")
    return records.withColumn("scan_no", F.row_number().over(order)).where(
        F.col("scan_no") <= limit
    )


def preview(records: DataFrame, mappings: DataFrame | None, limit: int = LARGEST_PREVIEW) -> DataFrame:
    """First normalized records of each dataset with a warning per unloadable one."""
    bounded = max(1, min(limit, LARGEST_PREVIEW))
    normalized = normalize_uploads(first_records(records, bounded), mappings)
    warning = F.concat(
        F.lit("Record "), F.col("scan_no").cast("string"),
        F.lit(
            " has no valid timestamp and cannot be normalized until its mapping is corrected."
        ),
    )
    return normalized.withColumn(
        "warning", F.when(F.col("event_timestamp").isNull(), warning)
    )
