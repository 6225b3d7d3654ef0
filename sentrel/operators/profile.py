"""Schema inspection of uploaded records and the mappings built on it."""

from __future__ import annotations

import json
import re
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions.aliases import SUGGESTED
from sentrel.functions.payload import object_fields, parse
from sentrel.functions.text import canonical_field_name
from sentrel.operators.rules import null_safe_join
from sentrel.schema import TARGET_FIELDS

# Sample limits, transformations, and statuses that allow mapping changes.
SAMPLE_VALUES = 3
SAMPLE_LENGTH = 160
TRANSFORMATIONS = ("direct", "lowercase", "uppercase")
EDITABLE_STATUSES = ("uploaded", "mapping_required", "ready_to_normalize", "failed")

_PLACE = ("dataset_id", "file_name", "record_no")


#: Levels of objects that built-in functions open; records that are nested deeper are walked.
OPENED_LEVELS = 3

#: Characters of records that are walked at once: bounds the Python objects held at a time.
WALKED_AT_ONCE = 1 << 18

# All of a JSON text but its braces outside strings; possessive, so that long strings need no stack.
_NO_BRACES = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^{}"]++'

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"')
_SCALAR = re.compile(r"[^,}\]\s]+")
_LIST_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]]')
_BETWEEN = re.compile(r"[\s,:]*")


def leaf_fields(text: str) -> list[tuple[str, str]]:
    """Dotted path and JSON text of every leaf of an object, given as valid JSON text of any depth."""
    names: list[str] = []
    out, at = [], _BETWEEN.match(text, text.index("{") + 1).end()
    while True:
        if text[at] == "}":
            if not names:
                return out
            names.pop()
            at = _BETWEEN.match(text, at + 1).end()
            continue
        end = _STRING.match(text, at).end()
        name, at = json.loads(text[at:end], strict=False), _BETWEEN.match(text, end).end()
        if text[at] == "{":
            names.append(name)
            at = _BETWEEN.match(text, at + 1).end()
            continue
        end = _value_end(text, at)
        out.append((".".join([*names, name]), text[at:end]))
        at = _BETWEEN.match(text, end).end()


def _value_end(text: str, at: int) -> int:
    if text[at] == '"':
        return _STRING.match(text, at).end()
    if text[at] != "[":
        return _SCALAR.match(text, at).end()
    opened = 0
    for mark in _LIST_MARK.finditer(text, at):
        opened += {"[": 1, "]": -1}.get(mark.group(), 0)
        if not opened:
            return mark.end()
    raise ValueError("an array without an end")


LEAVES = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("json", T.StringType())]))
_ARROW_LEAVES = pa.list_(pa.struct([("key", pa.string()), ("json", pa.string())]))


def _leaves(texts: list[str | None]) -> pa.Array:
    """Leaves of some records, put into flat columns without an object for each leaf."""
    ends, keys, values = [0], [], []
    for text in texts:
        if text is not None:
            for key, value in leaf_fields(text):
                keys.append(key)
                values.append(value)
        ends.append(len(keys))
    found = pa.StructArray.from_arrays(
        [pa.array(keys, pa.string()), pa.array(values, pa.string())], fields=list(_ARROW_LEAVES.value_type)
    )
    missing = pa.array([text is None for text in texts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found, _ARROW_LEAVES, mask=missing)


def _walked(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return pa.nulls(len(texts), _ARROW_LEAVES)
    parts, start, size = [], 0, 0
    for at, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        size += length
        if size >= WALKED_AT_ONCE or at == len(texts):
            parts.append(_leaves(texts[start:at].to_pylist()))
            start, size = at, 0
    return pa.concat_arrays(parts)


def deep_fields(text: Column) -> Column:
    """Leaves of JSON objects nested deeper than built-in functions look; null for null."""
    return F.arrow_udf(_walked, LEAVES)(text)


def _opened(rows: DataFrame, fields: Column) -> DataFrame:
    """Each row's ``fields`` as rows of their own, under longer paths; rows without stay as they are."""
    key = F.col("key")
    return (
        rows.withColumn("fields", fields)
        .where(F.col("fields").isNull() | (F.size("fields") > 0))
        .select(*_PLACE, "path", "value", F.explode_outer("fields").alias("key", "child"))
        .select(
            *_PLACE,
            F.when(key.isNull(), F.col("path")).otherwise(F.concat_ws(".", "path", "key")).alias("path"),
            F.when(key.isNull(), F.col("value")).otherwise(F.col("child")).alias("value"),
        )
    )


def _nested_deeper(text: Column, levels: int) -> Column:
    """Whether a JSON text holds objects in more than ``levels`` levels, those in arrays counted too."""
    braces = F.regexp_replace(text, _NO_BRACES, "")
    for _ in range(levels):
        # Takes the innermost objects away.
        braces = F.replace(braces, F.lit("{}"), F.lit(""))
    many = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit(""))) > levels
    return many & (braces != "")


def flatten_paths(records: DataFrame) -> DataFrame:
    """(dataset_id, file_name, record_no, path, value): leaf fields by dotted path.

    Arrays are leaves and empty objects vanish. One scan and one plan whatever the depth: built-in
    functions open the first levels, and records nested deeper than that are walked, with a
    stack of the walk's own.
    """
    payload, value = F.col("payload"), parse(F.col("payload"))
    deep = _nested_deeper(payload, OPENED_LEVELS) & object_fields(value).isNotNull()
    rows = (
        records.select(*_PLACE, payload, deep_fields(F.when(deep, payload)).alias("leaves"))
        .where(F.col("leaves").isNull() | (F.size("leaves") > 0))
        .select(*_PLACE, payload, F.explode_outer("leaves").alias("leaf"))
        .select(
            *_PLACE, F.col("leaf.key").alias("path"),
            parse(F.coalesce(F.col("leaf.json"), payload)).alias("value"),
        )
    )
    for _ in range(OPENED_LEVELS):
        rows = _opened(rows, object_fields(F.col("value")))
    return rows.where(F.col("path").isNotNull())


def render_sample(value: Column) -> Column:
    """A value as sample text: JSON for lists, ``null`` for null, cut at 160 characters."""
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("null"))
    return F.when(F.length(text) <= SAMPLE_LENGTH, text).otherwise(
        F.concat(F.substring(text, 1, SAMPLE_LENGTH - 3), F.lit("..."))
    )


def _per_file(rows: DataFrame, *keys: str) -> DataFrame:
    """Least ``record_no`` of each key in each file; those without one are ``unnumbered``.

    The buffer is a number, so rows are hashed: least structs would sort every row first.
    """
    return rows.groupBy(*keys, "file_name", F.col("record_no").isNull().alias("unnumbered")).agg(
        F.min("record_no").alias("record_no")
    )


def _first_place(per_file: DataFrame, *keys: str) -> DataFrame:
    return per_file.groupBy(*keys).agg(F.min(F.struct("file_name", "record_no")).alias("seen"))


def first_seen(paths: DataFrame) -> DataFrame:
    """(dataset_id, path, seen): every field with the least file name and record number it occurs at."""
    return _first_place(_per_file(paths, "dataset_id", "path"), "dataset_id", "path")


def field_samples(paths: DataFrame) -> DataFrame:
    """(dataset_id, path, place, sample): up to three distinct samples, first seen first.

    Values are reduced to distinct samples by partial aggregation, and the ranks are group
    limits, so a field present in every record does not gather in one task. A field's first
    samples are among the first of each file.
    """
    distinct = _per_file(
        paths.select(*_PLACE, "path", render_sample(F.col("value")).alias("sample")), "dataset_id", "path", "sample"
    )
    in_file = Window.partitionBy("dataset_id", "path", "file_name", "unnumbered").orderBy("record_no", "sample")
    early = distinct.withColumn("place", F.row_number().over(in_file)).where(F.col("place") <= SAMPLE_VALUES)
    order = Window.partitionBy("dataset_id", "path").orderBy("seen", "sample")
    first = _first_place(early, "dataset_id", "path", "sample")
    return first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_VALUES)


def suggest_target(path: Column) -> Column:
    """struct(target, confidence) suggested by a field name, null if none.

    An exact alias wins. Otherwise targets are tried in order, ignoring case and punctuation:
    the whole path first, then its last part.
    """
    exact = None
    for target, aliases in SUGGESTED.items():
        hit = F.struct(F.lit(target).alias("target"), F.lit("high").alias("confidence"))
        known = path.isin(*aliases)
        exact = F.when(known, hit) if exact is None else exact.when(known, hit)
    whole = canonical_field_name(path)
    leaf = canonical_field_name(F.substring_index(path, ".", -1))
    close = None
    for target, aliases in SUGGESTED.items():
        names = sorted({"".join(c for c in alias.lower() if c.isalnum()) for alias in aliases})
        for known, confidence in (
            (whole.isin(*names), "high"),
            (path.contains(".") & leaf.isin(*names), "medium"),
        ):
            hit = F.struct(
                F.lit(target).alias("target"), F.lit(confidence).alias("confidence")
            )
            close = F.when(known, hit) if close is None else close.when(known, hit)
    return F.coalesce(exact, close)


def suggest_mappings(fields: DataFrame) -> DataFrame:
    """(dataset_id, path, target_field, confidence) with one source per target.

    ``fields`` holds distinct (dataset_id, path, seen). Losing sources keep no suggestion.
    """
    suggested = fields.withColumn("s", suggest_target(F.col("path"))).select(
        "dataset_id", "path", "seen",
        F.col("s.target").alias("target_field"), F.col("s.confidence").alias("confidence"),
    )
    order = Window.partitionBy("dataset_id", "target_field").orderBy(
        F.when(F.col("confidence") == "high", 0).otherwise(1),
        F.when(
            canonical_field_name(F.col("path")) == canonical_field_name(F.col("target_field")), 0
        ).otherwise(1),
        F.lower("path"), "seen", "path",
    )
    wins = F.row_number().over(order) == 1
    return suggested.withColumn("wins", wins).select(
        "dataset_id", "path",
        F.when(F.col("wins"), F.col("target_field")).alias("target_field"),
        F.when(F.col("wins"), F.col("confidence")).alias("confidence"),
    )


def inspect_schema(records: DataFrame) -> DataFrame:
    """Per dataset and field: samples in first-seen order, suggested target, confidence."""
    samples = field_samples(flatten_paths(records))
    fields = samples.groupBy("dataset_id", "path").agg(
        F.min("seen").alias("seen"),
        # At most three samples per field by now.
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "sample"))), lambda item: item["sample"]
        ).alias("sample_values"),
    )
    suggestions = suggest_mappings(fields.select("dataset_id", "path", "seen"))
    return null_safe_join(
        fields.drop("seen"), suggestions, ["dataset_id", "path"], "inner"
    ).orderBy("dataset_id", F.lower("path"), "path")


def readiness(suggestions: DataFrame) -> DataFrame:
    """Status of each dataset: ready once some field is taken for the timestamp."""
    has_time = F.max(F.coalesce(F.col("target_field") == "timestamp", F.lit(False)))
    return suggestions.groupBy("dataset_id").agg(
        F.when(has_time, "ready_to_normalize").otherwise("mapping_required").alias("status")
    )


def audit_mappings(definitions: DataFrame, fields: DataFrame) -> DataFrame:
    """Definitions (ordered by ``ordinal``) cleaned, each with the reason it is refused.

    Checks run in a fixed order and the first failure names the reason. ``blocks`` marks the
    definition a dataset's whole set is refused for.
    """
    cleaned = definitions.select(
        "dataset_id", "ordinal",
        F.trim("source_field").alias("source_field"),
        F.trim("target_field").alias("target_field"),
        F.coalesce(F.nullif(F.lower(F.trim("transformation_type")), F.lit("")), F.lit("direct"))
        .alias("transformation_type"),
        "default_value",
    )
    known = fields.select(
        "dataset_id", F.col("path").alias("source_field"), F.lit(True).alias("known")
    ).distinct()
    rows = null_safe_join(cleaned, known, ["dataset_id", "source_field"], "left")

    def repeated(column: str) -> Column:
        seen = Window.partitionBy("dataset_id", column).orderBy("ordinal")
        return F.row_number().over(seen) > 1

    rows = rows.withColumn("again_source", repeated("source_field")).withColumn(
        "again_target", repeated("target_field")
    )
    source, target, kind = (
        F.col("source_field"), F.col("target_field"), F.col("transformation_type"),
    )
    reason = (
        F.when(source == "", F.lit("source_field cannot be empty"))
        .when(F.col("known").isNull(), F.concat(F.lit("Unknown source field: "), source))
        .when(~target.isin(*TARGET_FIELDS), F.concat(F.lit("Invalid target field: "), target))
        .when(
            ~kind.isin(*TRANSFORMATIONS),
            F.concat(F.lit("Invalid transformation_type: "), kind),
        )
        .when(F.col("again_source"), F.concat(F.lit("Duplicate source field mapping: "), source))
        .when(F.col("again_target"), F.concat(F.lit("Duplicate target field mapping: "), target))
    )
    rows = rows.withColumn("reason", reason).drop("known", "again_source", "again_target")
    in_order = Window.partitionBy("dataset_id").orderBy("ordinal").rowsBetween(
        Window.unboundedPreceding, -1
    )
    failed_before = F.coalesce(F.count("reason").over(in_order), F.lit(0)) > 0
    return rows.withColumn("blocks", F.col("reason").isNotNull() & ~failed_before)


def wanted_definitions(inputs: DataFrame) -> DataFrame:
    """Inputs that name a target; rows left unmapped are dropped."""
    return inputs.where(F.trim(F.coalesce("target_field", F.lit(""))) != "")


def dataset_mappings(mappings: DataFrame, dataset_id: int) -> DataFrame:
    return mappings.where(F.col("dataset_id") == dataset_id).orderBy("source_field")


def replace_mappings(
    stored: DataFrame,
    datasets: DataFrame,
    fresh: DataFrame,
    suggestions: DataFrame,
    replaced: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New mapping and dataset tables after replacing the sets of some datasets.

    ``replaced`` lists their ids; by default those that occur in ``fresh``. One listed without
    fresh mappings loses all it had. Only datasets in an editable status change; locked ones
    keep their mappings.
    """
    editable = datasets.where(F.col("status").isin(*EDITABLE_STATUSES)).select("dataset_id")
    wanted = (fresh if replaced is None else replaced).select("dataset_id").distinct()
    touched = wanted.join(editable, "dataset_id", "left_semi")
    accepted = fresh.join(touched, "dataset_id", "left_semi")
    mappings = stored.join(touched, "dataset_id", "left_anti").unionByName(
        accepted.select(*stored.columns)
    )
    timed = reduce(
        DataFrame.unionByName,
        (
            df.where(F.col("target_field") == "timestamp").select("dataset_id")
            for df in (accepted, suggestions)
        ),
    ).distinct().withColumn("timed", F.lit(True))
    marked = touched.withColumn("touched", F.lit(True))
    updated = (
        datasets.join(marked, "dataset_id", "left")
        .join(timed, "dataset_id", "left")
        .withColumn(
            "status",
            F.when(F.col("touched").isNull(), F.col("status"))
            .when(F.col("timed"), F.lit("ready_to_normalize"))
            .otherwise(F.lit("mapping_required")),
        )
        .select(*datasets.columns)
    )
    return mappings, updated
