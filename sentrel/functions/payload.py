"""Reading fields out of source records, which are held as JSON text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions.text import blank_to_null


def parse(payload: Column) -> Column:
    """JSON text to VARIANT; text that is no JSON becomes null."""
    return F.try_parse_json(payload)


def canonical_json(payload: Column) -> Column:
    """JSON text that is equal for equal payloads, whatever their key order."""
    return F.to_json(parse(payload))


def object_fields(value: Column) -> Column:
    """Fields of an object as a map; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def top_fields(payload: Column, names: Iterable[str]) -> Column:
    """The named top-level fields as a struct of text, in one parse.

    Objects and arrays come as JSON text, JSON null and missing fields as null.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return F.from_json(payload, schema)


def first_value(value: Callable[[str], Column], names: tuple[str, ...]) -> Column:
    """First alias that is present and not the empty string. Whitespace counts as a value."""
    return F.coalesce(*(blank_to_null(value(name)) for name in names))


def variant_paths(path: Column) -> tuple[Column, Column]:
    """VARIANT paths of a dotted name: as one key, and as nested keys."""
    quote = F.when(path.contains("'"), F.lit('"')).otherwise(F.lit("'"))
    nested = F.replace(path, F.lit("."), F.concat(quote, F.lit("]["), quote))
    opening, closing = F.concat(F.lit("$["), quote), F.concat(quote, F.lit("]"))
    return F.concat(opening, path, closing), F.concat(opening, nested, closing)


def dotted(value: Column, whole_path: Column, nested_path: Column) -> Column:
    """Field at a dotted name; a key that contains the dots wins over nested keys."""
    return F.coalesce(
        F.try_variant_get(value, whole_path, "string"),
        F.when(
            F.try_variant_get(value, whole_path, "variant").isNull(),
            F.try_variant_get(value, nested_path, "string"),
        ),
    )
