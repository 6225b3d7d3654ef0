"""Text, severity and timestamp expressions; everything stays on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity order, lowest to highest; any other text ranks 0.
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}

NOT_SET = "Not set"

# The characters that count as whitespace.
_SPACES = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)

# The usual form, which Spark casts as it stands.
_PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})$"

# ISO 8601 calendar dates in extended or basic form, any one-character separator, optional
# time, fraction and offset. Week dates are not accepted.
_ISO = (
    r"^(?:\d{4}-\d{2}-\d{2}|\d{8})"
    r"(?:.(?:\d{2}(?::\d{2})?|\d{4}|(?:\d{2}:\d{2}:\d{2}|\d{6})(?:[.,]\d+)?)"
    r"(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
_ISO_PARTS = (
    r"^(\d{4})-?(\d{2})-?(\d{2})(?:.(\d{2}):?(\d{2})?:?(\d{2})?(?:[.,](\d+))?"
    r"(Z|[+-]\d{2}:?(?:\d{2})?)?)?$"
)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def clean(value: Column) -> Column:
    """Strip surrounding whitespace; blank becomes null."""
    return blank_to_null(F.btrim(value, F.lit(_SPACES)))


def lower_clean(value: Column) -> Column:
    return F.lower(clean(value))


def display(value: Column) -> Column:
    return F.coalesce(blank_to_null(value.cast("string")), F.lit(NOT_SET))


def none_text(value: Column) -> Column:
    """A missing value inside a sentence reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def canonical_field_name(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), "[^a-z0-9]", "")


def severity_rank(value: Column) -> Column:
    lowered = F.lower(value)
    rank = F.lit(0)
    for name, score in SEVERITY_RANK.items():
        rank = F.when(lowered == name, F.lit(score)).otherwise(rank)
    return rank


def severity_class(value: Column) -> Column:
    lowered = F.lower(value)
    return F.when(lowered.isin(*SEVERITY_RANK), lowered).otherwise(F.lit("unknown"))


def utc_text(value: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS UTC`` for a timestamp, ``Not set`` for null."""
    formatted = F.concat(F.date_format(value, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    return F.coalesce(formatted, F.lit(NOT_SET))


def utc_text_from_string(value: Column) -> Column:
    """Like :func:`utc_text` for text input; text that is no timestamp passes through."""
    parsed = safe_timestamp(value)
    return F.when(blank_to_null(value).isNull(), F.lit(NOT_SET)).otherwise(
        F.when(parsed.isNull(), value).otherwise(utc_text(parsed))
    )


def short_date(value: Column) -> Column:
    """Dashboard date: ``Jan 05, 02:10 PM UTC``."""
    formatted = F.concat(F.date_format(value, "MMM dd, hh:mm a"), F.lit(" UTC"))
    return F.coalesce(formatted, F.lit(NOT_SET))


def iso_text(value: Column) -> Column:
    """ISO text with offset; the fraction is printed only where there is one."""
    micros = F.pmod(F.unix_micros(value), F.lit(1_000_000))
    seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(seconds, fraction, F.lit("+00:00"))


def safe_timestamp(value: Column) -> Column:
    """ISO text to timestamp, null when it is not one; a missing offset means UTC.

    Pass a plain column: the text is tested before it is read.
    """
    spread = F.regexp_replace(value, _ISO_PARTS, "$1-$2-$3T$4:$5:$6.$7|$8")
    filled = F.regexp_replace(spread, r"(?<=[T:])(?=[:.])", "00")
    with_fraction = F.regexp_replace(filled, r"\.\|", ".0|")
    utc = F.regexp_replace(with_fraction, r"\|Z?$", "+00:00")
    offset = F.regexp_replace(utc, r"\|([+-]\d{2}):?(\d{2})?$", "$1:$2")
    rebuilt = F.regexp_replace(offset, r":$", ":00")
    text = F.when(value.rlike(_PLAIN_ISO), value).when(value.rlike(_ISO), rebuilt)
    return text.try_cast("timestamp")


def floor_cell(micros: Column, width_us: int) -> Column:
    """Number of the fixed-width time cell a microsecond instant falls in."""
    width = F.lit(width_us).cast("bigint")
    return ((micros - F.pmod(micros, width)) / width).cast("bigint")
