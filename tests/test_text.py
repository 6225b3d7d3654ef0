from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sentrel.functions import text
from sentrel.operators.profile import suggest_target


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("2026-06-16T08:10:12Z", datetime(2026, 6, 16, 8, 10, 12)),
        ("2026-06-16 08:10:12", datetime(2026, 6, 16, 8, 10, 12)),
        ("2026-06-16T08:10:12.5+02:00", datetime(2026, 6, 16, 6, 10, 12, 500000)),
        ("2026-06-16T08:10:12.123456789Z", datetime(2026, 6, 16, 8, 10, 12, 123456)),
        ("2026-06-16T08:10:12,25-0130", datetime(2026, 6, 16, 9, 40, 12, 250000)),
        ("2026-06-16", datetime(2026, 6, 16)),
        ("20260616", datetime(2026, 6, 16)),
        ("20260616T081012Z", datetime(2026, 6, 16, 8, 10, 12)),
        ("2026-06-16x08:10", datetime(2026, 6, 16, 8, 10)),
        ("20260616T08", datetime(2026, 6, 16, 8)),
        ("2026-06-16T08:10:12+02", datetime(2026, 6, 16, 6, 10, 12)),
        ("2026", None), ("2026-06", None), (" 2026-06-16 ", None), ("08:10", None), ("", None),
        ("not-a-time", None), ("2026-13-01", None), ("2026-06-16T25:00", None), ("2026-06-16T", None),
        ("2026-06-16T08:10.5", None), ("1718000000", None), (None, None),
    ],
)
def test_iso_timestamps(spark, value, expected):
    assert one(spark, value, text.safe_timestamp) == expected


@pytest.mark.parametrize(
    "value,expected",
    [("  a b ", "a b"), ("\t\n", None), ("", None), (None, None), (" x ", "x"), ("a\n b", "a\n b"), ("x", "x")],
)
def test_clean(spark, value, expected):
    assert one(spark, value, text.clean) == expected


def test_small_expressions(spark):
    assert one(spark, "Client.IP-Address_1", text.canonical_field_name) == "clientipaddress1"
    assert one(spark, "CRITICAL", text.severity_rank) == 4
    assert one(spark, None, text.severity_rank) == 0
    assert one(spark, "Odd", text.severity_class) == "unknown"
    assert one(spark, "", text.display) == "Not set"
    stamp = lambda fn: lambda c: fn(c.cast("timestamp"))
    assert one(spark, "2026-06-05 14:03:02.5", stamp(text.utc_text)) == "2026-06-05 14:03:02 UTC"
    assert one(spark, None, stamp(text.utc_text)) == "Not set"
    assert one(spark, "2026-06-05 14:03:02.5", stamp(text.iso_text)) == "2026-06-05T14:03:02.500000+00:00"
    assert one(spark, "2026-06-05 14:03:02", stamp(text.short_date)) == "Jun 05, 02:03 PM UTC"
    assert one(spark, "soon", text.utc_text_from_string) == "soon"
    assert one(spark, "2026-06-05T14:03:02Z", text.utc_text_from_string) == "2026-06-05 14:03:02 UTC"


@pytest.mark.parametrize(
    "path,target,confidence",
    [
        ("published", "timestamp", "high"), ("client.ipAddress", "source_ip", "high"),
        ("eventName", "action", "high"), ("event_name", "event_type", "high"),
        ("Event-Time", "timestamp", "high"), ("device.user_name", "username", "medium"),
        ("status.code", "outcome", "high"), ("status.errorCode", "outcome", "high"),
        # An earlier target's partial match beats a later target's full one.
        ("x.time", "timestamp", "medium"), ("favourite_colour", None, None),
    ],
)
def test_target_suggestions(spark, path, target, confidence):
    found = one(spark, path, suggest_target)
    assert (tuple(found) if found else (None, None)) == (target, confidence)


def test_cells_before_the_epoch(spark):
    row = spark.sql("SELECT bigint(-1) AS a, bigint(0) AS b, bigint(900000000) AS c").select(
        *(text.floor_cell(F.col(name), 900_000_000).alias(name) for name in "abc")
    ).first()
    assert tuple(row) == (-1, 0, 1)
