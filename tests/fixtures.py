"""Small hand-made and random inputs for the tests."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from sentrel.schema import EVENT_SCHEMA

START = datetime(2026, 3, 2, 8, 0, tzinfo=timezone.utc)


def minutes(value: float) -> datetime:
    return START + timedelta(minutes=value)


def event(event_id: int, at: datetime | None, **fields) -> tuple:
    values = {
        "event_id": event_id, "dataset_id": None, "event_timestamp": at,
        "source_system": "CLOUD-IAM", "event_type": "interactive_login", "username": "kim",
        "source_ip": "203.0.113.9", "destination_ip": None, "asset": "IAM", "action": "login",
        "outcome": "success", "severity": None, "mitre_technique_id": None,
        "normalized_message": None,
    }
    values.update(fields)
    return tuple(values[name] for name in EVENT_SCHEMA.fieldNames())


def failure(event_id: int, at, **fields) -> tuple:
    return event(event_id, at, outcome="failure", **fields)


def connect(event_id: int, at, **fields) -> tuple:
    return event(
        event_id, at,
        **{"source_system": "vpn", "event_type": "vpn_connect", "action": "connect",
           "asset": "LAPTOP-KIM", **fields},
    )


def privilege(event_id: int, at, **fields) -> tuple:
    return event(
        event_id, at,
        **{"source_system": "cloud_identity", "event_type": "AttachUserPolicy",
           "action": "AttachUserPolicy", "asset": "CLOUD", **fields},
    )


def serious(event_id: int, at, **fields) -> tuple:
    return event(
        event_id, at,
        **{"source_system": "endpoint-edr", "event_type": "archive_created", "action": "alert",
           "severity": "high", "asset": "LAPTOP-KIM", **fields},
    )


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def random_events(seed: int, size: int, days: float, step_minutes: int = 5) -> list[tuple]:
    """Dense events on a coarse time grid: ties, exact window bounds, missing users and assets."""
    rng = random.Random(seed)
    slots = int(days * 24 * 60 / step_minutes)
    # Activity comes in clusters so that the short windows fill up.
    centres = [rng.randrange(slots) for _ in range(max(2, size // 25))]
    rows = []
    for event_id in range(1, size + 1):
        slot = max(0, rng.choice(centres) + rng.randrange(-4, 5))
        at = START + timedelta(minutes=slot * step_minutes)
        fields = dict(
            dataset_id=rng.choice([None, None, None, 1]),
            username=rng.choice([None, None, None, "kim", "lee"]),
            source_ip=rng.choice(["203.0.113.9"] * 4 + ["198.51.100.24"]),
            asset=rng.choice([None, "A", "B", "C", "D", "E"]),
            severity=rng.choice([None, "low", "High", "critical"]),
        )
        kind = rng.randrange(9)
        if kind < 4:
            rows.append(failure(event_id, at, **fields))
        elif kind < 6:
            rows.append(event(event_id, at, **fields))
        elif kind == 6:
            rows.append(connect(event_id, at, **fields))
        elif kind == 7:
            rows.append(privilege(event_id, at, **fields))
        elif rng.random() < 0.5:
            rows.append(serious(event_id, at, event_type="credential_access", **{**fields, "severity": "medium"}))
        else:
            rows.append(
                event(event_id, at, **{**fields, "source_system": "api_gateway", "event_type": "bulk_export",
                                       "action": "GET /x", "outcome": "200"})
            )
    return rows
