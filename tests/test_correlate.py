from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from oracles import base
from sentrel.operators import correlate, evidence, rules
from sentrel.schema import ALERT_SCHEMA
from sentrel.session import materialize
from tests import brute
from tests.fixtures import START, event, failure, frame, minutes, random_events, serious

ALL = (base.ALERTS, base.EVIDENCE, base.ASSIGNED, base.INCIDENTS)


def alert(number: int, at, **fields):
    values = {name: None for name in ALERT_SCHEMA.fieldNames()}
    values.update(
        alert_id=f"2-{number}-1", rule_no=2, alert_rule_name="rule two", severity="high",
        description="d", related_username="kim", normalized_event_id=number, first_seen=at,
        last_seen=at, evidence_count=1, lead_event_id=number, anchor_ts=at, anchor_id=number,
    )
    values.update(fields)
    return tuple(values[name] for name in ALERT_SCHEMA.fieldNames())


def alerts(spark, *rows):
    return spark.createDataFrame(list(rows), ALERT_SCHEMA)


def groups(assigned):
    found = {}
    for row in assigned.collect():
        found.setdefault(row["incident_id"], set()).add(row["lead_event_id"])
    return sorted(found.values(), key=min)


def test_same_user_is_one_incident_with_sorted_assets(spark):
    rows = alerts(
        spark, alert(1, minutes(0), related_asset="B"), alert(2, minutes(5), related_asset="A", severity="critical"),
        alert(3, minutes(9), related_asset="B", alert_rule_name="rule three", rule_no=3, severity="medium"),
    )
    [incident] = correlate.build_incidents(correlate.assign_incidents(rows)).collect()
    assert incident["affected_assets"] == ["A", "B"]
    assert incident["title"] == "Critical security incident for kim"
    assert incident["description"] == "Correlated 3 alerts involving kim and A, B."
    assert incident["suspected_attack_path"] == "rule two -> rule three"
    assert incident["status"] == "open"


def test_users_and_quiet_days_separate_incidents(spark):
    day = timedelta(hours=24)
    rows = alerts(
        spark, alert(1, START), alert(2, START + day), alert(3, START + 2 * day + timedelta(microseconds=1)),
        alert(4, START, related_username="lee"), alert(5, START, dataset_id=1),
    )
    assert groups(correlate.assign_incidents(rows)) == [{1, 2}, {3}, {4}, {5}]


def test_long_alert_keeps_its_incident_open(spark):
    rows = alerts(
        spark, alert(1, START, last_seen=START + timedelta(hours=60)), alert(2, START + timedelta(hours=30)),
        alert(3, START + timedelta(hours=80)),
    )
    assert groups(correlate.assign_incidents(rows)) == [{1, 2, 3}]


def test_without_user_the_asset_groups_and_a_bare_alert_stays_alone(spark):
    rows = alerts(
        spark, alert(1, minutes(0), related_username=None, related_asset="A"),
        alert(2, minutes(1), related_username="", related_asset="A"),
        alert(3, minutes(2), related_username=None, related_asset="B"),
        alert(4, minutes(3), related_username=None), alert(5, minutes(4), related_username=None),
        alert(6, minutes(5), related_asset="A"),
    )
    assert groups(correlate.assign_incidents(rows)) == [{1, 2}, {3}, {4}, {5}, {6}]
    built = {row["description"] for row in correlate.build_incidents(correlate.assign_incidents(rows)).collect()}
    assert "Correlated 2 alerts involving an unknown user and A." in built
    assert "Correlated 1 alerts involving an unknown user and unknown assets." in built


def test_alerts_without_times_use_the_run_time(spark):
    rows = alerts(
        spark, alert(1, None), alert(2, START + timedelta(hours=20)), alert(3, START + timedelta(hours=50)),
    )
    at = F.lit(START + timedelta(hours=40))
    assert groups(correlate.assign_incidents(rows, at)) == [{1, 2, 3}]


def test_shared_login_evidence_ties_assets(spark):
    """Two user-less successes on different assets share failures, so they share an incident."""
    rows = [failure(i, minutes(i), username=None, asset=None) for i in range(1, 4)]
    rows += [event(4, minutes(5), username=None, asset="A"), event(5, minutes(6), username=None, asset="B"),
             event(6, minutes(40), username=None, asset="B"), event(7, minutes(7), username=None, asset=None)]
    events = frame(spark, rows)
    found = materialize(rules.detect(events), "alerts")
    assigned = correlate.assign_incidents(found)
    expected = brute.run(rows, ALL, "SELECT alert_id, incident_id FROM assigned")
    assert brute.spark_set(assigned.select("alert_id", "incident_id")) == expected


@pytest.mark.parametrize("seed,days", [(0, 3), (1, 8), (2, 30), (3, 60)])
def test_random_alerts_match_the_literal_first_fit(spark, seed, days):
    rows = random_events(100 + seed, 450, days)
    events = frame(spark, rows)
    found = materialize(rules.detect(events), "alerts")
    assigned = materialize(correlate.assign_incidents(found), "assigned")
    # Some brute-force alerts without a user must share failures across assets.
    assert found.where("rule_no = 1 AND related_username IS NULL").select("related_asset").distinct().count() > 2
    expected = brute.run(rows, ALL, "SELECT dataset_id, alert_id, incident_id FROM assigned")
    assert brute.spark_set(assigned.select("dataset_id", "alert_id", "incident_id")) == expected
    links = evidence.incident_events(assigned, events)
    assert brute.spark_set(links.select("incident_id", "event_id")) == brute.run(
        rows, ALL, "SELECT incident_id, event_id FROM incident_events"
    )
    built = correlate.build_incidents(assigned).select(
        "incident_id", "severity", "title", "suspected_attack_path", "description", "affected_user", "alert_count"
    )
    assert brute.spark_set(built) == brute.run(
        rows, ALL,
        "SELECT incident_id, severity, title, suspected_attack_path, description, affected_user, alert_count FROM incidents",
    )


def test_links_of_other_scopes_are_dropped(spark):
    events = frame(spark, [serious(1, minutes(0), dataset_id=1), serious(2, minutes(0), dataset_id=2)])
    links = spark.createDataFrame([("i", 1), ("i", 2)], "incident_id string, event_id bigint")
    incidents = spark.createDataFrame([("i", 1)], "incident_id string, dataset_id bigint")
    assert [row["event_id"] for row in evidence.scoped_links(links, incidents, events).collect()] == [1]


def test_free_alerts(spark):
    rows = alerts(
        spark, alert(1, START), alert(2, START), alert(3, START, dataset_id=1), alert(4, START, dataset_id=1),
        alert(5, START, dataset_id=1), alert(6, START, dataset_id=1),
    )
    homes = spark.createDataFrame(
        [(2, "s"), (4, "own"), (5, "none"), (6, "other")], "lead_event_id bigint, incident_id string"
    )
    incidents = spark.createDataFrame(
        [("s", None), ("own", 1), ("none", None), ("other", 2)], "incident_id string, dataset_id bigint"
    )
    free = correlate.unassigned_alerts(rows.join(homes, "lead_event_id", "left"), incidents)
    assert {row["lead_event_id"] for row in free.collect()} == {1, 3, 5, 6}
