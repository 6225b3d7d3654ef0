from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from oracles import base
from sentrel.operators import evidence, rules
from tests import brute
from tests.fixtures import (
    connect, event, failure, frame, minutes, privilege, random_events, serious,
)

COLS = (
    "dataset_id, alert_id, severity, description, related_username, related_asset, mitre_technique_id, "
    "normalized_event_id, first_us, last_us, evidence_count"
)


def flat(df):
    return df.withColumn("first_us", F.unix_micros("first_seen")).withColumn(
        "last_us", F.unix_micros("last_seen")
    ).select(*(name.strip() for name in COLS.split(",")))


def ids(alerts, events):
    links = evidence.alert_evidence(alerts, events).collect()
    found = {}
    for link in links:
        found.setdefault(link["alert_id"], set()).add(link["event_id"])
    return found


def test_brute_force_needs_three_failures_before_the_success(spark):
    events = frame(
        spark,
        [failure(1, minutes(0)), failure(2, minutes(1)), failure(3, minutes(2)), event(4, minutes(4)),
         event(5, minutes(4), username="lee"), failure(6, minutes(5))],
    )
    [alert] = rules.brute_force(events).collect()
    assert alert["description"] == (
        "kim had 3 failed logins followed by a successful login from 203.0.113.9."
    )
    assert (alert["severity"], alert["mitre_technique_id"]) == ("high", "T1110")
    assert ids(rules.brute_force(events), events) == {alert["alert_id"]: {1, 2, 3, 4}}


def test_window_bounds_are_closed(spark):
    at = minutes(60)
    events = frame(
        spark,
        [failure(1, at - timedelta(minutes=15)), failure(2, at), failure(9, at), event(4, at),
         failure(5, at - timedelta(minutes=15, microseconds=1)),
         connect(10, at), privilege(11, at), privilege(12, at + timedelta(hours=1)),
         privilege(13, at + timedelta(hours=1, microseconds=1)),
         serious(20, at, username="max"), serious(21, at + timedelta(hours=24), username="max"),
         serious(22, at + timedelta(hours=24), username="max"),
         serious(23, at + timedelta(hours=24, microseconds=1), username="max")],
    )
    found = rules.detect(events)
    by_rule = {row["rule_no"]: row for row in found.where("rule_no IN (1, 3, 6)").collect()}
    links = ids(found, events)
    assert links[by_rule[1]["alert_id"]] == {1, 2, 9, 4}
    assert links[by_rule[3]["alert_id"]] == {10, 11, 12}
    assert by_rule[3]["normalized_event_id"] == 12
    assert links[by_rule[6]["alert_id"]] == {20, 21, 22}


def test_unusual_ip_skips_known_and_missing_addresses(spark):
    events = frame(
        spark,
        [event(1, minutes(0), source_ip="198.51.100.24"), event(2, minutes(1)),
         event(3, minutes(2), source_ip=None), event(4, minutes(3), source_ip=""),
         event(5, None, username=None)],
    )
    found = {row["lead_event_id"]: row for row in rules.unusual_ip(events).collect()}
    assert set(found) == {2, 5}
    assert found[5]["description"] == "None successfully logged in from unusual IP 203.0.113.9."
    assert found[5]["first_seen"] is None


def test_vpn_rule_takes_asset_of_last_action(spark):
    events = frame(
        spark,
        [connect(1, minutes(10)), privilege(2, minutes(20)), privilege(3, minutes(25), asset="VAULT"),
         privilege(4, minutes(26), username="lee"), connect(5, minutes(10), username="")],
    )
    [alert] = rules.vpn_privilege(events).collect()
    assert alert["related_asset"] == "VAULT"
    assert alert["description"] == "kim connected to VPN and then performed 2 privilege-sensitive cloud actions."
    blank = frame(spark, [connect(1, minutes(10)), privilege(2, minutes(20), asset=None)])
    assert rules.vpn_privilege(blank).first()["related_asset"] == "LAPTOP-KIM"


def test_api_download_and_endpoint_rules(spark):
    api = dict(source_system="api_gateway", action="GET /x", outcome="200")
    events = frame(
        spark,
        [event(1, minutes(0), event_type="normal_report", **api),
         event(2, minutes(1), event_type="bulk_export", **api),
         event(3, minutes(2), event_type="bulk_export", **{**api, "outcome": "403"}),
         serious(4, minutes(3), event_type="process_start", severity="low"),
         serious(5, minutes(4), event_type="credential_access", severity="high"),
         serious(6, minutes(5), event_type="x", severity=None, normalized_message="MALWARE found"),
         serious(7, minutes(6), event_type="x", mitre_technique_id="T1003.001"),
         serious(8, minutes(7), event_type="malware_detected", source_system="other")],
    )
    assert [row["lead_event_id"] for row in rules.api_download(events).collect()] == [2]
    found = {row["lead_event_id"]: row for row in rules.endpoint_credential(events).collect()}
    assert set(found) == {5, 6, 7}
    assert (found[6]["severity"], found[6]["description"]) == ("high", "MALWARE found")
    assert found[5]["description"] == "Endpoint malware or credential access activity observed."


def test_multiple_high_takes_only_the_first_window(spark):
    events = frame(
        spark,
        [serious(1, minutes(0)), serious(2, minutes(60 * 30)), serious(3, minutes(60 * 31)),
         serious(4, minutes(60 * 32), severity="CRITICAL", asset="LAST"),
         serious(5, minutes(60 * 99)), serious(6, minutes(60 * 99)), serious(7, minutes(60 * 99)),
         serious(8, minutes(0), severity="low"), serious(9, None)],
    )
    found = rules.multiple_high(events)
    [alert] = found.collect()
    assert ids(found, events)[alert["alert_id"]] == {2, 3, 4}
    assert (alert["related_asset"], alert["severity"], alert["anchor_id"]) == ("LAST", "critical", 9)


def test_rules_never_mix_datasets(spark):
    rows = [failure(i, minutes(i), dataset_id=i % 2 + 1) for i in range(1, 5)]
    events = frame(spark, [*rows, event(9, minutes(6), dataset_id=1), event(10, minutes(6))])
    assert rules.brute_force(events).count() == 0


def test_rerun_adds_only_changed_alerts(spark):
    early = [failure(1, minutes(0)), failure(2, minutes(1)), failure(3, minutes(2)), event(4, minutes(4))]
    first = rules.detect(frame(spark, early))
    assert rules.new_alerts(first, first).count() == 0
    later = rules.detect(frame(spark, [*early, failure(5, minutes(3))]))
    [fresh] = rules.new_alerts(later, first).collect()
    assert (fresh["rule_no"], fresh["evidence_count"]) == (1, 5)


@pytest.mark.parametrize("seed", range(2))
def test_random_events_match_plain_joins(spark, seed):
    rows = random_events(seed, 400, 4)
    events = frame(spark, rows)
    found = rules.detect(events)
    assert {row["rule_no"] for row in found.collect()} == {1, 2, 3, 4, 5, 6}
    assert brute.spark_set(flat(found)) == brute.run(rows, (base.ALERTS,), f"SELECT {COLS} FROM alerts")
    links = evidence.alert_evidence(found, events).select("dataset_id", "alert_id", "event_id")
    assert brute.spark_set(links) == brute.run(
        rows, (base.ALERTS, base.EVIDENCE), "SELECT dataset_id, alert_id, event_id FROM alert_evidence"
    )


def test_one_user_with_most_of_the_events(spark):
    """A burst of one account: counting must not depend on how many failures share a window."""
    rows = [failure(i, minutes(i % 14) + timedelta(microseconds=i)) for i in range(1, 3001)]
    rows += [event(10_000 + i, minutes(14) + timedelta(seconds=i)) for i in range(5)]
    rows += [serious(20_000 + i, minutes(i)) for i in range(500)]
    found = rules.detect(frame(spark, rows))
    counts = {(row["rule_no"], row["evidence_count"]) for row in found.where("rule_no IN (1, 6)").collect()}
    expected = brute.run(rows, (base.ALERTS,), "SELECT rule_no, evidence_count FROM alerts WHERE rule_no IN (1, 6)")
    assert counts == expected
