"""End-to-end runs over small files: one attack, two isolated uploads, repeated runs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sentrel.operators import browse, dashboard, normalize, ownership, report, summary
from sentrel.plans import workflow
from sentrel.schema import INCIDENT_EVENT_SCHEMA
from sentrel.sources import files, sinks
from sentrel.sources.sinks import Store
from tests.fixtures import minutes

RUN_AT = datetime(2026, 3, 3, 4, 5, 6)


def stamp(value: float) -> str:
    return minutes(value).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """An account is guessed, enters by VPN, takes privileges, dumps credentials, exports."""
    root = tmp_path_factory.mktemp("sources")
    login = dict(source_system="CLOUD-IAM", event_type="interactive_login", action="login",
                 source_ip="203.0.113.9", asset="IAM", username="kim")
    auth = [dict(login, timestamp=stamp(n), outcome="failure", event_id=f"a{n}") for n in range(4)]
    auth.append(dict(login, timestamp=stamp(5), outcome="success", event_id="a5"))
    auth.append(dict(login, timestamp=stamp(6), outcome="success", event_id="a6", username="lee", source_ip="10.20.5.15"))
    (root / "auth_logs.json").write_text(json.dumps(auth))
    (root / "vpn_logs.csv").write_text(
        "vpn_event_id,time,user,client_ip,assigned_private_ip,device_name,action,result,session_id\n"
        f"v1,{stamp(10)},kim,203.0.113.9,10.8.0.4,LAPTOP-KIM,connect,success,s1\n"
        f"v2,{stamp(11)},lee,198.51.100.24,10.8.0.5,LAPTOP-LEE,connect,success,s2\n"
    )
    audit = [
        dict(audit_id=f"c{n}", event_time=stamp(20 + n), actor="kim", service=service, asset="IAM",
             operation=operation, outcome="success", details={"n": n})
        for n, (service, operation) in enumerate(
            [("identity", "CreateAccessKey"), ("identity", "AttachUserPolicy"), ("network", "UpdateSecurityGroup")]
        )
    ]
    (root / "cloud_audit_logs.json").write_text(json.dumps(audit))
    (root / "api_access_logs.csv").write_text(
        "request_id,timestamp,user,source_ip,asset,http_method,path,status_code,response_bytes,records_returned,request_category\n"
        f"r1,{stamp(40)},kim,203.0.113.9,API-01,GET,/export|all,200,10,5,bulk_export\n"
        f"r2,{stamp(41)},kim,203.0.113.9,API-01,GET,/export,403,,,bulk_export\n"
    )
    endpoint = [
        dict(endpoint_event_id=f"e{n}", observed_at=stamp(30 + n), host="LAPTOP-KIM", user_name="kim",
             event_type=kind, action="alert", outcome="blocked", severity=severity, message=message)
        for n, (kind, severity, message) in enumerate(
            [("credential_access", "high", "credential dump"), ("archive_created", "high", None), ("x", "critical", None)]
        )
    ]
    (root / "endpoint_alerts.json").write_text(json.dumps(endpoint))
    return str(root)


@pytest.fixture(scope="module")
def store(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    counters = workflow.run_all(spark, root, folder, RUN_AT)
    assert counters == {
        "etl": {"processed": 16, "raw_inserted": 16, "normalized_inserted": 16, "skipped_existing": 0},
        "detections": {"events_analyzed": 16, "alerts_created": 6, "alerts_skipped": 0},
        "incidents": {"alerts_analyzed": 6, "incidents_created": 1, "alerts_linked": 6, "incident_events_linked": 12},
    }
    return Store(spark, root)


def document(store, incident_id):
    return "".join(row["text"] for row in sinks.read_document(store, "reports", incident_id).collect())


def test_event_ids_follow_load_order(store):
    rows = sinks.events(store).orderBy("event_id").collect()
    assert [row["event_id"] for row in rows] == list(range(1, 17))
    assert [row["source_system"] for row in rows][:7] == ["CLOUD-IAM"] * 6 + ["vpn"]


def test_repeating_the_run_changes_nothing(spark, store, folder):
    again = workflow.run_all(spark, store.root, folder, RUN_AT + timedelta(days=1))
    assert again["etl"]["raw_inserted"] == again["etl"]["normalized_inserted"] == 0
    assert again["etl"]["skipped_existing"] == 16
    assert again["detections"] == {"events_analyzed": 16, "alerts_created": 0, "alerts_skipped": 6}
    assert again["incidents"]["incidents_created"] == 0
    assert sinks.incidents(store).count() == 1


def test_an_interrupted_load_is_completed(spark, folder, tmp_path):
    whole = Store(spark, str(tmp_path / "a"))
    workflow.load_sources(whole, folder)
    half = Store(spark, str(tmp_path / "b"))
    sinks.append_raw(half, sinks.raw_events(whole))
    counters = workflow.load_sources(half, folder)
    assert (counters["raw_inserted"], counters["normalized_inserted"]) == (0, 16)
    assert sinks.events(half).exceptAll(sinks.events(whole)).count() == 0


def test_stored_keys_are_not_shuffled_and_outlive_the_session(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "a"), key_buckets=4)
    workflow.load_sources(store, folder)
    known = sinks.raw_events(store)
    fresh = spark.range(9).select(F.md5(F.col("id").cast("string")).alias("event_key")).hint("merge")
    plan = fresh.join(known, "event_key", "left")._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.rindex("Join"):]
    assert "Bucketed: true" in stored and stored.count("Exchange") == 1
    # Another session knows nothing of the table but its folder, and may ask for other buckets.
    later = Store(spark.newSession(), str(tmp_path / "a"), key_buckets=9)
    assert workflow.load_sources(later, folder)["raw_inserted"] == 0
    assert sinks.raw_events(later).count() == 16


def test_an_event_whose_time_is_read_differently_is_the_same_event(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "a"))
    events = normalize.normalize_records(files.with_event_ids(files.read_sources(spark, folder)))
    assert sinks.append_events(store, events)["raw_inserted"] == 16
    moved = events.withColumn("event_timestamp", F.expr("event_timestamp + interval 2 days"))
    assert sinks.append_events(store, moved)["normalized_inserted"] == 0
    more = moved.withColumn("payload", F.concat(F.lit('{"more": 1, '), F.substring("payload", 2, 9999)))
    assert sinks.append_events(store, more)["normalized_inserted"] == 16
    ids = sorted(r["event_id"] for r in sinks.events(store).collect())
    assert ids == list(range(1, 33))


def test_incident_and_its_report(store):
    incident = sinks.incidents(store).first()
    assert incident["severity"] == "critical"
    assert incident["title"] == "Critical security incident for kim"
    assert incident["suspected_attack_path"] == (
        "Brute force followed by successful login -> Successful login from unusual IP -> "
        "VPN login followed by privilege escalation -> Endpoint malware or credential access -> "
        "Multiple high-severity events by same user within 24 hours -> Suspicious API data download"
    )
    workflow.write_report(store, RUN_AT)
    plain = document(store, incident["incident_id"])
    assert "Generate an LLM summary for a richer narrative." in plain
    assert "6 linked alerts and 12 normalized evidence events" in plain
    assert "No containment recommendations are available." in plain
    assert " - credential dump\n" in plain

    assert workflow.summarize(store, RUN_AT) == {"incidents_checked": 1, "summaries_created": 1}
    workflow.write_report(store, RUN_AT)
    text = document(store, incident["incident_id"])
    assert text.startswith("# Incident Investigation Report: Critical security incident for kim\n\n**Generated:** 2026-03-03 04:05:06 UTC\n")
    assert "Evidence event IDs: 1, 2, 3, 4, 5, 7, 9, 10, 12, 14, 15, 16.\n" in text
    assert "\n1, 2, 3, 4, 5, 7, 9, 10, 12, 14, 15, 16\n" in text
    assert "- **2026-03-02 08:00:00 UTC** - Event 1: CLOUD-IAM / interactive_login\n" in text
    assert "kim performed suspicious API download: GET /export\\|all." in text
    assert "- Disable or reset sessions for affected user accounts: kim.\n" in text
    assert text.endswith("is not a formal forensic report.\n")
    order = [text.index(f"\n| {name}") for name in ("Brute force", "Successful login", "VPN login", "Suspicious", "Endpoint", "Multiple")]
    assert order == sorted(order)

    gathered = workflow.stored_evidence(store)
    pieces = report.report_pieces(gathered, F.lit(RUN_AT), summary.latest_summary(sinks.summaries(store)))
    assert summary.document_parts(pieces).first()["text"] == text
    parts = summary.document_parts(pieces, length=7).orderBy("part_no").collect()
    assert "".join(row["text"] for row in parts) == text
    assert {len(row["text"]) for row in parts[:-1]} == {7}
    [stored] = sinks.summaries(store).collect()
    whole = sinks.technical_text(store).orderBy("section", "place").collect()
    assert whole[0]["text"] == stored["technical_summary"]
    assert "".join(row["text"] for row in whole).endswith(
        "Evidence event IDs: 1, 2, 3, 4, 5, 7, 9, 10, 12, 14, 15, 16."
    )


def test_a_report_shows_the_evidence_of_its_summary(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path))
    workflow.run_all(spark, str(tmp_path), folder, RUN_AT)
    incident = sinks.incidents(store).first()["incident_id"]
    workflow.summarize(store, RUN_AT)
    workflow.write_report(store, RUN_AT)
    before = document(store, incident)
    # Event 6 becomes evidence after the summary.
    store.append("incident_events", spark.createDataFrame([(incident, None, 6)], INCIDENT_EVENT_SCHEMA))
    assert workflow.stored_evidence(store).events.where("event_id = 6").count() == 1
    workflow.write_report(store, RUN_AT)
    assert document(store, incident) == before
    later = RUN_AT + timedelta(days=1)
    workflow.summarize(store, later)
    workflow.write_report(store, RUN_AT)
    after = document(store, incident)
    assert "Event 6: " in after and "\n1, 2, 3, 4, 5, 6, 7, 9, 10, 12, 14, 15, 16\n" in after
    assert sinks.summary_timeline(store).groupBy("summary_id").count().orderBy("count").select("count").collect() == [(12,), (13,)]


def test_a_summary_without_evidence_leaves_todays_timeline(spark, store):
    gathered = workflow.stored_evidence(store)
    drafts = summary.summarize(gathered).withColumn("summary_id", F.lit("s"))
    none = sinks.summary_timeline(Store(spark, store.root + "-none"))
    pieces = report.report_pieces(gathered, F.lit(RUN_AT), drafts, none)
    text = summary.document_parts(pieces).first()["text"]
    assert "Event 1: CLOUD-IAM / interactive_login - " in text
    assert "No evidence event IDs are available." in text and "Evidence event IDs: ." in text


def test_a_document_of_many_pieces_is_whole(spark):
    rows = spark.range(20_001).selectExpr(
        "'big' AS incident_id", "1 AS section", "array(id) AS place", "concat(id, ', ') AS text"
    ).unionByName(
        spark.createDataFrame([("small", 2, [1], "end"), ("small", 1, [1], ""), ("small", 1, [0], "the ")],
                              "incident_id string, section int, place array<bigint>, text string")
    )
    parts = summary.document_parts(rows.repartition(5)).orderBy("incident_id", "part_no").collect()
    assert "".join(r["text"] for r in parts if r["incident_id"] == "big") == "".join(f"{i}, " for i in range(20_001))
    assert [r["text"] for r in parts if r["incident_id"] == "small"] == ["the end"]


def test_report_files(store, tmp_path):
    documents = summary.document_parts(
        report.report_pieces(workflow.stored_evidence(store), F.lit(RUN_AT)), length=1 << 20
    ).withColumnRenamed("text", "document")
    named = documents.join(sinks.incidents(store).select("incident_id", "dataset_id"), "incident_id")
    sinks.write_reports(named, str(tmp_path / "out"), report.report_name())
    [written] = [p for p in (tmp_path / "out").glob("report=*/*.txt")]
    assert written.parent.name.startswith("report=incident-inc-")
    assert written.read_text().startswith("# Incident Investigation Report")


def test_uploads_stay_apart(spark, store, tmp_path):
    header = "timestamp,event_type,username,asset,action,outcome,severity,mitre_technique_id,message\n"
    for dataset, name in ((1, "ann"), (2, "bob")):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"{header}{stamp(0)},credential_access,{name},BOX-{dataset},alert,seen,high,T1003.001,credential use by {name}\n")
        described = workflow.describe_upload(spark, str(path), dataset, name, "endpoint", RUN_AT)
        sinks.append_dataset(store, described, RUN_AT)
        counters = workflow.run_upload(spark, store.root, str(path), dataset, "endpoint", RUN_AT)
        assert counters["detections"]["alerts_created"] == 1
        assert counters["incidents"]["incidents_created"] == 1
        assert counters["summaries"] == {"incidents_checked": 1, "summaries_created": 1}
    again = workflow.run_upload(spark, store.root, str(tmp_path / "ann.csv"), 1, "endpoint", RUN_AT)
    assert again["detections"]["alerts_created"] == again["summaries"]["summaries_created"] == 0

    known = {row["dataset_id"]: (row["status"], row["record_count"]) for row in sinks.datasets(store).collect()}
    assert known == {1: ("workflow_complete", 1), 2: ("workflow_complete", 1)}
    incidents, events, alerts = sinks.incidents(store), sinks.events(store), sinks.alerts(store)
    owned = {row["dataset_id"]: row["incident_id"] for row in incidents.where("dataset_id IS NOT NULL").collect()}
    foreign = events.where("dataset_id = 2").first()["event_id"]
    planted = spark.createDataFrame([(owned[1], 1, foreign)], "incident_id string, dataset_id bigint, event_id bigint")
    store.append("incident_events", planted)
    workflow.write_report(store, RUN_AT, dataset_id=1)
    text = document(store, owned[1])
    assert "ann" in text and "bob" not in text and str(foreign) not in text
    assert document(store, owned[2]) == ""
    workflow.write_report(store, RUN_AT, dataset_id=2)
    assert document(store, owned[1]) == text and "bob" in document(store, owned[2])
    with pytest.raises(LookupError):
        sinks.set_status(store, 99, "normalized", RUN_AT)

    page = browse.browse_events(events, dataset_id=1).collect()
    assert [row["username"] for row in page] == ["ann"]
    assert browse.browse_alerts(alerts, dataset_id=2).first()["related_username"] == "bob"
    assert browse.browse_incidents(incidents, alerts, dataset_id=1).count() == 1
    assert {row["affected_user"] for row in browse.browse_incidents(incidents, alerts).collect()} == {"kim"}
    assert browse.lookup(incidents, "incident_id", owned[1], dataset_id=2).count() == 0
    assert browse.lookup(incidents, "incident_id", owned[1], dataset_id=1).count() == 1
    assert browse.lookup_incident(incidents, alerts, owned[1], dataset_id=1).count() == 1
    mixed = incidents.withColumn("dataset_id", F.lit(None).cast("bigint"))
    assert browse.lookup_incident(mixed, alerts, owned[1]).count() == 0
    assert browse.incident_detail(mixed, alerts, sinks.incident_links(store), events).where(
        F.col("incident_id").isin(owned[1], owned[2])).count() == 0
    items = browse.incident_detail(incidents, alerts, sinks.incident_links(store), events)
    mine = items.where(F.col("incident_id") == owned[1]).collect()
    assert {(row["item"], row["username"]) for row in mine} == {("alert", "ann"), ("event", "ann")}
    counts = {row["dataset_id"]: row for row in dashboard.dashboard_counts(events=events, incidents=incidents).collect()}
    assert (counts[None]["events"], counts[1]["events"], counts[2]["incidents"]) == (16, 1, 1)


def test_all_scopes_in_one_run(spark, store):
    everything = workflow.detect(store, everything=True)
    assert everything["alerts_created"] == 0
    assert workflow.correlate_alerts(store, RUN_AT, everything=True)["alerts_analyzed"] == 0


def test_upload_with_a_bad_time_is_refused_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (tmp_path / "a.ndjson").write_text('{"time": "2026-03-02"}\n{"time": "soon"}\n')
    with pytest.raises(Exception, match="record 2"):
        workflow.load_upload(store, str(tmp_path / "a.ndjson"), 1, "generic")
    assert sinks.events(store).count() == 0
    counters = workflow.load_upload(store, str(tmp_path / "a.ndjson"), 1, "generic", strict=False)
    assert counters["normalized_inserted"] == 1


def test_upload_description(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"published": "2026-03-02", "n": 1}]')
    row = workflow.describe_upload(spark, str(tmp_path / "a.json"), 4, " Name ", " API ", RUN_AT, " d ").first()
    assert (row["name"], row["description"], row["source_type"], row["status"], row["record_count"]) == (
        "Name", "d", "api", "ready_to_normalize", 1
    )
    found = workflow.inspect_upload(spark, str(tmp_path / "a.json"), 4, "api").collect()
    assert [(row["path"], row["target_field"]) for row in found] == [("n", None), ("published", "timestamp")]
    with pytest.raises(ValueError, match="name is required"):
        workflow.describe_upload(spark, str(tmp_path / "a.json"), 4, " ", "api", RUN_AT)


def test_prompt_lists_evidence_in_order(spark, store):
    from sentrel.operators import evidence

    listed = evidence.alert_evidence(sinks.alerts(store), sinks.events(store))
    gathered = workflow.stored_evidence(store)
    text = summary.document_parts(summary.prompt_pieces(gathered, listed)).first()["text"]
    lines = text.split("\n")
    assert lines[0] == "You are summarizing a breach investigation."
    assert "; severity=high; user=kim; asset=IAM; events=[1, 2, 3, 4, 5]" in lines[6]
    assert lines[8].endswith("events=[7, 9, 10]")
    assert lines[12:14] == ["Events:", "- Event 1: 2026-03-02 08:00:00+00:00; CLOUD-IAM; interactive_login; user=kim; asset=IAM; action=login; outcome=failure; message=None"]


def test_ownership_backfill(spark):
    alerts = spark.createDataFrame(
        [("a", 1, "i"), ("b", 2, "i"), ("c", 3, "j"), ("d", 1, "k"), ("e", 2, "k"), ("f", 1, None)],
        "alert_id string, normalized_event_id bigint, incident_id string",
    ).withColumn("dataset_id", F.lit(None).cast("bigint"))
    events = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "event_id bigint, dataset_id bigint")
    owned = ownership.own_alerts(alerts, events)
    assert {row["alert_id"]: row["dataset_id"] for row in owned.collect()} == dict(a=5, b=5, c=None, d=5, e=5, f=5)
    mixed = owned.withColumn("dataset_id", F.when(F.col("alert_id") == "e", 6).otherwise(F.col("dataset_id")))
    incidents = spark.createDataFrame([("i", None), ("j", None), ("k", None)], "incident_id string, dataset_id bigint")
    assert {row["incident_id"]: row["dataset_id"] for row in ownership.own_incidents(incidents, mixed).collect()} == dict(i=5, j=None, k=None)


def test_browse_pages_put_missing_times_first(spark):
    from tests.fixtures import event, frame

    events = frame(spark, [event(1, minutes(0)), event(2, None), event(3, minutes(1)), event(4, minutes(1))])
    assert [row["event_id"] for row in browse.browse_events(events).collect()] == [2, 4, 3, 1]
    assert [row["event_id"] for row in browse.browse_events(events, skip=1, limit=2).collect()] == [4, 3]
    closed = browse.browse_events(events, start=minutes(0), end=minutes(1)).collect()
    assert [row["event_id"] for row in closed] == [4, 3, 1]
    with pytest.raises(ValueError):
        browse.browse_events(events, limit=501)


def test_upload_listing(spark):
    datasets = spark.createDataFrame(
        [(1, RUN_AT), (2, RUN_AT + timedelta(days=1))], "dataset_id bigint, created_at timestamp"
    )
    files = spark.createDataFrame([(1, "b.csv", 2), (1, "a.csv", 1)], "dataset_id bigint, original_filename string, size_bytes bigint")
    rows = browse.list_uploads(datasets, files).collect()
    assert [row["dataset_id"] for row in rows] == [2, 1]
    assert [item["original_filename"] for item in rows[1]["files"]] == ["a.csv", "b.csv"]
    assert rows[0]["files"] == []


def test_stored_mappings_and_uploads(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    path = tmp_path / "m.json"
    path.write_text('[{"when": "2026-03-02T08:00:00Z", "who": "Ann", "time": "2020-01-01"}]')
    workflow.register_upload(store, str(path), 7, "m", "generic", RUN_AT)
    [listed] = workflow.list_uploads(store).collect()
    assert [tuple(f) for f in listed["files"]] == [("m.json", path.stat().st_size)]
    columns = "dataset_id bigint, source_field string, target_field string, transformation_type string, default_value string"
    rows = [(7, "when", "timestamp", "direct", None), (7, "who", "username", "uppercase", None)]
    workflow.map_upload(store, str(path), 7, "generic", spark.createDataFrame(rows, columns), RUN_AT)
    assert [r["source_field"] for r in workflow.mapping_list(store, 7).collect()] == ["when", "who"]
    shown = workflow.preview_upload(store, str(path), 7, "generic").first()
    assert (shown["username"], shown["event_timestamp"].year) == ("ANN", 2026)
    later = RUN_AT + timedelta(minutes=1)
    workflow.map_upload(store, str(path), 7, "generic", spark.createDataFrame([], columns), later)
    assert workflow.mapping_list(store, 7).count() == 0
    assert sinks.datasets(store).first()["status"] == "ready_to_normalize"
    with pytest.raises(LookupError):
        workflow.map_upload(store, str(path), 8, "generic", spark.createDataFrame([], columns), later)
    workflow.map_upload(store, str(path), 7, "generic", spark.createDataFrame(rows, columns), later + timedelta(minutes=1))
    workflow.load_upload(store, str(path), 7, "generic")
    assert sinks.events(store).first()["username"] == "ANN"


def test_time_bounds_prune_days(spark, store):
    start, end = datetime(2026, 3, 2), datetime(2026, 3, 3)
    page = workflow.browse_stored_events(store, start, end)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = page._jdf.queryExecution().explainString(mode)
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert page.count() == browse.browse_events(sinks.events(store), start=start, end=end).count() > 0
