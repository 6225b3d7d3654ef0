"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sentrel.operators import browse, correlate, evidence, profile, rules, uploads
from sentrel.plans import ingest_catalog  # noqa: F401
from sentrel.plans.registry import QUERIES
from sentrel.session import materialize, shared_dir
from sentrel.sources import feeds, files, records
from sentrel.sources.telemetry import canonical_events
from tests.fixtures import event, failure, frame, minutes

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    """The plan with filter lists and schemas in full."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def events(spark):
    return materialize(canonical_events(spark, SF_DIR), "events")


@pytest.fixture(scope="module")
def alerts(spark, events):
    return materialize(rules.detect(events), "alerts")


def test_no_cross_joins_or_python_in_the_jobs(spark, events, alerts):
    assigned = correlate.assign_incidents(alerts)
    for df in (
        rules.detect(events), evidence.alert_evidence(alerts, events), assigned,
        evidence.incident_events(assigned, events), correlate.build_incidents(assigned),
    ):
        text = plan(df)
        for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
            assert name not in text
    # Only the first-fit over tied components runs in Python.
    for df in (rules.detect(events), evidence.alert_evidence(alerts, events)):
        assert "MapInPandas" not in plan(df)


def test_anchors_of_one_instant_share_a_window_row(spark):
    """100,000 anonymous successes at one instant: the window sees two marks, all are found."""
    nobody = {"username": None, "source_ip": None}
    failures = [failure(i, minutes(i % 3), **nobody) for i in range(1, 4)]
    first = frame(spark, [*failures, event(9, minutes(4), **nobody)])
    last = first.where("event_id = 9")
    events = first.where("event_id < 9").unionByName(
        spark.range(100_000).withColumnRenamed("id", "n").join(last).withColumn("event_id", F.col("n") + 9).drop("n")
    ).select(first.columns)
    found = rules.brute_force(events)
    assert found.count() == 100_000
    assert found.select("evidence_count").distinct().first()[0] == 4


def test_large_sides_are_joined_by_key_when_broadcast_is_off(spark, events, alerts):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(evidence.alert_evidence(alerts, events))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_are_limited_before_the_shuffle(spark, events):
    source = materialize(feeds.source_records(spark, SF_DIR).withColumns(
        {"source_system": F.lit("s"), "event_type": F.lit("t")}), "records")
    paths = profile.flatten_paths(materialize(feeds.upload_records(spark, SF_DIR), "uploads"))
    for df in (
        rules.multiple_high(events), records.first_of_each(source), profile.field_samples(paths),
    ):
        text = plan(df)
        before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
        assert "Exchange" in text[before:after]


def test_mappings_do_not_deal_records_by_dataset(spark):
    """Mappings of unknown size: their rules are small, so records stay where they are."""
    stored = materialize(feeds.upload_records(spark, SF_DIR), "uploads")
    text = plan(uploads.normalize_uploads(stored, feeds.mapping_table(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_files_are_read_once_and_records_not_dealt_by_file(spark, tmp_path):
    """Numbering looks at the records twice, and headers, splits and counts are few."""
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "b.json").write_text('[{"a": 1}, {"a": 2}]')
    root = str(tmp_path)
    table = files.read_csv(spark, f"{root}/a.csv")
    assert "BroadcastHashJoin" in plan(table) and "Exchange hashpartitioning(file#" not in plan(table)
    documents = files.read_json(spark, f"{root}/b.json")
    assert "Exchange hashpartitioning(file#" not in plan(documents).split("Aggregate")[-1]
    found = files.with_event_ids(table.unionByName(documents).withColumns(
        {"dataset_id": F.lit(1).cast("bigint"), "source_name": F.lit("s")}
    ))
    assert "Exchange hashpartitioning" not in plan(found) and "Generate" not in plan(found)
    assert {(r["event_id"], r["file_name"], r["record_no"], r["payload"]) for r in found.collect()} == {
        (1, "a.csv", 1, '{"a":"1","b":"2"}'), (2, "a.csv", 2, '{"a":"3","b":"4"}'),
        (3, "b.json", 1, '{"a":1}'), (4, "b.json", 2, '{"a":2}'),
    }


def test_the_audit_flattens_the_uploads_once(spark):
    assert "Generate" not in plan(QUERIES["mapping_audit"](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark, events):
    text = details(rules.api_download(events))
    assert "EqualTo(source_system,api_gateway)" in text
    assert "destination_ip" not in text and "Exchange" not in text
    logins = details(rules.brute_force(events))
    for part in ("EqualTo(source_system,CLOUD-IAM)", "EqualTo(outcome,failure)", "EqualTo(outcome,success)"):
        assert part in logins
    assert "normalized_message:" not in logins
    page = details(browse.browse_events(events, dataset_id=1, severity="high"))
    assert "EqualTo(dataset_id,1)" in page and "TakeOrderedAndProject" in page


def test_a_hot_join_key_is_split(spark):
    """All rows on one key: the join splits it into several tasks and loses nothing."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    rows = [failure(i, minutes(0)) for i in range(20_000)] + [
        failure(100_000 + i, minutes(0), username=f"u{i}") for i in range(60)
    ]
    rows += [event(200_000, minutes(1)), event(200_001, minutes(2))]
    events = materialize(frame(spark, rows).repartition(8), "hot")
    found = materialize(rules.brute_force(events), "hot-alerts")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        links = evidence.alert_evidence(found, events)
        assert links.count() == 2 * 20_001
        links.collect()
        assert "skew=true" in plan(links)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_stages_go_to_the_shared_folder(spark, events):
    assert all(shared_dir(spark) in name for name in events.inputFiles())


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"master": "spark://somewhere"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())
