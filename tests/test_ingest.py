from __future__ import annotations

import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentrel.operators import normalize, profile, uploads
from sentrel.schema import MAPPING_SCHEMA
from sentrel.sources import files, records

RECORD = "dataset_id bigint, source_name string, file_name string, record_no bigint, payload string"
UPLOAD = "dataset_id bigint, source_type string, file_name string, record_no bigint, payload string"


def sources(spark, *items):
    rows = [(None, name, "f", n, json.dumps(body)) for n, (name, body) in enumerate(items, 1)]
    return spark.createDataFrame(rows, RECORD)


def uploaded(spark, *bodies, kind="generic", dataset=1):
    rows = [(dataset, kind, "f", n, json.dumps(body)) for n, body in enumerate(bodies, 1)]
    return spark.createDataFrame(rows, UPLOAD)


def test_sources_are_projected_by_name(spark):
    rows = normalize.normalize_records(
        sources(
            spark,
            ("auth", {"timestamp": "2026-03-02T08:00:00Z", "username": " kim ", "reason": ""}),
            ("vpn", {"time": "2026-03-02T08:00:00Z", "action": "connect", "user": "kim"}),
            ("cloud_audit", {"event_time": "2026-03-02T08:00:00Z", "service": "identity", "operation": "X"}),
            ("api_access", {"timestamp": "2026-03-02T08:00:00Z", "status_code": 200, "response_bytes": 10}),
            ("endpoint_alert", {"observed_at": "2026-03-02T08:00:00Z", "user_name": "kim", "severity": None}),
        )
    ).orderBy("record_no").collect()
    auth, vpn, cloud, api, endpoint = rows
    assert (auth["source_system"], auth["event_type"], auth["username"]) == ("CLOUD-IAM", "auth_event", "kim")
    assert auth["normalized_message"] is None
    assert vpn["normalized_message"] == "VPN connect unknown for session unknown"
    assert (cloud["source_system"], cloud["action"]) == ("cloud_identity", "X")
    assert cloud["normalized_message"] == "unknown actor performed X on unknown resource"
    assert (api["outcome"], api["action"]) == ("200", "REQUEST unknown_path")
    assert api["normalized_message"] == (
        "REQUEST unknown_path returned 200 with unknown records and 10 bytes"
    )
    assert (endpoint["source_system"], endpoint["event_type"]) == ("endpoint-edr", "endpoint_event")


def test_unknown_source_and_bad_time_fail(spark):
    with pytest.raises(Exception, match="Unsupported source: syslog"):
        normalize.normalize_records(sources(spark, ("syslog", {}))).collect()
    bad = sources(spark, ("auth", {"timestamp": "yesterday"}))
    with pytest.raises(Exception, match="Invalid ISO timestamp: yesterday"):
        normalize.normalize_records(bad).collect()
    assert normalize.normalize_records(bad, strict=False).first()["event_timestamp"] is None


def test_a_further_source_can_be_registered(spark):
    dns = normalize.Source("at", ("q",), lambda get: {"source_system": F.lit("dns"), "asset": get("q")})
    rows = normalize.normalize_records(
        sources(spark, ("dns", {"at": "2026-03-02", "q": "x.test"})), {**normalize.SOURCES, "dns": dns}
    )
    assert rows.first()["asset"] == "x.test"


def test_uploads_by_alias(spark):
    plain, spaced, api = uploads.normalize_uploads(
        uploaded(spark, {"time": "2026-03-02T08:00:00Z"}, {"username": "  ", "actor": "kim"},
                 {"method": "GET", "url": "/Export"}, kind=" API ")
    ).orderBy("record_no").collect()
    assert plain["event_type"] == "api_access"
    assert plain["normalized_message"] == "unknown user api_access"
    assert spaced["username"] is None
    assert (api["action"], api["event_type"], api["source_system"]) == ("GET /Export", "bulk_export", "api_gateway")
    only_time = uploads.normalize_uploads(uploaded(spark, {"published": "2026-03-02"})).first()
    assert (only_time["source_system"], only_time["event_type"]) == ("uploaded_generic", "uploaded_event")
    assert only_time["username"] is None


def test_mapping_replaces_the_automatic_value(spark):
    mappings = spark.createDataFrame(
        [(1, "device.name", "asset", "uppercase", None), (1, "gone", "username", "direct", None),
         (1, "level", "severity", "direct", "LOW"), (1, "a.b", "action", "direct", None),
         (1, "o'k", "message", "direct", None), (1, "gone", "source_system", "direct", None)],
        MAPPING_SCHEMA,
    )
    body = {"timestamp": "2026-03-02", "asset": "auto", "user": "auto", "device": {"name": "box"},
            "a": {"b": "nested"}, "a.b": "literal", "o'k": "quoted", "source": "siem"}
    row = uploads.normalize_uploads(uploaded(spark, body, kind="vpn"), mappings).first()
    assert (row["asset"], row["username"], row["severity"]) == ("BOX", None, "low")
    assert (row["action"], row["normalized_message"], row["source_system"]) == ("literal", "quoted", "vpn")
    untouched = uploads.normalize_uploads(uploaded(spark, body, dataset=2), mappings).first()
    assert (untouched["asset"], untouched["source_system"]) == ("auto", "siem")


def test_timestamp_gate_and_preview(spark):
    rows = uploads.normalize_uploads(uploaded(spark, {"time": "2026-03-02"}, {"time": "x"}))
    [reject] = uploads.timestamp_rejects(rows).collect()
    assert "record 2 did not produce one" in reject["reason"]
    assert uploads.timestamp_gate(rows).count() == 1
    with pytest.raises(Exception, match="record 2"):
        uploads.timestamp_gate(rows, strict=True).collect()
    shown = uploads.preview(uploaded(spark, *({"time": "x"} for _ in range(20))), None, limit=99)
    assert shown.count() == 10
    assert shown.where("scan_no = 1").first()["warning"].startswith("Record 1 has no valid timestamp")


def test_source_types_are_checked(spark):
    good = spark.createDataFrame([(1, " VPN ")], "dataset_id bigint, source_type string")
    assert uploads.check_source_types(good).first()["source_type"] == "vpn"
    bad = spark.createDataFrame([(1, "mail")], "dataset_id bigint, source_type string")
    with pytest.raises(Exception, match="Use one of: api, auth, cloud, endpoint, generic, vpn"):
        uploads.check_source_types(bad).collect()


def test_schema_inspection(spark):
    bodies = [{"Time": "t1", "user": {"name": "kim", "tags": [1, 2]}, "none": None, "empty": {}},
              {"Time": "t2"}, {"Time": "t1"}, {"Time": "t3"}, {"Time": "t4", "note": "n" * 200}]
    found = {row["path"]: row for row in profile.inspect_schema(uploaded(spark, *bodies)).collect()}
    assert set(found) == {"Time", "user.name", "user.tags", "none", "note"}
    assert found["Time"]["sample_values"] == ["t1", "t2", "t3"]
    assert found["Time"]["target_field"] == "timestamp"
    assert found["user.tags"]["sample_values"] == ["[1,2]"]
    assert found["none"]["sample_values"] == ["null"]
    assert found["note"]["sample_values"] == ["n" * 157 + "..."]
    deep = {"a": {"b": {"c": {"d": 1}}}}
    assert profile.flatten_paths(uploaded(spark, deep)).first()["path"] == "a.b.c.d"


def test_records_of_any_depth_keep_their_fields(spark):
    deep = {"timestamp": "t"}
    for level in "ihgfedcba":
        deep = {level: deep, "text": '{ " { \\'}
    rows = profile.flatten_paths(uploaded(spark, deep, {"x": 1})).collect()
    assert {row["path"] for row in rows} >= {"a.b.c.d.e.f.g.h.i.timestamp", "a.b.c.d.e.f.g.h.text", "text", "x"}
    assert profile.readiness(profile.inspect_schema(uploaded(spark, deep))).first()["status"] == "ready_to_normalize"


def test_a_very_deep_record_beside_flat_ones(spark):
    deep = '"x"'
    for level in range(999):
        deep = '{"k%d": %s}' % (level % 3, deep)
    odd = '{"a.b": 1, "a": {"b": {"c": {"d": {"e": [1, {"z": "]}"}], "f \\"q": 1.50, "g": {}, "h": null, "i": "}{"}}}}}'
    empty = '{"a": {"b": {"c": {"d": {}}}}}'
    flat = spark.range(5_000).selectExpr(
        "1L AS dataset_id", "'generic' AS source_type", "'f' AS file_name", "id AS record_no", "'{\"k\": 1}' AS payload"
    )
    rows = [(1, "generic", "g", n, text) for n, text in enumerate((deep, odd, empty, "[1]", "{", '{"k": 1, "k": {}}'), 1)]
    records_ = flat.unionByName(spark.createDataFrame(rows, UPLOAD))
    found = profile.flatten_paths(records_).select(
        "file_name", "record_no", "path", profile.render_sample(F.col("value")).alias("sample")
    )
    assert found.where("file_name = 'f'").count() == 5_000
    own = {(r["record_no"], r["path"]): r["sample"] for r in found.where("file_name = 'g'").collect()}
    names = [f"k{level % 3}" for level in reversed(range(999))]
    assert own == {
        (1, ".".join(names)): "x", (2, "a.b"): "1", (2, "a.b.c.d.e"): '[1,{"z":"]}"}]', (2, 'a.b.c.d.f "q'): "1.5",
        (2, "a.b.c.d.h"): "null", (2, "a.b.c.d.i"): "}{",
    }


def test_flattening_has_one_plan_and_one_scan(spark, tmp_path):
    uploaded(spark, {"a": {"b": {"c": {"d": {"e": 1}}}}}, {"a": 1}).write.parquet(str(tmp_path / "r"))
    plan = profile.flatten_paths(spark.read.parquet(str(tmp_path / "r")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Generate explode") == profile.OPENED_LEVELS + 1


def test_records_of_few_levels_are_not_walked(spark, monkeypatch):
    """Neither many objects nor braces in strings make a record deep."""
    monkeypatch.setattr(
        profile, "deep_fields",
        lambda text: F.when(text.isNotNull(), F.raise_error(F.lit("walked")).cast(profile.LEAVES)),
    )
    bodies = ({"m": {"o": {"n": 1}}, "g": {"c": 2}, "h": {}}, {"a": '{{{{"\\', "b": {"c": {"d": "{"}}}, {"x": "{" * 100_000})
    found = profile.flatten_paths(uploaded(spark, *bodies)).select("record_no", "path").collect()
    assert {tuple(row) for row in found} == {
        (1, "m.o.n"), (1, "g.c"), (2, "a"), (2, "b.c.d"), (3, "x")
    }
    # Closing braces in strings close nothing.
    with pytest.raises(Exception, match="walked"):
        profile.flatten_paths(uploaded(spark, {"a": "}}}", "b": {"c": {"d": {"e": "}"}}}})).collect()


def test_walking_holds_few_records_at_a_time():
    text = json.dumps({"a": {"b": {"c": {f"k{n}": {"v": n} for n in range(30)}}}})
    texts = pa.array([text, None, "{}"] * 2_000)
    tracemalloc.start()
    found = profile._walked(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000
    own = [{"key": key, "json": value} for key, value in profile.leaf_fields(text)]
    assert found.to_pylist() == [own, None, []] * 2_000


def test_first_samples_over_files_and_missing_numbers(spark):
    """Samples and first places as a plain loop finds them; leaves are hashed, not sorted."""
    rows = [
        (n % 2 + 1, "generic", None if n % 5 == 0 else f"f{n % 3}", None if n % 7 == 0 else n % 11,
         json.dumps({"a": n * 7 % 13, "b": {"c": n % 2}, "b.c": "x", f"k{n % 4}": None}))
        for n in range(120)
    ]
    paths = profile.flatten_paths(spark.createDataFrame(rows, UPLOAD))
    least, seen = {}, {}
    order = lambda place: tuple((part is not None, part) for part in place)
    for dataset, _, file, number, text in rows:
        body = json.loads(text)
        leaves = [(k, v) for k, v in body.items() if k != "b"] + [("b.c", body["b"]["c"])]
        for path, value in leaves:
            sample, place = "null" if value is None else str(value), order((file, number))
            held = least.setdefault((dataset, path), {})
            held[sample] = min(held.get(sample, place), place)
            seen[dataset, path] = min(seen.get((dataset, path), place), place)
    wanted = {
        (*field, place, sample)
        for field, held in least.items()
        for place, sample in enumerate(sorted(held, key=lambda s: (held[s], s))[:3], 1)
    }
    found = profile.field_samples(paths)
    assert {(r["dataset_id"], r["path"], r["place"], r["sample"]) for r in found.collect()} == wanted
    fields = profile.first_seen(paths)
    assert {(r["dataset_id"], r["path"]): order(r["seen"]) for r in fields.collect()} == seen
    for df in (found, fields):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_one_source_per_target(spark):
    fields = spark.createDataFrame(
        [(1, "zeit.time", 1), (1, "event_time", 2), (1, "timestamp", 3)], "dataset_id bigint, path string, seen bigint"
    )
    found = {row["path"]: row["target_field"] for row in profile.suggest_mappings(fields).collect()}
    assert found == {"zeit.time": None, "event_time": None, "timestamp": "timestamp"}
    assert profile.readiness(profile.suggest_mappings(fields)).first()["status"] == "ready_to_normalize"


def test_mapping_audit_and_replacement(spark):
    fields = spark.createDataFrame([(1, "a"), (1, "b")], "dataset_id bigint, path string")
    definitions = spark.createDataFrame(
        [(1, 1, " a ", "timestamp", "", None), (1, 2, "a", "asset", "direct", None), (1, 3, "b", "timestamp", "direct", None),
         (1, 4, "c", "asset", "direct", None), (1, 5, "b", "colour", "direct", None), (1, 6, "b", "asset", "reverse", None),
         (1, 7, " ", "asset", "direct", None)],
        "dataset_id bigint, ordinal int, source_field string, target_field string, transformation_type string, default_value string",
    )
    rows = profile.audit_mappings(definitions, fields).orderBy("ordinal").collect()
    assert [row["reason"] for row in rows] == [
        None, "Duplicate source field mapping: a", "Duplicate target field mapping: timestamp", "Unknown source field: c",
        "Invalid target field: colour", "Invalid transformation_type: reverse", "source_field cannot be empty",
    ]
    assert [row["blocks"] for row in rows] == [False, True, False, False, False, False, False]

    datasets = spark.createDataFrame([(1, "mapping_required"), (2, "normalized"), (3, "uploaded")], "dataset_id bigint, status string")
    stored = spark.createDataFrame([(1, "x", "asset", "direct", None), (2, "x", "asset", "direct", None)], MAPPING_SCHEMA)
    fresh = spark.createDataFrame([(1, "t", "timestamp", "direct", None), (2, "t", "timestamp", "direct", None)], MAPPING_SCHEMA)
    none = spark.createDataFrame([], "dataset_id bigint, target_field string")
    mappings, updated = profile.replace_mappings(stored, datasets, fresh, none)
    assert {(row["dataset_id"], row["source_field"]) for row in mappings.collect()} == {(1, "t"), (2, "x")}
    assert {row["dataset_id"]: row["status"] for row in updated.collect()} == {
        1: "ready_to_normalize", 2: "normalized", 3: "uploaded"
    }
    assert [row["source_field"] for row in profile.dataset_mappings(mappings, 2).collect()] == ["x"]
    both = datasets.select("dataset_id")
    cleared, updated = profile.replace_mappings(stored, datasets, fresh.limit(0), none, both)
    assert [row["dataset_id"] for row in cleared.collect()] == [2]
    assert updated.where("dataset_id = 3").first()["status"] == "mapping_required"
    inputs = spark.createDataFrame([("a", None), ("b", " "), ("c", "asset")], "source_field string, target_field string")
    assert [row["source_field"] for row in profile.wanted_definitions(inputs).collect()] == ["c"]


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1, "m": {"x": [1]}}, {"n": 2}]')
    (tmp_path / "bad.json").write_text("{oops")
    (tmp_path / "lone.json").write_text('﻿{"n": 3}', encoding="utf-8")
    (tmp_path / "mixed.json").write_text('[{"n": 4}, 5]')
    good = files.read_json(spark, str(tmp_path / "a.json")).orderBy("record_no").collect()
    assert [(row["record_no"], json.loads(row["payload"])["n"]) for row in good] == [(1, 1), (2, 2)]
    for name, message in (("bad", "Expected a JSON array"), ("lone", "Expected a JSON array"), ("mixed", "to be an object")):
        with pytest.raises(Exception, match=message):
            files.read_json(spark, str(tmp_path / f"{name}.json")).collect()
    assert files.read_json(spark, str(tmp_path / "lone.json"), lone_object=True).count() == 1
    assert files.read_json(spark, str(tmp_path), strict=False, lone_object=True).count() == 4


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,kim,"x, y"\n2,lee\n3,,\n4,max,n,extra\n5,"a,b",,"x"\n6,"say ""hi, you""",\n')
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), strict=False).orderBy("record_no").collect()
    with pytest.raises(Exception, match="More cells than columns in record [45]"):
        files.read_csv(spark, str(tmp_path / "a.csv")).select("file_name").collect()
    assert [json.loads(row["payload"]) for row in rows] == [
        {"id": "1", "name": "kim", "note": "x, y"}, {"id": "2", "name": "lee", "note": None},
        {"id": "3", "name": "", "note": ""}, {"id": "6", "name": 'say "hi, you"', "note": ""},
    ]
    rejects = files.csv_rejects(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(row["record_no"] for row in rejects) == [4, 5]


def test_ndjson_files_keep_line_numbers_across_splits(spark, tmp_path):
    lines = [json.dumps({"n": n}) if n % 10 else "" for n in range(1, 5001)]
    lines[6], lines[12] = "{broken", "[1]"
    (tmp_path / "a.ndjson").write_text("﻿" + "\n".join(lines), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = files.read_ndjson(spark, str(tmp_path / "a.ndjson"), strict=False)
        assert read.rdd.getNumPartitions() > 1
        rows = read.collect()
        assert len(rows) == 5000 - 500 - 2
        assert all(json.loads(row["payload"])["n"] == row["record_no"] for row in rows)
        rejects = records.ndjson_rejects(files.read_lines(spark, str(tmp_path / "a.ndjson")))
        assert {(row["line_no"], row["reason"]) for row in rejects.collect()} == {
            (7, records.BAD_JSON), (13, records.NOT_OBJECT)
        }
        with pytest.raises(Exception, match="Invalid NDJSON on line"):
            files.read_ndjson(spark, str(tmp_path / "a.ndjson")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_upload_dispatch(spark, tmp_path):
    (tmp_path / "a.CSV").write_text("time,user\n2026-03-02,kim\n")
    (tmp_path / "b.json").write_text('{"time": "2026-03-02"}')
    (tmp_path / "c.ndjson").write_text('{"time": "2026-03-02"}\n\n')
    (tmp_path / "d.ndjson").write_text("")
    assert files.read_upload(spark, str(tmp_path), 1, "generic").count() == 3
    (tmp_path / "e.txt").write_text("x")
    with pytest.raises(ValueError, match="uploads are supported"):
        files.read_upload(spark, str(tmp_path), 1, "generic")


def test_equal_payloads_are_one_event(spark):
    rows = spark.createDataFrame(
        [(None, "s", "t", "f", 1, '{"a": 1, "b": 2}'), (None, "s", "t", "f", 2, '{"b": 2, "a": 1.0}'),
         (1, "s", "t", "f", 3, '{"a": 1, "b": 2}'), (None, "s", "u", "f", 4, '{"a": 1, "b": 2}'),
         (None, "s", "t", "f", 5, '{"a": 1, "b": 3}'), (None, "s", "t", "f", 6, '{"a": 1, "b": 2}')],
        "dataset_id bigint, source_system string, event_type string, file_name string, record_no bigint, payload string",
    )
    kept = records.first_of_each(rows)
    assert sorted(row["record_no"] for row in kept.collect()) == [1, 3, 4, 5]


def test_csv_uploads_of_several_layouts(spark, tmp_path):
    folder = tmp_path / "up load"
    folder.mkdir()
    (folder / "a.csv").write_text('user,note,time\nkim,"line one\nline ""two""",t1\nlee,,t2\n')
    (folder / "b.csv").write_text("time,user\nt3,max\nt4,ann,extra\n")
    (folder / "c.CSV").write_text("time,user\nt5,bob\n")
    (folder / "d.txt").write_text("no format\n")
    (folder / "e.ndjson").write_text('{"time": "t6"}\nbad\n')
    records = files.read_upload(spark, str(folder), 1, "generic", strict=False).collect()
    found = {(r["file_name"], r["record_no"]): json.loads(r["payload"]) for r in records}
    assert found == {
        ("a.csv", 1): {"user": "kim", "note": 'line one\nline "two"', "time": "t1"},
        ("a.csv", 2): {"user": "lee", "note": "", "time": "t2"},
        ("b.csv", 1): {"time": "t3", "user": "max"}, ("c.CSV", 1): {"time": "t5", "user": "bob"},
        ("e.ndjson", 1): {"time": "t6"},
    }
    rejects = {tuple(r) for r in files.upload_rejects(spark, str(folder), 1).collect()}
    assert rejects == {
        (1, "b.csv", 2, "more cells than columns"), (1, "d.txt", None, "unsupported format"),
        (1, "e.ndjson", 2, "invalid JSON"),
    }
    with pytest.raises(ValueError, match="txt"):
        files.read_upload(spark, str(folder), 1, "generic")
