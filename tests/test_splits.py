"""Readers whose records lie across lines and splits, beside the standard library's parsers."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from sentrel.sources import files, splits


@pytest.fixture(params=[150, 1 << 27])
def split_size(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "1")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


CELLS = ["", "a", "x,y", 'say "hi"', "line\nbreak", '"', '""', "é\n\n,\n\"", "  ", "tab\tbed", "}{", "'"]


def csv_text(rng: random.Random) -> str:
    names = rng.choice([["id", "note", "user"], ["user", "id"], ["id", "", "id", "more\nlines"], ["one"]])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow(names)
    for _ in range(rng.randrange(40)):
        writer.writerow([rng.choice(CELLS) for _ in range(max(1, len(names) - rng.choice([0, 0, 0, 1])))])
        if rng.random() < 0.1:
            out.write("\n")
        if rng.random() < 0.1:
            # Quotes inside a cell without quotes are text.
            out.write('in"ch,5" pipe' + "\n")
    return rng.choice(["", "﻿"]) + out.getvalue()


def csv_plain(text: str) -> tuple[list, list]:
    rows = [row for row in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if row]
    if not rows:
        return [], []
    names, good, bad = rows[0], [], []
    for number, row in enumerate(rows[1:], 1):
        if len(row) > len(names):
            bad.append(number)
            continue
        row = row + [None] * (len(names) - len(row))
        good.append((number, {name: value for name, value in zip(names, row) if name}))
    return good, bad


def test_random_csv_files(spark, tmp_path, split_size):
    rng = random.Random(7)
    texts = {f"f{n}.csv": csv_text(rng) for n in range(12)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = files.read_csv(spark, str(tmp_path), strict=False).collect()
    rejects = files.csv_rejects(spark, str(tmp_path)).collect()
    for name, text in texts.items():
        good, bad = csv_plain(text)
        own = sorted(
            ((r["record_no"], json.loads(r["payload"])) for r in found if r["file_name"] == name), key=lambda r: r[0]
        )
        assert own == good, name
        assert sorted(r["record_no"] for r in rejects if r["file_name"] == name) == bad, name


def test_a_quoted_cell_may_be_longer_than_splits(spark, tmp_path, split_size):
    note = "\n".join(f'line {n}, "quoted"' for n in range(300))
    out = io.StringIO()
    csv.writer(out).writerows([["id", "note"], ["1", note], ["2", "end"]])
    (tmp_path / "a.csv").write_bytes(out.getvalue().encode())
    rows = files.read_csv(spark, str(tmp_path)).orderBy("record_no").collect()
    assert [json.loads(r["payload"]) for r in rows] == [{"id": "1", "note": note}, {"id": "2", "note": "end"}]


def test_many_headers_make_one_plan(spark, tmp_path):
    def plan(count: int) -> str:
        folder = tmp_path / str(count)
        folder.mkdir()
        for n in range(count):
            (folder / f"{n}.csv").write_text(f"a{n},b\n1,2\n")
        frame = files.read_csv(spark, str(folder))
        assert frame.count() == count
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert plan(300).count("\n") == plan(2).count("\n")


ELEMENTS = [
    {"a": 1}, {"a": {"b": [{"c": 1}, 2]}}, {"t": 'br}ace "and" \\ quote'}, {}, {"u": "é{["}, {"n": None, "l": [[], {}]},
    {"long": "x}" * 60},
]


def json_text(rng: random.Random, odd: bool) -> str:
    rows = [rng.choice(ELEMENTS) for _ in range(rng.randrange(30))]
    if odd:
        rows = [rng.choice([1, "}s", [1, {"z": "]"}], None, True]) if rng.random() < 0.3 else row for row in rows]
    return rng.choice(["", "\n ", "﻿"]) + json.dumps(rows, indent=rng.choice([None, 1]), ensure_ascii=False) + rng.choice(["", "\n"])


def test_random_json_files(spark, tmp_path, split_size):
    rng = random.Random(3)
    texts = {f"f{n}.json": json_text(rng, n % 2 == 1) for n in range(14)}
    texts |= {
        "lone.json": ' {"a": {"b": 1}, "c": [{"d": 2}]}\n', "bad1.json": "[{}", "bad2.json": '[{"a": 1} {"b": 2}]',
        "bad3.json": '[{"a": 1},]', "bad4.json": '{"a": 1', "bad5.json": "[{}] x", "bad6.json": "12", "bad7.json": '[{"a": "x]',
        "bad8.json": '{"a": 1} {"b": 2}', "bad9.json": "[{}]]", "none.json": "[]", "spaced.json": "[ ]\n", "words.json": '["a", 1]',
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = files.read_json(spark, str(tmp_path), strict=False, lone_object=True).collect()
    rejects = files.json_rejects(spark, str(tmp_path)).collect()
    for name, text in texts.items():
        try:
            rows = json.loads(text.strip().removeprefix("﻿"))
        except ValueError:
            rows = None
        if isinstance(rows, dict):
            rows = [rows]
        own = sorted(((r["record_no"], json.loads(r["payload"])) for r in found if r["file_name"] == name), key=lambda r: r[0])
        out = sorted(((r["record_no"], r["reason"]) for r in rejects if r["file_name"] == name), key=repr)
        if not isinstance(rows, list):
            assert (own, out) == ([], [(None, "not a JSON document")]), name
            continue
        assert own == [(n, row) for n, row in enumerate(rows, 1) if isinstance(row, dict)], name
        assert out == sorted(((n, "not a JSON object") for n, row in enumerate(rows, 1) if not isinstance(row, dict)), key=repr), name


def test_one_array_is_read_by_many_tasks(spark, tmp_path, split_size):
    rows = [{"n": n, "note": "} ]," * (n % 4)} for n in range(400)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    pieces = splits.pieces(spark, str(tmp_path), ".json", "}")
    tasks = pieces.select(F.spark_partition_id().alias("p")).distinct().count()
    if split_size == 150:
        assert tasks >= 8
    read = files.read_json(spark, str(tmp_path)).collect()
    assert sorted((r["record_no"], json.loads(r["payload"])["n"]) for r in read) == [(n + 1, n) for n in range(400)]


def test_strict_json_fails(spark, tmp_path):
    for name, text, message in (
        ("a", "[1]", "every record to be an object"), ("b", "[{}", "Expected a JSON array"), ("c", "{}", "Expected a JSON array"),
    ):
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(Exception, match=message):
            files.read_json(spark, str(tmp_path / f"{name}.json")).collect()
