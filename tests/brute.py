"""Fixture results by plain SQL joins and the literal first-fit, in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd

from oracles import base
from sentrel.schema import EVENT_SCHEMA

EVENTS = """ev AS (
  SELECT * EXCLUDE (event_timestamp), CASE WHEN event_timestamp IS NOT NULL THEN event_timestamp END AS t FROM fixture
)"""


def run(rows: list[tuple], parts: tuple[str, ...], select: str) -> set[tuple]:
    names = EVENT_SCHEMA.fieldNames()
    con = duckdb.connect()
    data = pd.DataFrame(
        [
            [int(v.timestamp() * 1_000_000) if name == "event_timestamp" and v is not None else v
             for name, v in zip(names, row)]
            for row in rows
        ],
        columns=names,
    ).astype({"event_id": "int64", "dataset_id": "Int64", "event_timestamp": "Int64"})
    text = [name for name in names if name not in ("event_id", "dataset_id", "event_timestamp")]
    data[text] = data[text].astype("string")
    con.register("fixture", data)
    return set(con.execute(f"{base.chain(*parts, events=EVENTS)} {select}").fetchall())


def spark_set(df) -> set[tuple]:
    return {tuple(row) for row in df.collect()}
