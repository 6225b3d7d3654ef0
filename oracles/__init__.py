"""DuckDB SQL that recomputes each registered query independently."""

from oracles import ingest, investigate, stream

SQL: dict[str, str] = {**investigate.SQL, **ingest.SQL, **stream.SQL}
