"""Chat formatting by minimum-cost role repair.

A legal conversation has at most one system turn, first, and then user and assistant turns in
turn. Each source turn is kept, relabelled, merged into the turn before it, or put after an inserted
empty turn; dynamic programming over the automaton of legal turns finds the cheapest repair.

A step maps costs of the four states to costs of the four states, and such maps compose, so a
conversation of any length is cut into chunks: each chunk becomes one small matrix, the matrices of a
conversation give the states at the chunk borders, and then every chunk is repaired on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages, sorted_groups

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
UNKNOWN = 0
#: Turns that may follow each state.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ROLES = {
    "system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "assistant": ASSISTANT,
    "gpt": ASSISTANT, "bot": ASSISTANT, "ai": ASSISTANT, "model": ASSISTANT,
}
NEVER = 1 << 40
CHUNK_BITS = 10
SCHEMA = "conv_id long, place long, part int, action string, role string, cost int, rendered string"


@dataclass(frozen=True)
class Costs:
    """``name`` labels a turn of unknown role; ``ends`` are the roles a conversation may end with."""

    merge: int = 1
    name: int = 1
    insert: int = 2
    relabel: int = 3
    ends: tuple[int, ...] = (USER, ASSISTANT)


def role_of(text: str | None) -> int:
    return ROLES.get((text or "").strip().lower(), UNKNOWN)


@lru_cache(maxsize=None)
def steps(role: int, costs: Costs) -> dict[tuple[int, int], tuple[int, str, int]]:
    """Cheapest way to spend one turn of ``role``: (state, next state) -> cost, action, inserted role."""
    found: dict[tuple[int, int], tuple[int, str, int]] = {}
    for target in (SYSTEM, USER, ASSISTANT):
        label = 0 if target == role else costs.name if role == UNKNOWN else costs.relabel
        for state in range(4):
            ways = []
            if target in LEGAL[state]:
                ways.append((label, "relabel" if label else "keep", 0))
            if state == target:
                ways.append((label + costs.merge, "relabel+merge" if label else "merge", 0))
            for between in LEGAL[state]:
                if target in LEGAL[between]:
                    ways.append((label + costs.insert, "insert+relabel" if label else "insert", between))
            if ways:
                found[state, target] = min(ways, key=lambda way: way[0])
    return found


def ending(costs: Costs) -> list[tuple[int, int]]:
    """For each state, the cost of ending there and the empty turn that it takes."""
    out = []
    for state in range(4):
        if state in costs.ends:
            out.append((0, 0))
        else:
            follow = [r for r in LEGAL[state] if r in costs.ends]
            out.append((costs.insert, follow[0]) if follow and state else (NEVER, 0))
    return out


def advance(vector: list[int], role: int, costs: Costs) -> tuple[list[int], list[int]]:
    """Costs of the states after one more turn, and the state each came from."""
    best, came = [NEVER] * 4, [0] * 4
    for (state, target), (cost, _, _) in steps(role, costs).items():
        if vector[state] + cost < best[target]:
            best[target], came[target] = vector[state] + cost, state
    return best, came


def chunk_matrix(roles: list[int], costs: Costs) -> list[int]:
    """Cost from every entry state (rows) to every exit state of a chunk, row by row."""
    out: list[int] = []
    for entry in range(4):
        vector = [NEVER] * 4
        vector[entry] = 0
        for role in roles:
            vector, _ = advance(vector, role, costs)
        out += [min(x, NEVER) for x in vector]
    return out


def borders(matrices: Iterator[list[int]], costs: Costs) -> list[int]:
    """States at the borders of a conversation's chunks, from start to end."""
    vector, came = [0, NEVER, NEVER, NEVER], []
    for matrix in matrices:
        best, source = [NEVER] * 4, [0] * 4
        for entry in range(4):
            for exit_ in range(4):
                cost = vector[entry] + matrix[4 * entry + exit_]
                if cost < best[exit_]:
                    best[exit_], source[exit_] = cost, entry
        vector = best
        came.append(source)
    state = min(range(4), key=lambda s: vector[s] + ending(costs)[s][0])
    states = [state]
    for source in reversed(came):
        state = source[state]
        states.append(state)
    return states[::-1]


def repair(roles: list[int], entry: int, leave: int, costs: Costs) -> list[tuple[int, int, str, int]]:
    """Cheapest repair of a chunk between two states: (target, cost, action, inserted) of each turn."""
    vector, history = [NEVER] * 4, []
    vector[entry] = 0
    for role in roles:
        vector, came = advance(vector, role, costs)
        history.append(came)
    out, state = [], leave
    for role, came in zip(reversed(roles), reversed(history)):
        before = came[state]
        cost, action, inserted = steps(role, costs)[before, state]
        out.append((state, cost, action, inserted))
        state = before
    return out[::-1]


def _open(role: int, text: str) -> str:
    return f"<|{NAMES[role]}|>\n{text}\n"


def _safe(text: str | None) -> str:
    """Text in which no turn marker can appear."""
    return (text or "").replace("<|", "< |")


def format_conversations(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``conv_id, place, part, action, role, cost, rendered``: the repaired conversations in pieces.

    ``place`` and ``part`` order the pieces of a conversation; their ``rendered`` texts, one after the
    other, are the formatted chat, and the costs add up to the cheapest repair. There is a piece for
    each source turn and one for each inserted empty turn. A merged turn adds its text to the turn
    before it. Source turns are taken by ``turn`` (nulls last), then role and text, so ties and
    repeated rows have an order and all count as turns. A role is trimmed and lower-cased; a null
    or unknown one may become any role at the lower cost ``name``. A null text is empty. Rows
    without ``conv_id`` form one conversation. Other columns are not read.
    """
    spark = turns.sparkSession
    stages = Stages(spark, "chat")
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]
    # A sort over ranges cuts long conversations across tasks; the row numbers keep the order.
    rows = stages.write(
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").orderBy(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("chunk", F.shiftright("place", CHUNK_BITS)).drop("turn")
    )

    def fold(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        roles = [role_of(r) for r in group.column("role").to_pylist()]
        yield pa.RecordBatch.from_pylist(
            [{"conv_id": key[0], "chunk": key[1], "matrix": chunk_matrix(roles, costs)}],
            schema=pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("matrix", pa.list_(pa.int64()))]),
        )

    matrices = stages.write(
        sorted_groups(
            rows.select("conv_id", "chunk", "place", "role"), ["conv_id", "chunk"], fold,
            "conv_id long, chunk long, matrix array<long>", ["place"],
        )
    )

    def scan(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        states = borders(iter(group.column("matrix").to_pylist()), costs)
        n = len(group)
        yield pa.RecordBatch.from_arrays(
            [group.column("conv_id").combine_chunks(), group.column("chunk").combine_chunks(),
             pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()),
             pa.array([i == n - 1 for i in range(n)])],
            names=["conv_id", "chunk", "entry", "leave", "last"],
        )

    # One small matrix stands for a thousand turns here.
    ends = stages.write(
        sorted_groups(
            matrices, ["conv_id"], scan,
            "conv_id long, chunk long, entry int, leave int, last boolean", ["chunk"],
        )
    ).withColumnsRenamed({"conv_id": "__conv", "chunk": "__chunk"})

    def render(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        entry, leave, last = (group.column(c)[0].as_py() for c in ("entry", "leave", "last"))
        roles = [role_of(r) for r in group.column("role").to_pylist()]
        out = []

        def piece(place: int, part: int, action: str, role: int, cost: int, text: str) -> None:
            out.append((key[0], place, part, action, NAMES[role], cost, text))

        for (target, cost, action, inserted), place, text in zip(
            repair(roles, entry, leave, costs), group.column("place").to_pylist(),
            group.column("text").to_pylist(),
        ):
            if inserted:
                piece(place, 0, "inserted", inserted, costs.insert, _open(inserted, ""))
                cost, action = cost - costs.insert, "relabel" if "relabel" in action else "keep"
            body = f"{_safe(text)}\n" if "merge" in action else _open(target, _safe(text))
            piece(place, 1, action, target, cost, body)
        if last and ending(costs)[leave][1]:
            final = ending(costs)[leave][1]
            piece(place, 2, "inserted", final, costs.insert, _open(final, ""))
        columns = list(zip(*out))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "place", "part", "action", "role", "cost", "rendered"],
        )

    joined = rows.join(
        ends, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("chunk") == F.col("__chunk"))
    ).drop("__conv", "__chunk")
    return sorted_groups(joined, ["conv_id", "chunk"], render, SCHEMA, ["place"])
