"""Chat formatting: minimum-cost repair of role sequences, then rendering."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import materialise

ROLES = ("system", "user", "assistant")
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role of an empty turn to insert before a turn of the second role may follow the state.
INSERTED = {(START, "assistant"): "user", (SYSTEM, "assistant"): "user", (USER, "user"): "assistant", (ASSISTANT, "assistant"): "user"}
LEGAL = {(START, "system"), (START, "user"), (SYSTEM, "user"), (USER, "assistant"), (ASSISTANT, "user")}
FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    name: int = 1  # to give a role to a turn whose role is missing or unknown


def _steps(role: str | None, costs: Costs) -> list[tuple[int, int, int, str, str]]:
    """(state before, state after, cost, role given, action) of one turn: the edges of the automaton."""
    own = (role or "").strip().lower()
    own = ALIASES.get(own, own)
    edges = []
    for before in range(4):
        for given in ROLES:
            price = 0 if given == own else costs.relabel if own in ROLES else costs.name
            after = 1 + ROLES.index(given)
            if (before, given) in LEGAL:
                edges.append((before, after, price, given, ""))
            if before == after:
                edges.append((before, after, price + costs.merge, given, "merge"))
            if (before, given) in INSERTED:
                edges.append((before, after, price + costs.insert, given, "insert"))
    return edges


def _chunk_matrix(roles: list[str | None], costs: Costs) -> np.ndarray:
    """Least cost from each state before the chunk to each state after it."""
    best = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(best, 0)
    for role in roles:
        after = np.full((4, 4), FAR, np.int64)
        for a, b, cost, _, _ in _steps(role, costs):
            np.minimum(after[:, b], best[:, a] + cost, out=after[:, b])
        best = after
    return best


def _trace(roles: list[str | None], costs: Costs, enter: int, leave: int) -> list[tuple[str, str, int]]:
    """(role given, action, state before) of each turn on the first least-cost path between the two states."""
    best = [np.full(4, FAR, np.int64)]
    best[0][enter] = 0
    for role in roles:
        after = np.full(4, FAR, np.int64)
        for a, b, cost, _, _ in _steps(role, costs):
            after[b] = min(after[b], best[-1][a] + cost)
        best.append(after)
    path, state = [], leave
    for at in range(len(roles) - 1, -1, -1):
        for a, b, cost, given, action in _steps(roles[at], costs):
            if b == state and best[at][a] + cost == best[at + 1][b] < FAR:
                path.append((given, action, a))
                state = a
                break
    return path[::-1]


def _end_costs(costs: Costs) -> np.ndarray:
    """A conversation ends after an assistant turn; elsewhere empty turns are inserted."""
    return np.array([0, 2 * costs.insert, costs.insert, 0], np.int64)


def _matrices(costs: Costs):
    def run(batches):
        for batch in batches:
            found = [_chunk_matrix(roles.as_py(), costs).reshape(-1) for roles in batch.column("roles")]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), batch.column("part"), pa.array([list(map(int, m)) for m in found], pa.list_(pa.int64()))], ["conv_id", "chunk", "part", "costs"])

    return run


def _forward(batches):
    """Least cost to reach each state before every chunk; rows come in order, one conversation after the other."""
    conversation, vector, last = object(), None, False
    for batch in batches:
        before, number = [], []
        for conv, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
            if conv != conversation:
                conversation, vector, last = conv, np.array([0, FAR, FAR, FAR], np.int64), -1
            last += 1
            before.append(vector.tolist())
            number.append(last)
            vector = np.minimum((vector[:, None] + np.array(matrix).reshape(4, 4)).min(axis=0), FAR)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.list_(pa.int64())), pa.array(number, pa.int64())], [*batch.schema.names, "before", "number"])


def _backward(costs: Costs):
    """States before and after every chunk on the best path; rows come in reverse order."""

    def run(batches):
        conversation, leave = object(), 0
        for batch in batches:
            enters, leaves, totals, lasts = [], [], [], []
            for conv, matrix, before in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist(), batch.column("before").to_pylist()):
                way = np.array(before)[:, None] + np.array(matrix).reshape(4, 4)
                last = conv != conversation
                if last:
                    conversation = conv
                    leave = int(np.argmin(way.min(axis=0) + _end_costs(costs)))
                enter = int(np.argmin(way[:, leave]))
                enters.append(enter)
                leaves.append(leave)
                lasts.append(last)
                totals.append(int(np.array(matrix).reshape(4, 4)[enter, leave] + (_end_costs(costs)[leave] if last else 0)))
                leave = enter
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), batch.column("part"), batch.column("number"), pa.array(enters, pa.int32()), pa.array(leaves, pa.int32()), pa.array(lasts, pa.bool_()), pa.array(totals, pa.int64())],
                                             ["conv_id", "chunk", "part", "number", "enter", "leave", "is_last", "cost"])

    return run


def _render(costs: Costs):
    def head(role: str, first: bool) -> str:
        return ("" if first else "<|end|>\n") + f"<|{role}|>\n"

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                merged = relabelled = inserted = 0
                pieces = []
                for (given, action, before), role, text in zip(_trace(row["roles"], costs, row["enter"], row["leave"]), row["roles"], row["texts"]):
                    first = before == START
                    own = (role or "").strip().lower()
                    relabelled += given != ALIASES.get(own, own)
                    if action == "merge":
                        merged += 1
                        pieces.append("\n\n" + (text or ""))
                        continue
                    if action == "insert":
                        inserted += 1
                        pieces.append(head(INSERTED[before, given], first))
                        first = False
                    pieces.append(head(given, first) + (text or ""))
                if row["is_last"]:
                    missing = {SYSTEM: ["user", "assistant"], USER: ["assistant"]}.get(row["leave"], [])
                    inserted += len(missing)
                    pieces += [head(role, False) for role in missing] + ["<|end|>\n"]
                out.append((row["conv_id"], row["number"], row["cost"], len(row["roles"]), merged, relabelled, inserted, "".join(pieces)))
            names = ["conv_id", "part", "cost", "n_turns", "n_merged", "n_relabelled", "n_inserted", "rendered"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return run


def repaired_chats(turns: DataFrame, costs: Costs = Costs(), chunk_turns: int = 1024) -> DataFrame:
    """Repair each conversation at least cost, then render it.

    ``turns`` has conv_id, turn, role and text.  A legal conversation is an
    optional system turn, then user and assistant turns in alternation, user
    first, assistant last.  A turn may be joined with the one before it
    (``merge``), get another role (``relabel``; ``name`` if its role is
    missing or unknown), and empty turns may be put in (``insert``).

    Returns conv_id, part, cost, n_turns, n_merged, n_relabelled, n_inserted
    and rendered.  A conversation of up to ``chunk_turns`` turns is one row; a
    longer one has several, whose texts follow each other by ``part`` and
    whose costs add up.  Chunks are solved apart as cost matrices over the
    automaton's states; a pass forward and a pass backward over the matrices
    choose the states between them, so the sum is the least cost of the whole
    and no task holds a whole conversation.

    Turns are ordered by turn (null first), role and text.  Null texts are
    empty; turns with a null conv_id form one conversation.  Repeated rows
    are turns of their own; other columns are ignored; no rows, no result.
    """
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    slim = slim.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-(1 << 62))).cast("long"))
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    slim = slim.withColumn("row", F.row_number().over(Window.partitionBy("conv_id", "chunk").orderBy(*order)))
    slim = slim.withColumn("part", F.floor((F.col("row") - 1) / chunk_turns).cast("long"))
    chunks = slim.groupBy("conv_id", "chunk", "part").agg(F.array_sort(F.collect_list(F.struct("row", "role", "text"))).alias("turns"))
    chunks = materialise(chunks.select("conv_id", "chunk", "part", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts")), "chat-chunks")

    matrices = chunks.select("conv_id", "chunk", "part", "roles").mapInArrow(_matrices(costs), "conv_id long, chunk long, part long, costs array<long>")
    ahead = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "part")
    ahead = ahead.mapInArrow(_forward, "conv_id long, chunk long, part long, costs array<long>, before array<long>, number long")
    back = ahead.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"), F.desc("part"))
    solved = back.mapInArrow(_backward(costs), "conv_id long, chunk long, part long, number long, enter int, leave int, is_last boolean, cost long").alias("s")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("conv_id", "chunk", "part")]
    joined = chunks.alias("c").join(solved, same[0] & same[1] & same[2]).select("c.conv_id", "number", "enter", "leave", "is_last", "cost", "roles", "texts")
    return joined.mapInArrow(_render(costs), "conv_id long, part long, cost long, n_turns int, n_merged int, n_relabelled int, n_inserted int, rendered string")
