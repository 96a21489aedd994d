"""Chat formatting with minimum-cost role repair (operator 8).

A legal chat is an optional system message followed by one or more pairs of a user and an assistant message. The
automaton's state is the role of the last message. Every turn either opens a message (under its own role, or
relabelled), or is merged into the message before it; empty messages may be inserted before it and at the end. The
repair of a conversation is the sequence of such choices of least total cost; of equal ones that which goes to the
first state in the order system, user, assistant at the earliest turn where they differ.

Costs of turns are matrices over states, and a stretch of turns is their min-plus product. So conversations are cut
anywhere: turns are sorted over all partitions, each partition sends one matrix for its first and for its last
conversation, and the driver (two small rows for a partition) chains those that go on in the next partition. A
conversation with a third of all turns is as well spread as others.

Repeated rows (equal in all four columns) count once; turns of one number are ordered by role and text. Null turns
come first, null roles are unknown roles, null texts are empty, turns with a null conversation form one conversation.
Conversations have at least one turn, so an empty table gives an empty result. The chat markers inside texts are
broken up by a space, so that no text can open or close a message.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.runtime import settle

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MERGE, INSERT, RELABEL, NAME_UNKNOWN = 2, 3, 4, 1
_INFINITE = 1 << 40
# The roles that may follow each state.
_LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _ways() -> dict[tuple[int, int], tuple[int, tuple[int, ...], bool]]:
    """(cost, empty messages inserted, merged) of the cheapest way to take up a turn as state t after state s.

    Of equal costs, less insertion goes first. Two insertions are enough to get from any state to any other but START.
    """
    found: dict[tuple[int, int], tuple[int, tuple[int, ...], bool]] = {}

    def note(s: int, t: int, cost: int, inserted: tuple[int, ...], merged: bool) -> None:
        if (s, t) not in found or (cost, len(inserted)) < (found[s, t][0], len(found[s, t][1])):
            found[s, t] = (cost, inserted, merged)

    for s in range(4):
        if s != START:
            note(s, s, MERGE, (), True)
        for t in _LEGAL[s]:
            note(s, t, 0, (), False)
            for u in _LEGAL[t]:
                note(s, u, INSERT, (t,), False)
                for v in _LEGAL[u]:
                    note(s, v, 2 * INSERT, (t, u), False)
    return found


WAYS = _ways()


def end_way(state: int) -> tuple[int, tuple[int, ...]]:
    """(cost, empty messages) of ending after a state: a chat ends with an assistant message."""
    missing = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}[state]
    return INSERT * len(missing), missing


END = np.array([end_way(s)[0] for s in range(4)], dtype=np.int64)


def role_number(role: str | None) -> int:
    """1 to 3 for the known roles, 0 for others."""
    return ROLES.index(role) + 1 if role in ROLES else 0


def _matrices() -> np.ndarray:
    out = np.full((4, 4, 4), _INFINITE, dtype=np.int64)
    for role in range(4):
        for (s, t), (cost, _, _) in WAYS.items():
            label = 0 if role == t else RELABEL if role else NAME_UNKNOWN
            out[role, s, t] = cost + label
    return out


COSTS = _matrices()  # by role, state before, state after


def product(roles: list[int]) -> np.ndarray:
    """The cost of a stretch of turns from each state to each state."""
    out = np.where(np.eye(4, dtype=bool), 0, _INFINITE)
    for role in roles:
        out = np.minimum((out[:, :, None] + COSTS[role][None, :, :]).min(axis=1), _INFINITE)
    return out


def path(roles: list[int], after: np.ndarray, entries: list[int]) -> list[list[int]]:
    """For each state before the first turn, the states after every turn; ``after``: least cost from each state on."""
    going = [after]
    for role in reversed(roles[1:]):
        going.append((COSTS[role] + going[-1][None, :]).min(axis=1))
    going.reverse()
    steps = [(COSTS[role] + rest[None, :]).argmin(axis=1).tolist() for role, rest in zip(roles, going, strict=True)]
    out = []
    for state in entries:
        states = []
        for step in steps:
            state = step[state]
            states.append(state)
        out.append(states)
    return out


def _stretches(batches, columns: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """(conversation, its rows in this partition), in order."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in columns), strict=True):
            if rows and row[0] != key:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield key, rows


def _ends(stretches: Iterator) -> Iterator[tuple[int, bool, object, list[tuple]]]:
    """(number, whether it is the last one, conversation, rows) of each stretch of a partition."""
    held, number = None, 0
    for key, rows in stretches:
        if held is not None:
            yield number, False, *held
            number += 1
        held = (key, rows)
    if held is not None:
        yield number, True, *held


def _outline(placed: DataFrame, plan: dict | None) -> list:
    """One row for each partition's first and last stretch: its matrix or, with ``plan``, the exit state of every entry."""
    shared = placed.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        out = []
        known = shared.value
        for number, last, key, rows in _ends(_stretches(batches, ["conv_id", "role_number", "part"])):
            if number and not last:
                continue
            roles, part = [r[1] for r in rows], rows[0][2]
            if known is None:
                values = product(roles).ravel().tolist()
            else:
                values = [states[-1] for states in path(roles, np.array(known[part, number > 0]["after"]), [0, 1, 2, 3])]
            out.append((part, number > 0, key, values))
        names = ["part", "second", "conv_id", "values_"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    rows = placed.select("conv_id", "role_number", "part").mapInArrow(run, "part long, second boolean, conv_id long, values_ array<long>")
    return sorted(rows.collect(), key=lambda r: (r.part, r.second))


def _plan(placed: DataFrame) -> dict:
    """For each partition's first and last stretch: least costs after it, the state before it, and if it begins or ends its chat."""
    rows = _outline(placed, None)
    plan = {}
    for i in reversed(range(len(rows))):
        row, last = rows[i], i + 1 == len(rows) or rows[i + 1].conv_id != rows[i].conv_id
        if last:
            after = END
        else:
            following = plan[rows[i + 1].part, rows[i + 1].second]
            after = (np.array(rows[i + 1].values_).reshape(4, 4) + np.array(following["after"])[None, :]).min(axis=1)
        plan[row.part, row.second] = {"after": after.tolist(), "entry": START, "last": last}
    exits = {(r.part, r.second): r.values_ for r in _outline(placed, plan)}
    for before, row in zip(rows, rows[1:], strict=False):
        if before.conv_id == row.conv_id:
            own = plan[before.part, before.second]
            plan[row.part, row.second]["entry"] = exits[before.part, before.second][own["entry"]]
    return plan


def _piece(state: int, text: str, first: bool, merged: bool) -> str:
    text = text.replace(OPEN, "<| im_start|>").replace(CLOSE, "<| im_end|>")
    if merged:
        return "\n" + text
    return ("" if first else CLOSE + "\n") + OPEN + ROLES[state - 1] + "\n" + text


_SCHEMA = "conv_id long, turn long, step long, place int, role string, action string, rendered string"


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired chats in pieces: a conversation's ``rendered`` in the order of (step, place) is its text.

    step: a number that grows along the conversation (its gaps depend on the partitions); place: 0 and 1 for messages inserted before a turn, 2
    for the turn, 3 to 5 for what follows the last turn; action: keep, relabel, merge, insert or end.
    """
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).distinct()
    number = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")), F.lit(0)).cast("int")
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.withColumn("role_number", number).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("part", F.spark_partition_id().cast("long")).withColumn("at", F.monotonically_increasing_id()))
    shared = conversations.sparkSession.sparkContext.broadcast(_plan(placed))

    def run(batches):
        plan = shared.value
        names = ["conv_id", "turn", "step", "place", "role", "action", "rendered"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        out: list[tuple] = []
        for order_, last, key, turns in _ends(_stretches(batches, ["conv_id", "role_number", "part", "turn", "text", "at"])):
            known = plan[turns[0][2], order_ > 0] if last or not order_ else {"after": END, "entry": START, "last": True}
            roles = [t[1] for t in turns]
            state = known["entry"]
            for row, now in zip(turns, path(roles, np.array(known["after"]), [state])[0], strict=True):
                _, role, _, turn, text, at = row
                _, inserted, merged = WAYS[state, now]
                first = state == START
                for place, empty in enumerate(inserted, start=2 - len(inserted)):
                    out.append((key, turn, at, place, ROLES[empty - 1], "insert", _piece(empty, "", first, False)))
                    first = False
                action = "merge" if merged else "keep" if role == now else "relabel"
                out.append((key, turn, at, 2, ROLES[now - 1], action, _piece(now, text, first, merged)))
                state = now
            if known["last"]:
                for place, empty in enumerate(end_way(state)[1], start=3):
                    out.append((key, turn, at, place, ROLES[empty - 1], "insert", _piece(empty, "", False, False)))
                    state = empty
                out.append((key, turn, at, 5, ROLES[state - 1], "end", CLOSE + "\n"))
            if len(out) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return placed.select("conv_id", "role_number", "part", "turn", "text", "at").mapInArrow(run, _SCHEMA)
