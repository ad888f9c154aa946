"""Minimum-cost repair of the roles in a conversation, and its rendering.

A legal conversation is what an automaton accepts: an optional system turn, then user and assistant
in turn, the assistant last. Each turn is kept, relabelled or merged into the one before, and empty
turns are inserted where needed; of all ways to make the conversation legal the cheapest is taken,
then the one with the fewest turns.

A turn is a small matrix of costs from state to state, and turns in a row are the (min, +) product
of theirs. So a conversation is cut into segments of bounded size, each segment becomes one matrix,
the matrices of a conversation give the state at every cut, and the segments are then resolved each
on its own: a conversation with a third of all rows is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.arrow import small_batches
from parley.llm.store import stored

ROLES = ("system", "user", "assistant")
# States: 0 before the first turn, else 1 + the role of the last turn. Legal next states:
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
MERGE, RELABEL, INSERT = 1, 4, 3  # a relabelled text costs more than an empty turn
SEGMENT_ROWS = 1 << 16

# Costs are kept above the number of turns, which decides between equal costs.
_COST = 1 << 40
_NEVER = 1 << 60


def _paths() -> dict[tuple[int, int], tuple[int, ...]]:
    """The states of the empty turns on the shortest legal way between two states."""
    out: dict[tuple[int, int], tuple[int, ...]] = {}
    for a in NEXT:
        ways: list[tuple[int, ...]] = [(a,)]
        while ways:
            way = ways.pop(0)
            for b in NEXT[way[-1]]:
                if (a, b) not in out:
                    out[a, b] = way[1:]
                    ways.append((*way, b))
    return out


PATHS = _paths()


def _turn(role: int) -> np.ndarray:
    """Costs from state to state of one turn with this role (0: unknown)."""
    m = np.full((4, 4), _NEVER, dtype=np.int64)
    for (a, b), between in PATHS.items():
        m[a, b] = (INSERT * len(between) + RELABEL * (role != b)) * _COST + len(between) + 1
    for s in (1, 2, 3):
        m[s, s] = min(m[s, s], (MERGE + RELABEL * (role != s)) * _COST)
    return m


TURNS = [_turn(r) for r in range(4)]
END = np.array([_NEVER, *((INSERT * (s != FINAL) * (1 + len(PATHS[s, FINAL]))) * _COST for s in (1, 2, 3))])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _NEVER)


def segment_matrix(roles: list[int]) -> np.ndarray:
    m = TURNS[roles[0]]
    for r in roles[1:]:
        m = product(m, TURNS[r])
    return m


def states_at_cuts(matrices: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """The cheapest state before each matrix and after the last, and the turns up to there.

    At each cut the least cost is taken off all states (not the turns), so that what is compared
    stays as small as one segment's, however much the whole conversation costs."""
    costs = [np.array([0, _NEVER, _NEVER, _NEVER], dtype=np.int64)]
    for m in matrices:
        after = np.minimum((costs[-1][:, None] + m).min(axis=0), _NEVER)
        costs.append(np.where(after < _NEVER, after - after.min() // _COST * _COST, _NEVER))
    state = int(np.argmin(np.minimum(costs[-1] + END, _NEVER)))
    states = [state]
    for m, before in zip(reversed(matrices), reversed(costs[:-1]), strict=True):
        state = int(np.argmin(before + m[:, state]))
        states.append(state)
    states.reverse()
    return states, [int(c[s] % _COST) for c, s in zip(costs, states, strict=True)]


def resolve(roles: list[int], entry: int, exit: int, position: int, last: bool) -> list[dict]:
    """What becomes of each turn of a segment, entered and left in these states."""
    costs = [np.full(4, _NEVER, dtype=np.int64)]
    costs[0][entry] = 0
    for r in roles:
        costs.append(np.minimum((costs[-1][:, None] + TURNS[r]).min(axis=0), _NEVER))
    states = [exit]
    for r, before in zip(reversed(roles), reversed(costs[:-1]), strict=True):
        states.append(int(np.argmin(before + TURNS[r][:, states[-1]])))
    states.reverse()
    out = []
    for i, r in enumerate(roles):
        a, b = states[i], states[i + 1]
        between = PATHS.get((a, b), ())
        merge = a == b and a and TURNS[r][a, b] % _COST == 0
        action = "merge" if merge else "keep" if r == b else "relabel"
        inserted = [] if merge else [ROLES[s - 1] for s in between]
        position += 0 if merge else 1 + len(inserted)
        # After the last turn stand the empty ones up to a legal end.
        closing = []
        if last and i == len(roles) - 1 and b != FINAL:
            closing = [ROLES[s - 1] for s in (*PATHS[b, FINAL], FINAL)]
        out.append(
            {"nth": i, "role": ROLES[b - 1], "action": action, "position": position - 1,
             "before": inserted, "after": closing, "last": last and i == len(roles) - 1}
        )
    return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the segments of a sorted partition and the turns in them."""
    from pyspark import TaskContext

    part, segment, nth, before = TaskContext.get().partitionId(), -1, 0, None
    for batch in batches:
        segments, places = [], []
        for c in batch.column(0).to_pylist():
            nth += 1
            if segment < 0 or c != before or nth == SEGMENT_ROWS:
                segment, nth, before = segment + 1, 0, c
            segments.append(segment)
            places.append(nth)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(batch), part)), pa.array(segments, pa.int64()), pa.array(places, pa.int64())],
            [*batch.schema.names, "part", "segment", "nth"],
        )


def _matrix(roles: pa.Array) -> pa.Array:
    return pa.array([segment_matrix(r).ravel().tolist() for r in roles.to_pylist()], pa.list_(pa.int64()))


_CUTS = "array<struct<part:bigint,segment:bigint,entry:int,exit:int,position:bigint,ahead:bigint,last:boolean>>"


def _cuts(parts: pa.Array) -> pa.Array:
    out = []
    for own in parts.to_pylist():
        states, turns = states_at_cuts([np.array(s["matrix"]).reshape(4, 4) for s in own])
        ahead = [0, *accumulate(s["size"] for s in own)]  # turns of the conversation before each segment
        out.append(
            [{"part": s["part"], "segment": s["segment"], "entry": states[i], "exit": states[i + 1],
              "position": turns[i], "ahead": ahead[i], "last": i == len(own) - 1} for i, s in enumerate(own)]
        )
    kind = pa.struct([("part", pa.int64()), ("segment", pa.int64()), ("entry", pa.int32()),
                      ("exit", pa.int32()), ("position", pa.int64()), ("ahead", pa.int64()), ("last", pa.bool_())])
    return pa.array(out, pa.list_(kind))


_TURNS = (
    "array<struct<nth:bigint,role:string,action:string,position:bigint,"
    "before:array<string>,after:array<string>,last:boolean>>"
)
_TURN = pa.struct([("nth", pa.int64()), ("role", pa.string()), ("action", pa.string()), ("position", pa.int64()),
                   ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())), ("last", pa.bool_())])


def _resolved(roles: pa.Array, entry: pa.Array, exit: pa.Array, position: pa.Array, last: pa.Array) -> pa.Array:
    rows = zip(*(x.to_pylist() for x in (roles, entry, exit, position, last)), strict=True)
    return pa.array([resolve(*r) for r in rows], pa.list_(_TURN))


def repair(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per piece of the repaired conversations: the ``conversation`` column, ``position``
    (of the repaired turn, from 0), ``piece`` (order of the pieces at that position: -1,
    then the merged turns' numbers in their conversation, from 0), ``turn`` (the
    input's number; NULL if inserted), ``role``, ``action`` (keep, relabel, merge or insert) and
    ``rendered``. The pieces' ``rendered`` one after the other are the rendered conversation, so no
    row holds more than one input turn.

    Turns are ordered by number, NULL first, ties by role, then by text. Roles are compared without
    regard to case and outer spaces; NULL or other roles cost a relabelling whatever they become.
    NULL texts are empty, and turns with an empty text stay. Rows with a NULL conversation are one
    conversation. Repeated rows are turns of their own. An empty table gives no rows. Other columns
    are not read.
    """
    small_batches(turns.sparkSession)
    number = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.lower(F.trim(F.col(role)))), F.lit(0)).cast("int")
    rows = turns.select(
        F.col(conversation).alias("c"), F.col(turn).alias("t"), F.col(role).alias("r"), number.alias("number"),
        F.coalesce(F.col(text), F.lit("")).alias("x"), F.monotonically_increasing_id().alias("tie"),
    )
    keys = ["c", "t", "r", F.xxhash64("x"), "tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions("c", "t", "r", F.xxhash64("x"), "tie").drop("r", "tie")
    fields = [*rows.schema.fields, *T.StructType.fromDDL("part long, segment long, nth long").fields]
    rows = stored(rows.mapInArrow(_segments, T.StructType(fields)), "turns")

    listed = rows.groupBy("part", "segment").agg(
        F.first("c").alias("c"),
        F.transform(F.array_sort(F.collect_list(F.struct("nth", "number"))), lambda s: s["number"]).alias("roles"),
    )
    listed = stored(listed, "segments")
    matrix, cut, resolved = F.arrow_udf(_matrix, "array<bigint>"), F.arrow_udf(_cuts, _CUTS), F.arrow_udf(_resolved, _TURNS)
    matrices = listed.select("c", F.struct("part", "segment", F.size("roles").alias("size"), matrix("roles").alias("matrix")).alias("s"))
    cuts = matrices.groupBy("c").agg(F.array_sort(F.collect_list("s")).alias("s")).select(F.explode(cut("s")).alias("cut")).select("cut.*")
    decided = (
        listed.join(cuts, ["part", "segment"])
        .select("part", "segment", "ahead", F.explode(resolved("roles", "entry", "exit", "position", "last")).alias("d"))
        .select("part", "segment", "ahead", "d.*")
    )
    both = rows.select("c", "t", "x", "part", "segment", "nth").join(decided, ["part", "segment", "nth"])

    def opened(role, position):
        closed = F.when(position > 0, F.lit("<|im_end|>\n")).otherwise(F.lit(""))
        return F.concat(closed, F.lit("<|im_start|>"), role, F.lit("\n"))

    def piece(position, turn, role, action, rendered):
        order = F.when(action == "merge", F.col("ahead") + F.col("nth"))
        return F.struct(
            position.cast("long").alias("position"), F.coalesce(order, F.lit(-1)).cast("long").alias("order"),
            turn.alias("turn"), role.alias("role"), action.alias("action"), rendered.alias("rendered"),
        )

    nothing = F.lit(None).cast(turns.schema[turn].dataType)
    n_before, n_after = F.size("before"), F.size("after")
    before = F.transform(
        "before",
        lambda r, i: piece(F.col("position") - n_before + i, nothing, r, F.lit("insert"), opened(r, F.col("position") - n_before + i)),
    )
    start = F.when(F.col("action") == "merge", F.lit("\n\n")).otherwise(opened(F.col("role"), F.col("position")))
    end = F.when(F.col("last") & (n_after == 0), F.lit("<|im_end|>\n")).otherwise(F.lit(""))
    own = piece(F.col("position"), F.col("t"), F.col("role"), F.col("action"), F.concat(start, F.col("x"), end))
    after = F.transform(
        "after",
        lambda r, i: piece(
            F.col("position") + 1 + i, nothing, r, F.lit("insert"),
            F.concat(opened(r, F.col("position") + 1 + i), F.when(i == n_after - 1, F.lit("<|im_end|>\n")).otherwise(F.lit(""))),
        ),
    )
    out = both.select("c", F.explode(F.concat(before, F.array(own), after)).alias("p"))
    return out.select(
        F.col("c").alias(conversation), "p.position", F.col("p.order").alias("piece"), F.col("p.turn").alias("turn"),
        F.col("p.role").alias("role"), F.col("p.action").alias("action"), F.col("p.rendered").alias("rendered"),
    )
