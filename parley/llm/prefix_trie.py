"""The trie of conversation prefixes, from sorted neighbours.

Conversations are sorted by their turns' digests. The longest common prefix (LCP) of two neighbours
is an edge; taken in descending depth, union-find over these edges merges runs of neighbours, and
every merge is a branching node. The nodes between two branchings have the same members.

A sorted partition is cut into blocks of bounded size. Nodes that touch neither end of their block
are complete. The others are prefixes of its first or last row, so the block contracts to these two
rows with what they have gathered at each depth; such rows are again sorted rows, and are merged
the same way across the borders until one small block is left.

Conversations are cut into segments of bounded length, which meet only where all before is equal:
each such group is a trie of its own, and its totals go to the node that it hangs from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import small_batches
from parley.llm.store import stored

PIECE_BYTES = 1 << 16
SALTS = 16
DIGITS = 32

_MOST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Sizes:
    """Numbers of turns: of a segment, of a block, and of what the last task merges at most."""

    segment: int = 1024
    block: int = 1 << 16
    last: int = 1 << 18


def lcp(a: str, b: str) -> int:
    """The number of equal digests at the start."""
    low, high = 0, min(len(a), len(b)) // DIGITS
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * DIGITS : middle * DIGITS] == b[low * DIGITS : middle * DIGITS]:
            low = middle
        else:
            high = middle - 1
    return low


class Run:
    """Neighbouring rows with a common prefix of ``depth`` turns, and what their nodes of each
    depth up to there have gathered so far."""

    __slots__ = ("group", "seq", "tokens", "first", "last", "n", "low", "kids", "leaves", "saved", "whole", "wait")

    def __init__(self, at: int, group: str, seq: str, tokens: list[int], n, low, kids, leaves, saved, whole):
        self.group, self.seq, self.tokens = group, seq, tokens
        self.first = self.last = at
        self.n, self.low, self.kids, self.leaves, self.saved, self.whole = n, low, kids, leaves, saved, whole
        self.wait: list[list[int]] = [[] for _ in n]  # nodes one deeper whose parent is not yet known

    @property
    def depth(self) -> int:
        return len(self.n) - 1

    def cut(self, depth: int) -> None:
        for name in ("n", "low", "kids", "leaves", "saved", "whole", "wait"):
            del getattr(self, name)[depth + 1 :]

    def merge(self, other: Run) -> None:
        """Both have the same depth and common prefix."""
        self.last = other.last
        for name in ("n", "kids", "leaves", "saved"):
            setattr(self, name, [x + y for x, y in zip(getattr(self, name), getattr(other, name), strict=True)])
        self.low = list(map(min, self.low, other.low))
        self.whole = [x or y for x, y in zip(self.whole, other.whole, strict=True)]
        for d, more in enumerate(other.wait):
            if len(more) > len(self.wait[d]):
                self.wait[d], more = more, self.wait[d]
            self.wait[d] += more

    def key(self, depth: int) -> str:
        return hashlib.md5(f"{self.group}/{self.seq[: depth * DIGITS]}".encode()).hexdigest()


class Forest:
    """The nodes of a block of sorted runs. ``outer`` is the number of turns before its segments;
    ``open_ends``: whether the block goes on at its borders; ``later``: whether its rows are
    themselves contracted blocks."""

    def __init__(self, runs: list[Run], outer: int, open_ends: bool, later: bool):
        self.nodes: list[list] = []
        self.outer, self.open_ends, self.later, self.size = outer, open_ends, later, len(runs)
        self.borders = {}
        if open_ends:
            for side, r in {0: runs[0], 1: runs[-1]}.items():
                if side == 0 or len(runs) > 1:
                    # n, low, kids, leaves, saved, whole at each depth
                    self.borders[side] = (r.group, r.seq, r.tokens, [[0, _MOST, 0, 0, 0, None] for _ in r.n])
        edges = [lcp(a.seq, b.seq) if a.group == b.group else -1 for a, b in zip(runs, runs[1:], strict=False)]
        above = list(range(len(runs)))

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = i = above[above[i]]
            return i

        for i in sorted(range(len(edges)), key=lambda i: -edges[i]):
            a, b = find(i), find(i + 1)
            self.lower(runs[a], edges[i])
            self.lower(runs[b], edges[i])
            if edges[i] >= 0:
                runs[a].merge(runs[b])
                above[b] = a
        for i, r in enumerate(runs):
            if above[i] == i:
                self.lower(r, -1)

    def lower(self, run: Run, depth: int) -> None:
        """Ends the run's nodes deeper than ``depth``."""
        if run.depth == depth:
            return
        side = None
        if self.open_ends and (run.first == 0 or run.last == self.size - 1):
            side = 0 if run.first == 0 else 1
        for d in range(run.depth, depth, -1):
            n, low, kids, leaves, saved, whole = (x[d] for x in (run.n, run.low, run.kids, run.leaves, run.saved, run.whole))
            # Below the group's root, children hang from a node of the level above.
            outer = run.group if self.outer and d == 0 else None
            if side is not None:
                self.borders[side][3][d] = [n, low, kids, leaves, saved, whole]
                for at in run.wait[d]:
                    self.nodes[at][9] = outer or run.key(d)
                continue
            leaves = leaves if kids else 1
            saved += (n - 1) * run.tokens[d - 1] if d else 0
            for at in run.wait[d]:
                self.nodes[at][8 if outer is None else 9] = low if outer is None else outer
            key = run.key(d) if self.later else None
            self.nodes.append([d == 0, low, self.outer + d, n, kids, leaves, saved, key, None, None, whole])
            if d:
                run.wait[d - 1].append(len(self.nodes) - 1)
                run.kids[d - 1] += 1
                run.leaves[d - 1] += leaves
                run.saved[d - 1] += saved
        run.cut(depth)


_NODE = pa.struct(
    [("root", pa.bool_()), *((c, pa.int64()) for c in ("low", "depth", "n", "kids", "leaves", "saved")),
     ("key", pa.string()), ("parent", pa.int64()), ("ref", pa.string()), ("whole", pa.string())]
)
_NODE_DDL = (
    "struct<root:boolean,low:bigint,depth:bigint,n:bigint,kids:bigint,leaves:bigint,saved:bigint,"
    "key:string,parent:bigint,ref:string,whole:string>"
)
_AT = pa.struct([*((c, pa.int64()) for c in ("n", "low", "kids", "leaves", "saved")), ("whole", pa.string())])
_BORDER = pa.struct(
    [("block", pa.int64()), ("side", pa.int32()), ("g", pa.string()), ("seq", pa.string()),
     ("tokens", pa.list_(pa.int64())), ("at", pa.list_(_AT))]
)
_BORDER_DDL = (
    "struct<block:bigint,side:int,g:string,seq:string,tokens:array<bigint>,"
    "at:array<struct<n:bigint,low:bigint,kids:bigint,leaves:bigint,saved:bigint,whole:string>>>"
)


def _runs(batches: Iterator[pa.RecordBatch], later: bool) -> Iterator[Run]:
    """Rows of segments, or borders of blocks, as runs of one row each."""
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            group, seq, tokens = row[:3]
            if later:
                at = [[e[c] for e in row[3]] for c in ("n", "low", "kids", "leaves", "saved", "whole")]
            else:
                conv, whole, kids, leaves, saved = row[3:]
                n = len(tokens)
                at = [[1] * (n + 1), [conv] * (n + 1), [0] * n + [kids], [0] * n + [leaves], [0] * n + [saved], [None] * n + [whole]]
            yield Run(0, group, seq, tokens, *at)


def _merged(level: int, later: bool, last: bool, sizes: Sizes):
    """Nodes of the blocks of a sorted partition and, unless ``last``, what its blocks contract to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33

        def ended(runs: list[Run]) -> Iterator[pa.RecordBatch]:
            for i, r in enumerate(runs):
                r.first = r.last = i
            forest = Forest(runs, level * sizes.segment, not last, later)
            names = [f.name for f in _NODE]
            kept = [f.name for f in _AT]
            nodes = [dict(zip(names, n, strict=True)) for n in forest.nodes]
            borders = [
                {"block": block, "side": side, "g": g, "seq": seq, "tokens": tokens, "at": [dict(zip(kept, e, strict=True)) for e in at]}
                for side, (g, seq, tokens, at) in forest.borders.items()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes + [None] * len(borders), _NODE), pa.array([None] * len(nodes) + borders, _BORDER)],
                ["node", "border"],
            )

        runs: list[Run] = []
        turns = 0
        for r in _runs(batches, later):
            # Four rows or more, so that contracting them to two leaves less.
            if len(runs) > 3 and turns >= sizes.block and not last:
                yield from ended(runs)
                runs, turns, block = [], 0, block + 1
            runs.append(r)
            turns += r.depth + 1
        if runs:
            yield from ended(runs)

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the turns of a conversation within a sorted partition."""
    from pyspark import TaskContext

    part, before, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        c = batch.column(0).to_numpy()
        if not len(c):
            continue
        starts = np.concatenate([[0], np.flatnonzero(c[1:] != c[:-1]) + 1])
        sizes = np.diff(starts, append=len(c))
        at = np.arange(len(c)) - np.repeat(starts, sizes)
        if before is not None and c[0] == before:
            at[: sizes[0]] += n
        before, n = c[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(c), part, np.int64)), pa.array(at)], [*batch.schema.names, "part", "at"]
        )


def ordered_turns(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``c``, ``p`` (place in the conversation, from 0), ``digest`` and ``tokens`` of every turn."""
    r, x = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("c"), F.col(turn).alias("t"),
        F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, x)).alias("digest"),
        F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.monotonically_increasing_id().alias("tie"),
    )
    keys = ["c", F.col("t").asc_nulls_first(), "digest", "tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("c", "digest", "tokens")
    rows = stored(rows.mapInArrow(_numbered, "c long, digest string, tokens long, part long, at long"), "turns")
    # A conversation goes on in the next partition only from the end of one to the start of the other.
    ends = rows.groupBy("part").agg(F.min("c").alias("first"), F.max(F.struct("c", "at")).alias("last"))
    events = ends.select(F.explode(F.array(
        F.struct(F.col("first").alias("c"), "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n")),
        F.struct(F.col("last.c").alias("c"), "part", F.lit(1).alias("kind"), (F.col("last.at") + 1).alias("n")),
    )).alias("e")).select("e.*")
    earlier = Window.partitionBy("c").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    bases = events.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter("kind = 0 and base > 0")
    # One row per partition at most.
    placed = rows.join(F.broadcast(bases.select("part", "c", "base")), ["part", "c"], "left")
    return placed.select("c", (F.col("at") + F.coalesce("base", F.lit(0))).alias("p"), "digest", "tokens")


def with_shared_heads(rows: DataFrame, every: int, most: int, part: int = 1024) -> DataFrame:
    """Rebuilt conversations: the first h turns of conversation ``c - c % every``, as far as there
    are any, then the own turns after the first h; h is the CRC-32 of the decimal id modulo
    ``most``. A row (c, NULL, NULL, NULL) stands for every conversation, with turns or without."""
    heads = rows.filter((F.col("p") < most - 1) & (F.col("c") % every == 0)).select(F.col("c").alias("head"), "p", "digest", "tokens")
    listed = heads.groupBy("head").agg(F.sort_array(F.collect_list(F.struct("p", "digest", "tokens"))).alias("turns"))
    convs = rows.filter("p = 0").select(
        "c", (F.crc32(F.col("c").cast("string")) % most).cast("int").alias("h"), (F.col("c") - F.col("c") % every).alias("head")
    )
    taken = F.slice(F.coalesce("turns", F.array().cast(listed.schema["turns"].dataType)), 1, F.col("h"))
    convs = convs.join(listed, "head", "left").select("c", "h", taken.alias("turns"))
    # Joined by conversation and part of it, so that a long conversation is many keys.
    far = rows.filter(f"p > 0 and p % {part} = 0").select("c", F.expr(f"p div {part}").alias("k"))
    sizes = convs.select("c", "h", F.size("turns").alias("taken"))
    shifts = sizes.withColumn("k", F.lit(0).cast("long")).unionByName(far.join(sizes, "c"))
    own = rows.withColumn("k", F.expr(f"p div {part}")).join(shifts, ["c", "k"]).filter("p >= h")
    own = own.select("c", (F.col("p") - F.col("h") + F.col("taken")).alias("d"), "digest", "tokens")
    first = convs.select("c", F.explode("turns").alias("t")).select("c", F.col("t.p").alias("d"), "t.digest", "t.tokens")
    return own.unionByName(first).unionByName(_none(convs))


def _none(convs: DataFrame) -> DataFrame:
    return convs.select(
        "c", F.lit(None).cast("long").alias("d"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("tokens")
    )


def segments(rows: DataFrame, length: int) -> DataFrame:
    """Segments of conversations: ``c``, ``s`` (number), ``seq`` (digests), ``tokens``, ``g`` (key
    of all before), ``whole`` (of all up to here) and ``more`` (whether others follow)."""
    turn = F.when(F.col("d").isNotNull(), F.struct("d", "digest", "tokens"))
    cut = rows.withColumn("s", F.coalesce(F.expr(f"d div {length}"), F.lit(0)).cast("long")).groupBy("c", "s").agg(
        F.sort_array(F.collect_list(turn)).alias("e"),
        F.coalesce(F.bit_xor(F.when(F.col("d").isNotNull(), F.xxhash64("digest", "d"))), F.lit(0)).alias("x"),
        F.coalesce(F.bit_xor(F.when(F.col("d").isNotNull(), F.xxhash64("d", "digest"))), F.lit(0)).alias("y"),
    )
    cut = stored(
        cut.select(
            "c", "s", "x", "y", F.size("e").alias("size"),
            F.array_join(F.transform("e", lambda t: t["digest"]), "").alias("seq"), F.transform("e", lambda t: t["tokens"]).alias("tokens"),
        ),
        "segments",
    )
    own = Window.partitionBy("c").orderBy("s")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    key = lambda w: F.concat_ws(
        "-", F.hex(F.coalesce(F.expr("bit_xor(x)").over(w), F.lit(0))), F.hex(F.coalesce(F.expr("bit_xor(y)").over(w), F.lit(0))),
        F.coalesce(F.sum("size").over(w), F.lit(0)).cast("string"),
    )
    keys = cut.select(
        "c", "s", F.when(F.col("s") == 0, F.lit("")).otherwise(key(before)).alias("g"), key(upto).alias("whole"),
        F.lead("s").over(own).isNotNull().alias("more"),
    )
    return stored(cut.drop("x", "y", "size").join(keys, ["c", "s"]), "keyed-segments")


def _level(rows: DataFrame, below: DataFrame | None, level: int, sizes: Sizes) -> list[DataFrame]:
    """Tables of nodes of the segments of one level; ``below``: totals of the tries that hang from
    conversations' segments here, by their smallest conversation."""
    zero = F.lit(0).cast("long")
    if below is None:
        rows = rows.select("g", "seq", "tokens", "c", "whole", *[zero.alias(n) for n in ("kids", "leaves", "saved")])
    else:
        totals = [F.coalesce(n, zero).alias(n) for n in ("kids", "leaves", "saved")]
        rows = rows.join(below.withColumnRenamed("low", "c"), "c", "left").select("g", "seq", "tokens", "c", "whole", *totals)
    keys = ["g", "seq", "c"]
    kind = f"node {_NODE_DDL}, border {_BORDER_DDL}"
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = [stored(sorted_rows.mapInArrow(_merged(level, False, False, sizes), kind), "trie")]
    last = False
    while not last:
        borders = out[-1].filter("border is not null").select("border.*")
        turns = borders.agg(F.sum(F.size("at"))).first()[0] or 0
        last = turns <= sizes.last
        keys = ["block", "side"]
        parted = borders.repartition(1) if last else borders.repartitionByRange(1 + turns // (4 * sizes.last), *keys)
        parted = parted.sortWithinPartitions(*keys).select("g", "seq", "tokens", "at")
        out.append(stored(parted.mapInArrow(_merged(level, True, last, sizes), kind), "trie"))
    return [t.filter("node is not null").select("node.*") for t in out]


def _lonely_nodes(rows: DataFrame, length: int) -> DataFrame:
    """The nodes of segments that no other conversation shares."""
    n = F.size("tokens")
    at = rows.select("*", F.explode(F.sequence(F.lit(1), n)).alias("i")).filter("i > 0")
    last = F.col("i") == n
    one, none = F.lit(1).cast("long"), F.lit(None)
    return at.select(
        F.lit(False).alias("root"), F.col("c").alias("low"), (F.col("s") * length + F.col("i")).alias("depth"), one.alias("n"),
        F.when(last & ~F.col("more"), 0).otherwise(1).cast("long").alias("kids"), one.alias("leaves"), F.lit(0).cast("long").alias("saved"),
        none.cast("string").alias("key"), F.when(F.col("i") > 1, F.col("c")).alias("parent"), F.when(F.col("i") == 1, F.col("g")).alias("ref"),
        F.when(last, F.col("whole")).alias("whole"),
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ascending ids of each end, joined by commas, in pieces."""
    end, first, ids, size = None, 0, [], 0
    for batch in batches:
        out: list[tuple] = []
        for whole, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (whole != end or size > PIECE_BYTES):
                out.append((end, first, ",".join(ids)))
                ids, size = [], 0
            if not ids:
                end, first = whole, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
        yield pa.RecordBatch.from_pylist([dict(zip(("whole", "first", "ids"), o, strict=True)) for o in out], _PIECES)
    if ids:
        yield pa.RecordBatch.from_pylist([{"whole": end, "first": first, "ids": ",".join(ids)}], _PIECES)


_PIECES = pa.schema([("whole", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
_HASHES = pa.schema([("whole", pa.string()), ("sha", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of the pieces of each end, as a stream."""
    end, h = None, None
    for batch in batches:
        out: list[dict] = []
        for whole, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if h is not None and whole == end:
                h.update(b",")
            else:
                if h is not None:
                    out.append({"whole": end, "sha": h.hexdigest()})
                end, h = whole, hashlib.sha256()
            h.update(ids.encode())
        yield pa.RecordBatch.from_pylist(out, _HASHES)
    if h is not None:
        yield pa.RecordBatch.from_pylist([{"whole": end, "sha": h.hexdigest()}], _HASHES)


def ends_of(cut: DataFrame) -> DataFrame:
    """For each different whole conversation, the digest of the ids that have it. Lists are written
    in pieces by many tasks; only the digest of one list, which is a chain, is one task's work."""
    ends = cut.filter("not more").select("whole", "c").repartitionByRange("whole", "c").sortWithinPartitions("whole", "c")
    parts = ends.mapInArrow(_listed, "whole string, first long, ids string").repartition("whole").sortWithinPartitions("whole", "first")
    return parts.select("whole", "ids").mapInArrow(_hashed, "whole string, sha string")


def prefix_trie(
    turns: DataFrame,
    every: int | None = None,
    most: int = 4,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """One row per node of the trie of conversations; a node is a sequence of turns (role and text)
    that some conversation starts with, the root the empty one: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens`` (summed over
    the subtree, words of the node's last text times members but one) and ``ends_sha256`` (digest of
    the ascending, comma-joined ids of the conversations that end here).

    With ``every``, conversations first get the heads of others (:func:`with_shared_heads`).

    Turns are ordered by number, NULL first, ties by the digest of role and text. NULL roles and
    texts are empty. Repeated rows are turns of their own. Rows with a NULL conversation belong to
    none and take no part. An empty table gives no rows, not even the root. Other columns are not
    read. Turns are told apart by 128-bit digests, sequences over several segments by 128 bits.

    Conversations with many turns are many rows; a prefix of over 1,024 turns that conversations
    share takes one more pass for every 1,024 turns. The driver sees one number per pass.
    """
    small_batches(turns.sparkSession, 4 << 20)
    rows = ordered_turns(turns, conversation, turn, role, text)
    if every:
        rows = with_shared_heads(rows, every, most)
    else:
        rows = rows.withColumnRenamed("p", "d").unionByName(_none(rows.filter("p = 0")))
    cut = segments(rows, sizes.segment)

    tables, below, deepest = [], None, 0
    if cut.agg(F.max("s")).first()[0]:
        later = cut.filter("s > 0")
        members = later.groupBy("g").agg(F.count("*").alias("members"))
        later = stored(later.join(members, "g"), "long-tails")
        lonely, shared = later.filter("members = 1"), later.filter("members > 1")
        tables.append(_lonely_nodes(lonely, sizes.segment))
        deepest = shared.agg(F.max("s")).first()[0] or 0
        names = ("kids", "leaves", "saved")
        single = lonely.select("s", F.col("c").alias("low"), *[F.lit(int(n != "saved")).cast("long").alias(n) for n in names])
        below = single.filter(F.col("s") == deepest + 1).drop("s")
        for level in range(deepest, 0, -1):
            found = _level(shared.filter(F.col("s") == level), below, level, sizes)
            tables += [t.filter("not root") for t in found]
            below = single.filter(F.col("s") == level).drop("s")
            for t in found:
                below = below.unionByName(t.filter("root").select("low", *names))
    tables += _level(cut.filter("s = 0"), below, 0, sizes)
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)

    # Parents that were completed in a later pass, or belong to the segment above.
    known = nodes.filter("key is not null").select(F.col("key").alias("ref"), F.col("low").alias("above"))
    edge = nodes.filter(f"whole is not null and depth > 0 and depth % {sizes.segment} = 0")
    known = known.unionByName(edge.select(F.col("whole").alias("ref"), F.col("low").alias("above")))
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("low", "depth"), F.lit(SALTS)).cast("int"))
    out = salted.join(known, ["ref", "salt"], "left").join(ends_of(cut), "whole", "left")
    return out.select(
        F.col("low").alias("conv_id"), "depth", F.coalesce("parent", "above").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
