"""Repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Which strings of ``LENGTH`` bytes start at two places or more? The corpus is first cut down to
contexts. Each window of ``LENGTH`` bytes has an anchor: the 32-byte gram with the smallest hash in
it, the leftmost if there are several. Neighbouring windows with one anchor at a like distance form
a context; the bytes that all of them hold are its core. Equal windows lie in contexts with equal
cores, so contexts whose core occurs once are done with. Equal contexts are folded into one with a
multiplicity. The rest is dealt into blocks by core, and each part of a block (some whole cores) gets
a suffix array, from which intervals of its Burrows-Wheeler transform are extended backwards, breadth first, a step of bytes
at a time: intervals of strings with a common prefix of 56, 112, ... bytes. An interval that holds
one place is dropped at once; what is left at ``LENGTH`` is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import give_back, small_batches, thrifty
from parley.llm.key_filter import in_filter
from parley.llm.ordered_minhash import asked_for, id_filter
from parley.llm.store import stored
from parley.llm.substrings import FOLDED, _member, fold
from parley.llm.words import BYTE_VALUES, bytes_of, mix, powers, row_chunks, sliding_min

LENGTH = 400
GRAM = 32
STEP = 56  # 7 bytes, doubled three times
SECTION = 1 << 20  # longer texts are cut into sections whose windows start there
BLOCK_BYTES = 1 << 19
HOT_BYTES = 1 << 20
PART_BYTES = 1 << 16  # of a block that are sorted at a time
BATCH_BYTES = 4 << 20  # a task holds several numbers for each byte of a batch

_POSITION = np.uint64((1 << 22) - 1)


class Contexts:
    """The contexts of some rows of text, or of a section of a long one."""

    def __init__(self, data: np.ndarray, own: np.ndarray, length: int, starts_before: int | None = None):
        n = len(data)
        gram = min(GRAM, length)
        half = length // 2
        self.first = self.last = self.row = np.zeros(0, np.int64)
        self.core = self.hash = np.zeros(0, np.uint64)
        if n < length:
            return
        up, down = powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[1:], out=total[1:])

        def hashes(a, b, salt):
            return mix((total[b] - total[a]) * down[a] + salt)

        at = np.arange(n - gram + 1, dtype=np.uint64)
        grams = (mix((total[gram:] - total[: n - gram + 1]) * down[: n - gram + 1]) & ~_POSITION) | at
        anchor = (sliding_min(grams, length - gram + 1) & _POSITION).astype(np.int64)
        starts = np.arange(len(anchor))
        row = np.repeat(np.arange(len(own) - 1), np.diff(own))[: len(anchor)]
        whole = starts + length <= own[1:][row]
        if starts_before is not None:
            whole &= starts < starts_before
        starts, anchor, row = starts[whole], anchor[whole], row[whole]
        if not len(starts):
            return
        far = anchor - starts >= half
        change = np.ones(len(starts), dtype=bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (far[1:] != far[:-1]) | (row[1:] != row[:-1])
        heads = np.flatnonzero(change)
        tails = np.append(heads[1:], len(starts)) - 1
        p, far = anchor[heads], far[heads]
        # All windows with the anchor in their first half hold what follows it; the others what
        # goes before it.
        low = np.where(far, p - half, p)
        high = np.where(far, p + gram, p + length - half + 1)
        self.row, self.first, self.last = row[heads], starts[heads], starts[tails]
        self.core = hashes(low, high, far.astype(np.uint64) + np.uint64(1))
        self.hash = mix(hashes(self.first, self.last + length, (p - self.first).astype(np.uint64)) ^ self.core)


def _contexts(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, Contexts]]:
    """For each chunk its first row, its rows' bounds within it, its bytes, the place of its first
    byte in the row, and its contexts. Long rows come in sections."""
    data, offsets = bytes_of(column)
    for row, last in row_chunks(offsets, SECTION // 4):
        a, b = int(offsets[row]), int(offsets[last])
        if last == row + 1 and b - a > 2 * SECTION:
            for at in range(a, b, SECTION):
                part = data[at : min(b, at + SECTION + length - 1)]
                own = np.array([0, len(part)])
                yield row, own, part, at - a, Contexts(part, own, length, SECTION)
        else:
            part, own = data[a:b], offsets[row : last + 1] - a
            yield row, own, part, 0, Contexts(part, own, length)


def _cores(length: int):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for row, _, _, _, found in _contexts(batch.column(1), length):
                keys.append(found.core)
                owners.append(ids[row + found.row])
            yield fold(np.concatenate(keys), np.concatenate(owners), repeats=True)

    return run


def _asked(length: int):
    """The contexts whose core is asked for: (core, context, doc, start, size, count)."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            parts = []
            for row, own, _, base, found in _contexts(batch.column(1), length):
                wanted = _member(found.core, found.row, batch.column(2), row)
                where = found.row[wanted]
                parts.append(
                    (
                        found.core[wanted], found.hash[wanted], ids[row + where],
                        base + found.first[wanted] - own[where],
                        found.last[wanted] - found.first[wanted] + length,
                    )
                )
            core, context, doc, start, size = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5
            order = np.lexsort((start, doc, context))
            core, context, doc, start, size = (x[order] for x in (core, context, doc, start, size))
            new = np.ones(len(core), dtype=bool)
            new[1:] = (context[1:] != context[:-1]) | (doc[1:] != doc[:-1])
            heads = np.flatnonzero(new)
            counts = np.diff(np.append(heads, len(core)))
            arrays = [core[heads].view(np.int64), context[heads].view(np.int64), doc[heads], start[heads], size[heads], counts]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], ["core", "context", "doc", "start", "size", "n"])

    return run


@thrifty
def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts listed for each text."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(1))
        lists = batch.column(2)
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        core, context, start, size, n = lists.flatten().flatten()
        a = offsets[row] + start.to_numpy()
        texts = [data[x : x + k].tobytes() for x, k in zip(a, size.to_numpy(), strict=True)]
        yield pa.RecordBatch.from_arrays([core, context, n, pa.array(texts, pa.binary())], ["core", "context", "n", "bytes"])


def suffix_array(data: np.ndarray, ends: np.ndarray, deep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes in order, each up to its ``ends`` entry, compared on ``deep`` bytes or more; the
    eight bytes from each place on (zeros past the end); and a number for the ``STEP`` bytes (fewer,
    if the suffix has fewer) from each place on, equal where these are."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    left = ends - np.arange(n)
    eight = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        eight <<= np.uint64(8)
        eight |= padded[k : n + k]
    tail = np.flatnonzero(left < 8)
    eight[tail] &= ~np.uint64(0) << (np.uint64(8) * (8 - left[tail]).astype(np.uint64))
    # Seven bytes, and how many there are: that orders suffixes with zeros at their ends, too.
    key = (eight & ~np.uint64(255)) | np.minimum(left, 7).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(new)
    depth, names = 7, rank
    bits = n.bit_length()
    packed = 3 * bits < 64  # a key with its place is one number, which sorts faster
    places = np.arange(n)
    while depth < deep and not new.all():
        key = rank << bits
        further = max(0, n - depth)
        key[:further] |= np.where(left[:further] > depth, rank[depth:], 0)
        if packed:
            key <<= bits
            key |= places
            key.sort()
            order = key & ((1 << bits) - 1)
            key >>= bits
        else:
            order = np.argsort(key)
            key = key[order]
        np.not_equal(key[1:], key[:-1], out=new[1:])
        rank[order] = np.cumsum(new)
        depth *= 2
        if depth == STEP:
            names = rank.copy()
    return order, eight, names if depth > STEP else rank


def repeated_windows(contexts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context, which of its windows occur twice or more among all; a context counts as
    often as ``counts`` says."""
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    first = np.cumsum(sizes) - sizes
    n = len(data)
    order, eight, names = suffix_array(data, np.repeat(first + sizes, sizes), length)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    del order

    # One window is one chain of suffixes, from its end backwards. LF leads from a suffix to the one
    # STEP bytes before it; the transform holds those bytes, as one number.
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    start = np.repeat(first, windows) + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    weight = counts[owner]
    live = np.arange(len(owner))
    interval = np.zeros(len(owner), dtype=np.int64)
    slot = np.full(n, -1, dtype=np.int64)
    done = 0
    while done < length and len(live):
        step = min(STEP, length - done)
        done += step
        at = start[live] + length - done
        if step == STEP:
            added = [names[at]]
        else:
            added = [eight[at + k] >> np.uint64(8 * max(0, 8 - (step - k))) for k in range(0, step, 8)]
        mapped = place[at]
        slot[mapped] = np.arange(len(live))
        by = slot[np.flatnonzero(slot >= 0)]
        slot[mapped] = -1
        change = np.ones(len(by), dtype=bool)
        change[1:] = interval[by[1:]] != interval[by[:-1]]
        for x in added:
            change[1:] |= x[by[1:]] != x[by[:-1]]
        label = np.cumsum(change) - 1
        several = np.bincount(label, weights=weight[live[by]]) >= 2
        keep = several[label]
        live, interval = live[by][keep], label[keep]
    out = np.zeros(len(owner), dtype=bool)
    out[live] = True
    return np.split(out, np.cumsum(windows)[:-1])


_RANGES = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_RANGES_SQL = "array<struct<first:int,last:int>>"


def _ranges(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _by_core(table: pa.Table) -> Iterator[pa.Table]:
    """A block in parts of about ``PART_BYTES`` of whole cores: equal windows have equal cores."""
    table = table.sort_by("core").select(["core", "context", "n", "bytes"]).combine_chunks()
    core = table["core"].to_numpy()
    ends = np.append(np.flatnonzero(core[1:] != core[:-1]) + 1, len(core))
    total = np.cumsum(pc.binary_length(table["bytes"]).to_numpy())[ends - 1]
    row, done = 0, 0
    while row < len(core):
        nth = min(int(np.searchsorted(total, done + PART_BYTES)), len(ends) - 1)
        yield table.slice(row, int(ends[nth]) - row)
        row, done = int(ends[nth]), int(total[nth])


def _expand(length: int):
    def run(table: pa.Table) -> pa.Table:
        found = []
        for part in _by_core(table):
            flags = repeated_windows(part["bytes"].to_pylist(), part["n"].to_numpy(), length)
            found += [(c, _ranges(f)) for c, f in zip(part["context"].to_pylist(), flags, strict=True) if f.any()]
            del flags
        give_back()
        return pa.table({"context": pa.array([c for c, _ in found], pa.int64()), "ranges": pa.array([r for _, r in found], _RANGES)})

    return run


def _single(length: int):
    """Every window of the contexts by its hash: (key, context, place, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            for c, n, t in zip(batch.column("context").to_pylist(), batch.column("n").to_pylist(), texts, strict=True):
                data = np.frombuffer(t, dtype=np.uint8)
                up, down = powers(len(data) + 1)
                total = np.zeros(len(data) + 1, dtype=np.uint64)
                np.cumsum(BYTE_VALUES[data] * up[1:], out=total[1:])
                keys = mix((total[length:] - total[:-length]) * down[: len(data) - length + 1])
                k = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(k, c)), pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, n))],
                    ["key", "context", "place", "n"],
                )

    return run


_RESULT = pa.struct(
    [
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


_RESULT_SQL = "struct<n_bytes:bigint,n_removed:bigint,spans:array<struct<first:bigint,last:bigint>>,kept:binary>"


def _removal(length: int):
    @F.arrow_udf(_RESULT_SQL)
    def remove(texts: pa.Array, lists: pa.Array) -> pa.Array:
        data, offsets = bytes_of(texts)
        known = [{r["context"]: r["ranges"] for r in x.as_py()} if x.is_valid else {} for x in lists]
        mark = np.zeros(len(data) + 1, dtype=np.int32)
        for row, own, _, base, found in _contexts(texts, length):
            if not any(known[row : row + len(own) - 1]):
                continue
            for r, first, c in zip(found.row, found.first, found.hash.view(np.int64).tolist(), strict=True):
                for x in known[row + r].get(c, ()):
                    at = offsets[row + r] + base + first - own[r]
                    mark[at + x["first"]] += 1
                    mark[at + x["last"] + length] -= 1
        covered = np.cumsum(mark, out=mark)[:-1] > 0
        out = []
        for a, b in zip(offsets, offsets[1:], strict=False):
            own = covered[a:b]
            spans = _ranges(own)
            out.append({"n_bytes": int(b - a), "n_removed": int(own.sum()), "spans": spans, "kept": data[a:b][~own].tobytes() if spans else data[a:b].tobytes()})
        result = pa.array(out, type=_RESULT)
        del data, mark, covered, out
        give_back()
        return result

    return remove


def whole_characters(kept) -> Column:
    """The text of bytes that a cut may have left with parts of characters, without these."""

    @F.arrow_udf("string")
    def decoded(values: pa.Array) -> pa.Array:
        return pa.array([v.as_py().decode("utf-8", "ignore") if v.is_valid else None for v in values], pa.string())

    return decoded(kept)


def _asked_for(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts whose ``doc`` is in ``docs``, and few others, told apart where they lie."""
    ids = docs.select(F.col("doc").alias("id")).distinct()
    return asked_for(texts.withColumnRenamed("doc", "id"), ids).withColumnRenamed("id", "doc")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows of ``docs`` plus a struct ``repeats`` (replacing a column of that name):
    ``n_bytes``, ``n_removed``, ``spans`` (first and last byte of each run removed) and ``kept``
    (the other bytes, joined; binary, as a cut can go through a character).

    A byte is removed if it is in a string of ``length`` UTF-8 bytes that starts at another place
    too, in the same document or in any other; all such places lose it. Strings are judged on the
    input. NULL texts are empty; texts shorter than ``length`` lose nothing. What is removed depends
    on content alone, so NULL or repeated ids and repeated rows need no rule: two equal rows of
    ``length`` bytes remove each other. Rows are numbered for that in a written table; ids are not read. Contexts compare by 64-bit hashes, windows within a block
    by their bytes.

    What a core with very many different contexts has (over ``HOT_BYTES``, as where a common passage
    ends) is too much for one block. Its windows are counted one by one by hash instead, with counts
    combined before the shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    # A row's number is written down once: it stays the same however often the rows are read.
    rows = stored(
        docs.select(F.monotonically_increasing_id().alias("__doc"), F.struct(*docs.drop("repeats").columns).alias("__row")),
        "numbered",
    )
    texts = rows.select(F.col("__doc").alias("doc"), F.col("__row")[text].alias("text"))
    by = Window.partitionBy("key", "salt")
    cores = texts.mapInArrow(_cores(length), FOLDED)
    shared = (
        cores.withColumn("shared", F.col("known") | F.max("known").over(by) | (F.count("*").over(by) > 1))
        .filter("shared")
        .groupBy(F.col("id").alias("doc"))
        .agg(F.collect_set("key").alias("cores"))
    )
    shared = stored(shared, "cores")
    contexts = _asked_for(texts, shared).join(shared, "doc").select("doc", "text", "cores").mapInArrow(
        _asked(length), "core long, context long, doc long, start long, size long, n long"
    )
    contexts = stored(contexts, "contexts")
    folded = contexts.groupBy("core", "context").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc", "start", "size")).alias("at")
    )
    folded = stored(folded.select("core", "context", "n", "at.*"), "folded")
    listed = folded.groupBy("doc").agg(F.collect_list(F.struct("core", "context", "start", "size", "n")).alias("list"))
    cut = _asked_for(texts, folded).join(listed, "doc").select("doc", "text", "list").mapInArrow(
        _cut_out, "core long, context long, n long, bytes binary"
    )
    size = folded.agg(F.sum("size")).first()[0] or 0
    hot = folded.groupBy("core").agg(F.sum("size").alias("size")).filter(F.col("size") > HOT_BYTES).select("core")
    hot = stored(hot, "hot")
    blocks = max(1, size // BLOCK_BYTES)
    kind = f"context long, ranges {_RANGES_SQL}"
    if hot.isEmpty():
        usual, single = cut, None
    else:
        cut = stored(cut, "cut")
        usual = cut.join(hot, "core", "left_anti")
        single = cut.join(hot, "core", "left_semi").select("context", "n", "bytes")
        single = single.mapInArrow(_single(length), "key long, context long, place int, n long")
        often = single.groupBy("key").agg(F.sum("n").alias("all")).filter(F.col("all") > 1).select("key")
        single = single.join(often, "key").groupBy("context").agg(
            F.collect_list(F.struct(F.col("place").alias("first"), F.col("place").alias("last"))).alias("ranges")
        )
    usual = usual.withColumn("block", F.pmod(F.xxhash64("core"), F.lit(blocks)))
    found = usual.groupBy("block").applyInArrow(_expand(length), kind)
    if single is not None:
        found = found.union(single)
    marks = contexts.select("context", "doc").join(found, "context")
    marks = marks.groupBy(F.col("doc").alias("__doc")).agg(F.collect_list(F.struct("context", "ranges")).alias("__marks"))
    marks = stored(marks, "marks")
    # Rows that the filter keeps out have no marks: they stay where they are and lose nothing.
    words = id_filter(marks.select(F.col("__doc").alias("id")))

    @F.arrow_udf("boolean")
    def there(keys: pa.Array) -> pa.Array:
        return pa.array(in_filter(keys.to_numpy().view(np.uint64), words.value))

    rows = rows.withColumn("__there", there(F.xxhash64("__doc")))
    marked = rows.filter("__there").join(marks, "__doc", "left")
    marked = marked.select("__row.*", _removal(length)(F.col("__row")[text], F.col("__marks")).alias("repeats"))
    body = F.coalesce(F.col("__row")[text], F.lit(""))
    whole = F.struct(F.octet_length(body).cast("long"), F.lit(0).cast("long"), F.array(), body.cast("binary"))
    others = rows.filter(~F.col("__there")).select("__row.*", whole.cast(_RESULT_SQL).alias("repeats"))
    return marked.union(others)
