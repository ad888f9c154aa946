"""Exact best inner products by block-at-a-time pruning.

Vectors of integers are laid out in blocks along a space-filling curve. A block has a forward index
(its vectors, one after the other) and, for every dimension, its greatest and least component, the
maxima of the terms "dimension" and "dimension, negated". The sum of a query's components times
these bounds all scores in the block. Each query meets the blocks by descending bound, in rounds of
growing size; blocks whose bound has fallen below the query's k-th best score are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import small_batches
from parley.llm.packing import BITS, DIMENSIONS, hilbert_keys, signs
from parley.llm.store import stored

BLOCK_ROWS, BATCH_ROWS, CHUNK_BLOCKS = 1024, 512, 256
VALUES = 1 << 17  # components in a block, unless one vector has more
ROUNDS = (0, 1, 8, 64, CHUNK_BLOCKS)  # places by bound, within a chunk of blocks
GRID = 16
SALTS = 64

_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` in integers; missing components are 0, results beyond 64 bits are cut to them."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    if most[0] * most[1] * max(d, 1) < 1 << 53:  # exact in doubles
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if not d:
        return np.zeros((len(a), len(b)), np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, _LEAST, _MOST).astype(np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    kinds = (np.int8, np.int16, np.int32, np.int64)
    low, high = x.min(initial=0), x.max(initial=0)
    return x.astype(next(k for k in kinds if np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def _packed(x: np.ndarray) -> bytes:
    """Rows of integers as bytes: item size, number of rows, then the items."""
    x = _narrow(x)
    return np.array([x.itemsize, len(x)], np.int64).tobytes() + x.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    size, n = np.frombuffer(data, np.int64, 2)
    x = np.frombuffer(data, f"i{size}", offset=16)
    return x.reshape(n, len(x) // n if n else 0)


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _curve(vectors: pa.Array) -> pa.Array:
    """Places on a Hilbert curve over four projections of the directions of the vectors."""
    rows = [np.array(v, np.float64) for v in vectors.to_pylist()]
    table = signs(max(map(len, rows), default=1) or 1)
    cells = np.zeros((len(rows), DIMENSIONS))
    for i, v in enumerate(rows):
        cells[i] = v @ table[: len(v)] / max(float(np.linalg.norm(v)), 1.0)
    cells = np.clip((cells + 2) / 4 * (1 << BITS), 0, (1 << BITS) - 1)
    return pa.array(hilbert_keys(cells.astype(np.int64)), pa.int64())


_GROUP = "key long, uids binary, ids array<bigint>, least_id long, x binary, bounds binary"


def _grouped(most: int):
    """Consecutive rows of a sorted partition as blocks of at most ``most`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 33
        uids: list[int] = []
        ids: list[int | None] = []
        rows: list[np.ndarray] = []
        width = 0

        def block() -> pa.RecordBatch:
            x = _padded(rows)
            bounds = np.stack([x.max(axis=0, initial=_LEAST), x.min(axis=0, initial=_MOST)])
            known = [i for i in ids if i is not None]
            values = [[key], [np.array(uids).tobytes()], [ids], [min(known, default=None)], [_packed(x)], [_packed(bounds)]]
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
                ["key", "uids", "ids", "least_id", "x", "bounds"],
            )

        for batch in batches:
            for uid, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = max(width, len(v))
                if rows and (len(rows) == most or wide * (len(rows) + 1) > VALUES):
                    yield block()
                    key, uids, ids, rows, wide = key + 1, [], [], [], len(v)
                uids.append(uid)
                ids.append(i)
                rows.append(np.array(v, np.int64))
                width = wide
        if rows:
            yield block()

    return run


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounds of many blocks in one row, as lists."""
    names = ["chunk", "blocks", "least_ids", "bounds"]

    def chunk(rows):
        keys, least, bounds = (list(c) for c in zip(*rows, strict=True))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip((keys[0], keys, least, bounds), kinds, strict=True)], names
        )

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(rows) == CHUNK_BLOCKS:
                yield chunk(rows)
                rows = []
            rows.append(row)
    if rows:
        yield chunk(rows)


def _known(scores: list[int] | None, ids: list[int | None] | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-th best score and its id of each query of a batch; a NULL id is beyond all others."""
    if scores is None:
        return np.full(n, _LEAST), np.full(n, _MOST)
    return np.array(scores, np.int64), np.array([_MOST if i is None else i for i in ids], np.int64)


def _bounded(low: int, high: int):
    """Which queries of a batch meet which blocks of a chunk in this round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, x, scores, kth_ids, blocks, least, bounds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                queries = _unpacked(x)
                positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
                best = np.empty((len(queries), len(blocks)), np.int64)
                for j, b in enumerate(bounds):
                    maxima, minima = _unpacked(b)
                    up, down = dot(positive, maxima[None])[:, 0], dot(negative, minima[None])[:, 0]
                    total = up + down
                    # What does not fit into 64 bits may be any score.
                    beyond = (up == _MOST) | (down == _MOST) | ((up > 0) & (down > 0) & (total < 0))
                    best[:, j] = np.where(beyond, _MOST, total)
                least_ids = np.array([_MOST if i is None else i for i in least], np.int64)
                order = np.lexsort((np.broadcast_to(least_ids, best.shape), -best), axis=1)[:, low:high]
                bound = np.take_along_axis(best, order, axis=1)
                kth, kth_id = _known(scores, kth_ids, len(queries))
                open_ = (bound > kth[:, None]) | ((bound == kth[:, None]) & (least_ids[order] <= kth_id[:, None]))
                at, place = np.nonzero(open_)
                met = order[at, place]
                by_block = np.argsort(met, kind="stable")
                for part in np.split(by_block, np.flatnonzero(np.diff(met[by_block])) + 1) if len(met) else []:
                    out.append((blocks[met[part[0]]], key, at[part].tolist()))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int32()))],
                ["block", "batch", "picks"],
            )

    return run


_FOUND = "batch long, nth int, query_id long, score long, vec_id long, uid long"


def _scored(k: int):
    """The best rows of a block for each query that meets it, unless they come after its k-th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, picks, q_uids, q_ids, q_x, scores, kth_ids, uids, ids, x in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                own, q_own = np.frombuffer(uids, np.int64), np.frombuffer(q_uids, np.int64)
                places = np.array([_MOST if i is None else i for i in ids], np.int64)
                kth, _ = _known(scores, kth_ids, len(q_own))
                found = dot(_unpacked(q_x)[picks], _unpacked(x))
                for nth, row in zip(picks, found, strict=True):
                    able = np.flatnonzero((own != q_own[nth]) & (row >= kth[nth]))
                    if len(able) > k:
                        able = able[row[able] >= np.partition(row[able], -k)[-k]]
                    able = able[np.lexsort((own[able], places[able], -row[able]))][:k]
                    out += [(key, nth, q_ids[nth], int(row[a]), ids[a], int(own[a])) for a in able]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["batch", "nth", "query_id", "score", "vec_id", "uid"],
            )

    return run


def _with(pairs: DataFrame, table: DataFrame, key: str, other: str) -> DataFrame:
    """Pairs joined with the rows of one side. A row that many pairs ask for is copied to a few
    salted keys, as far as these are asked for."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    asked = pairs.select(key, "salt").distinct()
    return pairs.join(table.join(asked, key), [key, "salt"]).drop("salt")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """For each row for which ``is_query`` is true, its ``k`` best other rows: ``query_id``,
    ``rank`` (int, from 1), ``vec_id`` and ``score``, the inner product of the vectors
    ``floor(scale * component)``. Ties go to the smaller id, NULL after all others; ids are integers.

    A query's own row is no candidate, other rows with the same id or vector are; rows that repeat
    an id are queries of their own. Vectors that are NULL or hold a NULL, NaN or infinite component
    take no part, neither as query nor as candidate. Empty vectors score 0, and of vectors of
    different length the missing components are 0. Fewer than ``k`` candidates give fewer rows, an
    empty table none. Other columns are not read.

    Each round is one join of blocks with batches of queries; equal vectors lie side by side, by id,
    so that after the first of their blocks the others can only tie with greater ids and are left
    out. The driver holds nothing but plans.
    """
    spark = vectors.sparkSession
    small_batches(spark, 4 << 20)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(scale * x.cast("double"))).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = stored(rows.withColumn("curve", F.arrow_udf(_curve, "long")("v")), "vectors")

    def laid_out(some: DataFrame, most: int, name: str) -> DataFrame:
        keys = ["curve", "id", "uid"]
        some = some.repartitionByRange(*keys).sortWithinPartitions("curve", F.col("id").asc_nulls_last(), "uid")
        return stored(some.select("uid", "id", "v").mapInArrow(_grouped(most), _GROUP), name)

    blocks = laid_out(rows, BLOCK_ROWS, "blocks")
    asked = laid_out(rows.filter("asks"), BATCH_ROWS, "queries")
    chunks = blocks.select("key", "least_id", "bounds").mapInArrow(
        _chunked, "chunk long, blocks array<bigint>, least_ids array<bigint>, bounds array<binary>"
    )
    # Every batch meets every chunk in one cell of a grid.
    cell = lambda own: F.pmod(F.xxhash64(own), F.lit(GRID))
    others = F.explode(F.sequence(F.lit(0), F.lit(GRID - 1)))
    chunks = chunks.select("*", cell("chunk").cast("int").alias("column"), others.alias("line"))

    state = asked.select(
        F.col("key").alias("batch"), F.lit(None).cast("array<bigint>").alias("scores"), F.lit(None).cast("array<bigint>").alias("kth_ids")
    )
    queries = asked.select(F.col("key").alias("batch"), F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("x").alias("q_x"))
    candidates = blocks.select(F.col("key").alias("block"), "uids", "ids", "x")
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid"]
    best = None
    for low, high in zip(ROUNDS, ROUNDS[1:], strict=False):
        sides = queries.join(state, "batch")
        spread = sides.select("batch", "q_x", "scores", "kth_ids", cell("batch").cast("int").alias("line"), others.alias("column"))
        met = spread.join(chunks, ["line", "column"]).select("batch", "q_x", "scores", "kth_ids", "blocks", "least_ids", "bounds")
        pairs = stored(met.mapInArrow(_bounded(low, high), "block long, batch long, picks array<int>"), "pairs")
        full = _with(_with(pairs, candidates, "block", "batch"), sides, "batch", "block")
        found = full.select("batch", "picks", "q_uids", "q_ids", "q_x", "scores", "kth_ids", "uids", "ids", "x").mapInArrow(_scored(k), _FOUND)
        found = found if best is None else best.drop("rank").unionByName(found)
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("batch", "nth").orderBy(*order)))
        best = stored(ranked.filter(F.col("rank") <= k), "best")
        # Of queries with fewer than k results so far, any score may still be one.
        last = F.max(F.when(F.col("rank") == k, F.struct("score", "vec_id")))
        kth = best.groupBy("batch", "nth").agg(last.alias("kth"))
        every = asked.select(F.col("key").alias("batch"), F.posexplode("ids").alias("nth", "own")).drop("own")
        kth = every.join(kth, ["batch", "nth"], "left")
        listed = F.array_sort(F.collect_list(F.struct("nth", "kth")))
        state = kth.groupBy("batch").agg(listed.alias("s")).select(
            "batch",
            F.transform("s", lambda s: F.coalesce(s["kth"]["score"], F.lit(int(_LEAST)))).alias("scores"),
            F.transform("s", lambda s: s["kth"]["vec_id"]).alias("kth_ids"),
        )
    return best.select("query_id", "rank", "vec_id", "score")
