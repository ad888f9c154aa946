"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its sequence of five-word shingles, each labelled with its occurrence: the second
"a b c d e" is another symbol than the first. A sample keeps the ``KEPT`` symbols with the smallest
hashes, in the order of the sequence, so two samples agree only where shingles are shared as often
and in the same order. Bands of samples give candidates, and the alignment of both sequences
decides: aligned symbols by all symbols of the two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrow import give_back, small_batches, thrifty
from parley.llm.components import components
from parley.llm.key_filter import in_filter, key_filter
from parley.llm.store import stored
from parley.llm.substrings import FOLDED, fold
from parley.llm.words import Chunk, mix, signed, word_chunks

SHINGLE = 5
SIMILARITY = 0.8
KEPT = 2  # shingles in a sample
ROWS, BANDS = 2, 16  # at similarity 0.8 a sample agrees with 0.64, some band with 0.9998

BATCH_BYTES = 4 << 20  # a task holds several numbers for each byte of a batch
SIZE_CLASS = 1.05
FREQUENT = 8  # documents that have a shingle which is no longer rare
SALTS = 64  # parts in which a large group is named
BITS_PER_ID = 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALTS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64))


def labelled(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shingles that also tell how often their row had them before; the first ones stay."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    own = mix(shingles ^ mix(row * _ODD))
    order = np.argsort(own, kind="stable")
    place = np.arange(len(own))
    first = np.ones(len(own), dtype=bool)
    first[1:] = own[order[1:]] != own[order[:-1]]
    nth = place - np.maximum.accumulate(np.where(first, place, 0))
    again = order[nth > 0]
    out = shingles.copy()
    out[again] = mix(shingles[again] + nth[nth > 0].astype(np.uint64) * _ODD)
    return out


def shingle_sequence(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The labelled shingles of all rows and the rows' bounds; a row of fewer words is one shingle."""
    grams, whole = chunk.grams(SHINGLE)
    counts = chunk.counts
    short = (counts > 0) & (counts < SHINGLE)
    if short.any():
        firsts = chunk.bounds[:-1][short]
        place = np.arange(len(grams)) - np.repeat(chunk.bounds[:-1], counts)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(chunk.hashes + place.astype(np.uint64) * _ODD))])
        grams = grams.copy()
        grams[firsts] = mix(total[chunk.bounds[1:][short]] - total[firsts])
        whole = whole.copy()
        whole[firsts] = True
    sizes = np.where(short, 1, np.maximum(0, counts - (SHINGLE - 1)))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return labelled(grams[whole], bounds), bounds


def sketch(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row with shingles (in order) its ``BANDS`` band keys."""
    bounds = bounds[np.concatenate([[True], np.diff(bounds) > 0])]
    if len(bounds) < 2:
        return np.zeros((0, BANDS), dtype=np.uint64)
    firsts, sizes = bounds[:-1], np.diff(bounds)
    own = mix(shingles)
    end = np.uint64(np.iinfo(np.uint64).max)
    bands = []
    for band in range(BANDS):
        key = np.full(len(sizes), np.uint64(band), dtype=np.uint64)
        for sample in range(ROWS):
            values = mix(own + _SALTS[band * ROWS + sample])
            places = []
            for _ in range(KEPT):
                least = np.minimum.reduceat(values, firsts)
                at = np.flatnonzero(values == np.repeat(least, sizes))
                at = at[np.searchsorted(at, firsts)]
                places.append(at)
                values[at] = end
            for at in np.sort(np.array(places), axis=0):
                key = mix(key * _ODD + own[at])
        bands.append(key)
    return np.stack(bands, axis=1)


_SKETCH = pa.struct([("high", pa.int64()), ("low", pa.int64()), ("bands", pa.list_(pa.int64()))])


def sketch_rows(texts: pa.Array) -> pa.Array:
    """For each text a 128-bit fingerprint of its words, and its band keys (none without words)."""
    parts = []
    for chunk in word_chunks(texts, lower=True):
        place = (np.arange(len(chunk.hashes)) - np.repeat(chunk.bounds[:-1], chunk.counts)).astype(np.uint64)
        marks = []
        for salt in (1, 2):
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(chunk.hashes + place * _ODD + np.uint64(salt)))])
            marks.append(mix(total[chunk.bounds[1:]] - total[chunk.bounds[:-1]] + chunk.counts.astype(np.uint64)))
        shingles, bounds = shingle_sequence(chunk)
        keys = sketch(shingles, bounds)
        lists = np.concatenate([[0], np.cumsum((np.diff(bounds) > 0) * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(lists), pa.array(signed(np.ascontiguousarray(keys).ravel())))
        parts.append(pa.StructArray.from_arrays([pa.array(signed(marks[0])), pa.array(signed(marks[1])), bands], fields=list(_SKETCH)))
        del chunk, shingles, bounds, keys
        give_back()
    return pa.concat_arrays(parts) if parts else pa.array([], type=_SKETCH)


def aligned(a: list[int], b: list[int], band: int) -> int:
    """The most symbols that can be aligned in order with no pair further than ``band`` off the
    diagonal. One bit for each column of the band, all of a row's at once."""
    places: dict[int, list[int]] = {}
    for i, s in enumerate(a):
        places.setdefault(s, []).append(i)
    width = 2 * band + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    row, matched = full, 0
    for j, s in enumerate(b):
        if j:
            matched += not row & 1
            row = (row >> 1) | top
        hits = 0
        for i in places.get(s, ()):
            if 0 <= i - j + band < width:
                hits |= 1 << (i - j + band)
        if hits:
            hits &= row
            row = ((row + hits) | (row - hits)) & full
    return matched + width - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned shingles by all shingles of both sequences; 0 where it is below ``least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    needed = least / (1 + least) * (n + m)
    k = min(n, m)
    unlike = np.flatnonzero(a[:k] != b[:k])
    front = int(unlike[0]) if len(unlike) else k
    rest = k - front
    back = 0
    if rest:
        unlike = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
        back = int(unlike[0]) if len(unlike) else rest
    x, y = a[front : n - back], b[front : m - back]
    if front + back + min(len(x), len(y), len(np.intersect1d(x, y)) + len(x) - len(np.unique(x))) < needed - 1e-9:
        return 0.0
    band = min(max(len(x), len(y)), int(n + m - 2 * needed) + 1)
    total = front + back + aligned(x.tolist(), y.tolist(), band)
    share = total / (n + m - total)
    return share if share >= least else 0.0


def _verify(least: float):
    @F.arrow_udf("double")
    def verify(left: pa.Array, right: pa.Array) -> pa.Array:
        def sequences(texts):
            out = []
            for chunk in word_chunks(texts, lower=True):
                shingles, bounds = shingle_sequence(chunk)
                out += [shingles[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            return out

        pairs = zip(sequences(left), sequences(right), strict=True)
        found = pa.array([similarity(a, b, least) for a, b in pairs], pa.float64())
        del pairs
        give_back()
        return found

    return verify


def _profiled(words):
    """The labelled shingles of the texts that the filter holds, folded by batch."""

    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(batch.column(2).to_numpy().view(np.uint64), words.value)))
            ids = batch.column(0).to_numpy()
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for chunk in word_chunks(batch.column(1), lower=True):
                shingles, bounds = shingle_sequence(chunk)
                keys.append(shingles)
                owners.append(np.repeat(ids[chunk.first_row : chunk.first_row + chunk.rows], np.diff(bounds)))
            yield fold(np.concatenate(keys), np.concatenate(owners), few=FREQUENT)

    return run


def id_filter(ids: DataFrame):
    """A filter over the hashes of the column ``id``, on all workers. It never lacks an id; others
    pass it seldom as long as it is asked for some four million ids at the most."""
    keys = key_filter(ids.select(F.xxhash64("id").alias("key")), BITS_PER_ID)
    return ids.sparkSession.sparkContext.broadcast(keys)


def asked_for(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``id`` is in ``ids``, and few others. They are told apart where they
    lie: no text moves for that."""
    words = id_filter(ids)

    @F.arrow_udf("boolean")
    def there(keys: pa.Array) -> pa.Array:
        return pa.array(in_filter(keys.to_numpy().view(np.uint64), words.value))

    return texts.filter(there(F.xxhash64("id")))


def profiles(ids: DataFrame, texts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """What the shingles of these texts allow.

    First ``id``, ``n`` (its shingles), ``common`` (those that another of these texts has
    too) and ``often`` (those that ``FREQUENT`` of them have), for the ids that can have a partner
    at all: it shares ``least`` of the shingles. Then the rare shared shingles (``key``, ``id``).

    Texts that the filter over the ids lets pass besides are counted like these texts: shingles can
    only seem more common by them, so that more pairs are compared and none is left out.
    """
    rows = texts.select("id", "text", F.xxhash64("id").alias("key")).mapInArrow(_profiled(id_filter(ids)), FOLDED)
    by = Window.partitionBy("key", "salt")
    many = F.col("known") | F.max("known").over(by) | (F.count("*").over(by) >= FREQUENT)
    rows = rows.select("key", "id", many.alias("many"), (F.count("*").over(by) > 1).alias("two"))
    rows = stored(rows.withColumn("two", F.col("two") | F.col("many")), "shingles")
    found = rows.groupBy("id").agg(
        F.count("*").alias("n"), F.count_if("two").alias("common"), F.count_if("many").alias("often")
    )
    found = found.filter(F.col("common") >= least * F.col("n") - 1e-9)
    able = stored(found.join(ids, "id", "left_semi"), "profiles")
    rare = rows.filter(F.col("two") & ~F.col("many")).select("key", "id")
    return able, rare


def _possible(x: str, y: str, least: float, shared: str = "common") -> Column:
    """Whether two texts have enough shared shingles to be similar, whichever these are."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return F.least(f"{x}{shared}", f"{y}{shared}") >= least / (1 + least) * (n + m) - 1e-9


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / np.log(SIZE_CLASS)).cast("int")


def _links(pairs: DataFrame, texts: DataFrame, least: float, name: str) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are similar."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(asked_for(texts.select("id", "text"), stored(asked, "asked")), "wanted")
    both = pairs.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = both.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return stored(both.filter(_verify(least)("left", "right") > 0).select("a", "b"), name)


def _least(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """``rows`` with ``lead``, the least value of all rows of the key. Each part of a key is named by
    itself, so that a key with very many rows is not one task's."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    parts = rows.groupBy(key, "part").agg(F.min(value).alias("least"))
    whole = parts.groupBy(key).agg(F.min("least").alias("lead"))
    return rows.join(parts.join(whole, key).drop("least"), [key, "part"]).drop("part")


def _classes(texts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Of the numbered texts (``id``, ``name``, ``text``): ``id`` and ``name`` with ``lead`` (least
    name and id of the class) for each row, and the leads alone."""
    marked = F.arrow_udf(sketch_rows, "struct<high:bigint,low:bigint,bands:array<bigint>>")
    sketches = texts.select("id", "name", marked("text").alias("s")).select("id", "name", "s.*")
    sketches = stored(sketches.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALTS))), "sketches")
    copies = stored(sketches.groupBy("high", "low", "part").agg(F.min(F.struct("name", "id")).alias("least")), "copies")
    heads = copies.groupBy("high", "low").agg(F.min("least").alias("head"))
    heads = stored(heads.select("high", "low", "head.name", "head.id"), "heads")
    own = sketches.join(heads.select("id"), "id", "left_semi")
    own = own.select("id", F.explode("bands").alias("bucket")).distinct()
    several = own.groupBy("bucket").count().filter(F.col("count") > 1).select("bucket")
    own = stored(own.join(several, "bucket").select("bucket", "id"), "buckets")
    able, rare = profiles(stored(own.select("id").distinct(), "candidates"), texts, least)
    own = own.join(able, "id")
    order = F.struct(-F.col("common") / F.col("n"), F.xxhash64("id"), "id", "n", "common")
    lead = own.groupBy("bucket").agg(F.min(order).alias("l"), F.count("*").alias("size")).filter(F.col("size") > 1)
    lead = lead.select("bucket", F.col("l.id").alias("leader"), F.col("l.n").alias("ln"), F.col("l.common").alias("lcommon"))
    shared = stored(own.join(lead, "bucket"), "shared")

    def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
        pairs = pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
        return pairs.filter(F.col("a") < F.col("b")).distinct()

    first = stored(ordered(shared.filter(_possible("", "l", least)), "id", "leader"), "pairs")
    links = _links(first, texts, least, "links")
    found = components(links)

    named = found.withColumnRenamed("node", "id")
    known = able.join(named, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")
    known = stored(known, "classes")
    rows = shared.select("bucket", "id").join(known, "id")
    sizes = rows.groupBy("bucket", "class").count()
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("count", "class"))["class"].alias("main"), F.count("*").alias("classes"))
    rows = rows.join(mixed.filter(F.col("classes") > 1), "bucket").drop("classes").withColumn("sized", _size_class(F.col("n")))
    rows = stored(rows, "mixed")
    # A partner has at least ``least`` of this one's shingles, and few enough besides.
    low = _size_class(F.greatest(F.lit(1.0), least * F.col("n") - 1))
    high = _size_class(F.greatest(F.lit(1.0), F.col("often") * ((1 + least) / least) - F.col("n") + 1))
    few = rows.filter((F.col("class") != F.col("main")) & (low <= high)).select(
        "bucket", F.col("id").alias("x"), F.col("class").alias("xclass"), F.col("n").alias("xn"),
        F.col("often").alias("xoften"), F.explode(F.sequence(low, high)).alias("sized"),
    )
    pairs = few.join(rows, ["bucket", "sized"]).filter(
        (F.col("class") != F.col("xclass"))
        & ((F.col("class") == F.col("main")) | (F.col("id") < F.col("x")))
        & _possible("", "x", least, "often")
    )
    held = rare.join(known, "id")
    other = held.select("key", *[F.col(c).alias(f"x{c}") for c in known.columns]).withColumnRenamed("xid", "x")
    close = held.join(other, "key").filter(
        (F.col("id") < F.col("x")) & (F.col("class") != F.col("xclass")) & _possible("", "x", least)
    )
    pairs = pairs.select("x", "id").union(close.select("x", "id"))
    second = stored(ordered(pairs, "x", "id").join(first, ["a", "b"], "left_anti"), "pairs")
    if second.isEmpty():
        final = found
    else:
        final = components(links.union(_links(second, texts, least, "links")))
    named = heads.join(final.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    named = stored(_least(named, "component", F.struct("name", "id")).select("high", "low", "lead"), "named")
    parts = copies.join(named, ["high", "low"]).drop("least")
    rows = sketches.drop("bands").join(parts, ["high", "low", "part"]).select("id", "name", "lead")
    return rows, named.select("lead").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``id`` and ``class_id`` (the smallest id of its class) for each row of ``docs``.

    Two documents are linked if their sequences of five-word shingles (words between white space,
    A-Z lower-cased), each labelled with its occurrence, align to at least ``least``: aligned
    shingles by the shingles of both without counting aligned ones twice. So a text and many
    repetitions of it are not alike. A class is what links connect. Documents with the same words are
    one class without further ado; those with fewer than five words are alike only then, and all
    without words (NULL, empty) are one class. Ids are whole numbers. Rows with a NULL id are not
    compared: their class is NULL. Rows with the same id are documents of their own: the texts decide
    their classes, and classes with the same smallest id carry the same ``class_id``
    (:func:`keep_one` tells them apart). An empty table gives no rows.

    Copies are folded first: only one document of equal words goes on. Then every two documents with
    a common bucket are compared, known to be of one class, or known to be too different, without
    pairing off whole buckets:

    * Shingles that no other candidate has cannot be aligned. A document with too many of them for
      any partner goes; and two documents need enough others for the size of both.
    * Each document meets a leader of each of its buckets, the one with the smallest share of such
      shingles: of many near copies of one text, the one most like that text.
    * Two documents of different classes that share a rare shingle meet.
    * Two that share none have only frequent ones in common. In buckets that still hold several
      classes, the documents outside the largest class meet those of other classes for which
      their frequent shingles are enough.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)
    named = docs.select(F.col(id).cast("long").alias("name"), F.col(text).alias("text"))
    texts = named.filter(F.col("name").isNotNull()).withColumn("id", F.monotonically_increasing_id())
    rows, _ = _classes(stored(texts, "texts"), least)
    out = rows.select(F.col("name").alias(id), F.col("lead.name").alias("class_id"))
    unnamed = named.filter(F.col("name").isNull())
    return out.union(unnamed.select("name", F.lit(None).cast("long")))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates: one with the smallest id. Rows with a
    NULL id stay."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    rows = docs.filter(F.col(id).isNotNull()).select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id"))
    rows = stored(rows, "texts")
    texts = rows.select("id", F.col("row")[id].cast("long").alias("name"), F.col("row")[text].alias("text"))
    _, leads = _classes(texts, least)
    kept = rows.join(leads.select("lead.id"), "id", "left_semi").select("row.*")
    return kept.union(docs.filter(F.col(id).isNull()))
