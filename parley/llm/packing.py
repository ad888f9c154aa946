"""Packing of token sequences along a space-filling curve.

Each document's tokens are hashed into a vector of a few dimensions (signed sums over its token
ids, divided by their number). The place of that vector on a Hilbert curve is its sort key, so
documents with like words become neighbours. Along the curve the documents are laid end to end and
cut every ``length`` tokens: no sequence but the very last is short.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.arrow import small_batches, thrifty
from parley.llm.store import stored
from parley.llm.words import LOWER, SPACE, bytes_of, mix, row_chunks, span_hashes

LENGTH = 4096
DIMENSIONS, BITS = 4, 10
SPREAD = 0.25  # mean signs beyond this are cut off at the border cell
CACHED_WORDS = 1 << 19  # and at most eight ids a word
BATCH_BYTES = 4 << 20
PARTS = 1024  # rows of ids sent at once

_SMALL = np.zeros(256, dtype=bool)
_SMALL[ord("a") : ord("z") + 1] = True
_SYMBOL = np.array([chr(i).isprintable() and not chr(i).isalnum() and chr(i) not in " '" and i < 128 for i in range(256)])
_LETTERS = re.compile("[a-zß-öø-ÿ]+")


def _byte_symbols() -> dict[int, str]:
    """The characters that byte-level models read in place of bytes: printable ones stand for
    themselves, the others for the characters from 256 on, in their order."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


_BYTE_SYMBOLS = _byte_symbols()


def pieces(data: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of some texts (row i is ``own[i]:own[i + 1]``), lower-cased, and the first and last
    places of the pieces that a tokenizer that drops white space treats one by one.

    A piece ends at white space, and between a letter and a symbol other than the apostrophe: that
    leaves fewer different pieces than words. Texts with marks that combine with a letter, or that
    could hold special tokens, are cut at white space only and not lower-cased.
    """
    n = len(data)
    low = LOWER[data]
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[own] = True
    letter = _SMALL[low]
    latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter[1:] |= latin
    between = letter[:-1] & _SYMBOL[data[1:]]
    odd = (data == 0xCC) | (data == 0xCD)
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if odd.any():
        rows = np.zeros(len(own) - 1, dtype=bool)
        rows[np.searchsorted(own, np.flatnonzero(odd), side="right") - 1] = True
        odd = np.repeat(rows, np.diff(own))
        low[odd] = data[odd]
        between &= ~odd[1:]
    cut[1:n] |= between
    before = np.ones(n, dtype=bool)
    before[1:] = ~inside[:-1]
    after = np.ones(n, dtype=bool)
    after[:-1] = ~inside[1:]
    return low, np.flatnonzero(inside & (before | cut[:-1])), np.flatnonzero(inside & (after | cut[1:])) + 1


class WordIds:
    """Token ids of texts, for tokenizers that drop white space and treat words one by one.

    A text's ids are then those of its pieces. Each is encoded when it is first met, and kept, by
    its 64-bit hash, in a table of open addresses; the table is emptied when it holds ``limit``
    pieces or eight times as many ids.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        # Whether a word of letters reaches the model as its bytes, so that it can be asked directly.
        self.direct = all(
            self.tokenizer.encode(w, add_special_tokens=False).ids == self._asked(w.encode())
            for w in ("a", "the", "tokenizer", "zqxj", "s", "re", "é", "straße", "ñandú", "àßÿ")
        )
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(1, dtype=np.uint64)  # 0: free
        self.nth = np.zeros(1, dtype=np.int32)
        self.known = np.zeros(0, dtype=np.uint64)
        self.ends = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype="<u4")

    def _asked(self, word: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word.decode("latin-1").translate(_BYTE_SYMBOLS))]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the pieces, -1 where one is not known."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        mask = len(self.keys) - 1
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            there = self.keys[slot]
            hit = there == hashes[left]
            found[left[hit]] = self.nth[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & mask
        return found

    def _place(self, hashes: np.ndarray, first: int) -> None:
        """Different hashes, none of them in the table, into free slots."""
        mask = len(self.keys) - 1
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[left[free]]
            done = self.keys[slot] == hashes[left]
            self.nth[slot[done]] = first + left[done]
            left, slot = left[~done], (slot[~done] + 1) & mask

    def learn(self, new: list[bytes], hashes: np.ndarray) -> None:
        ids: list = [None] * len(new)
        other = []
        for i, w in enumerate(new):
            if self.direct and _LETTERS.fullmatch(w.decode()):
                ids[i] = self._asked(w)
            else:
                other.append(i)
        found = self.tokenizer.encode_batch([new[i].decode() for i in other], add_special_tokens=False)
        for i, e in zip(other, found, strict=True):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), dtype="<u4", count=int(sizes.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        before = len(self.known)
        self.known = np.concatenate([self.known, hashes])
        if 2 * len(self.known) > len(self.keys):
            size = 1 << (4 * len(self.known)).bit_length()
            self.keys, self.nth = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int32)
            self._place(self.known, 0)
        else:
            self._place(hashes, before)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        own = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        ids, sizes = self.ids_of(np.frombuffer(b"".join(texts), dtype=np.uint8), own)
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]

    def ids_of(self, data: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie side by side, one after the other, and how many each has."""
        if len(self.known) > self.limit or len(self.flat) > 8 * self.limit:
            self.forget()
        low, starts, ends = pieces(data, own)
        hashes = np.maximum(span_hashes(low, starts, ends), np.uint64(1))
        nth = self._find(hashes)
        if (nth < 0).any():
            missing = np.flatnonzero(nth < 0)
            new, at = np.unique(hashes[missing], return_index=True)
            at = missing[at]
            text = low.tobytes()
            self.learn([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], new)
            nth[missing] = self._find(hashes[missing])
        sizes = self.ends[nth + 1] - self.ends[nth]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.flat[np.repeat(self.ends[nth] - (stops - sizes), sizes) + np.arange(total)]
        return ids, np.diff(np.concatenate([[0], stops])[np.searchsorted(starts, own)])


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process, whatever number of tasks it runs."""
    if path not in _known:
        _known.clear()
        _known[path] = WordIds(path)
    return _known[path]


def signs(vocabulary: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A sign for each id and dimension, by hash."""
    at = np.arange(vocabulary * dimensions, dtype=np.uint64)
    return ((mix(at + np.uint64(1)) & np.uint64(1)).astype(np.float32) * 2 - 1).reshape(vocabulary, dimensions)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of cells given as rows of coordinates below 2 ** bits
    (Skilling's transform)."""
    x = [c.astype(np.int64) for c in cells.T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            hit = (x[i] & q) != 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = x[i] ^ t
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    t, q = np.zeros_like(x[0]), top
    while q > 1:
        t = np.where(x[-1] & q, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ t) >> b) & 1)
    return key


def _tokenized(path: str, end_id: int, length: int):
    @thrifty
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = word_ids(path)
        table = signs(max(words.tokenizer.get_vocab_size(), end_id + 1))
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for low, high in row_chunks(offsets):
                own = offsets[low : high + 1]
                ids, sizes = words.ids_of(data[own[0] : own[-1]], own - own[0])
                ids, sizes = np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
                stops = np.cumsum(sizes)
                means = np.add.reduceat(table[ids], stops - sizes, axis=0) / sizes[:, None]
                cells = np.clip((means / SPREAD + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1)
                keys = hilbert_keys(cells.astype(np.int64))
                # A row holds at most ``length`` ids, however long its document.
                parts = -(-sizes // length)
                row = np.repeat(np.arange(high - low), parts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
                at = np.append((stops - sizes)[row] + start, len(ids))  # parts follow each other
                for p in range(0, len(row), PARTS):
                    some = slice(p, p + PARTS)
                    edges = at[p : p + PARTS + 1]
                    held = pa.py_buffer(ids[edges[0] : edges[-1]].tobytes())
                    places = pa.py_buffer(((edges - edges[0]) * 4).astype(np.int32).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(uid + row[some]),
                            batch.column(0).take(pa.array(low + row[some])),
                            pa.array(keys[row[some]]),
                            pa.array(sizes[row[some]]),
                            pa.array(start[some]),
                            pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, places, held]),
                        ],
                        ["uid", "id", "curve", "doc_tokens", "start", "ids"],
                    )
                uid += high - low

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of the same partition before each document."""
    from pyspark import TaskContext

    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        before = total + np.cumsum(n) - n
        total += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.full(len(n), part)), pa.array(before), batch.column(1)],
            ["uid", "part", "before", "doc_tokens"],
        )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = LENGTH,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence: the document's ``id``, ``start`` (its ids
    before the piece), ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens``
    (all of its ids, the end id included), ``sequence_id`` and ``offset`` (place in the sequence).

    ``tokenizer`` is the path of a tokenizer file that drops white space, the same on all
    executors. Documents follow the curve, ties by their place in the input. Every row of ``docs``
    is a document of its own, whether or not ids are NULL or repeat; a NULL or empty text is the
    end id alone. An empty table gives no pieces. Other columns are not read.

    Texts are tokenized once, into a written table of parts of at most ``length`` ids. Only (row,
    key, size) is sorted; sums per range give each document its place, and the parts join that.
    What the driver sees is one number per partition.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    kind = docs.schema[id].dataType
    schema = T.StructType(
        [
            T.StructField("uid", T.LongType()),
            T.StructField("id", kind),
            T.StructField("curve", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    parts = stored(docs.select(id, text).mapInArrow(_tokenized(tokenizer, end_id, length), schema), "tokens")
    order = parts.filter(F.col("start") == 0).select("uid", "doc_tokens", "curve")
    order = order.repartitionByRange("curve", "uid").sortWithinPartitions("curve", "uid")
    order = stored(
        order.select("uid", "doc_tokens").mapInArrow(_running, "uid long, part long, before long, doc_tokens long"),
        "order",
    )
    totals = sorted(order.groupBy("part").agg(F.sum("doc_tokens")).collect())  # one row per partition
    bases = list(accumulate((r[1] for r in totals), initial=0))
    base = spark.createDataFrame(
        [(r[0], b) for r, b in zip(totals, bases, strict=False)], "part long, base long"
    )
    placed = order.join(F.broadcast(base), "part").select("uid", (F.col("base") + F.col("before")).alias("place"))
    at = F.col("place") + F.col("start")
    size = (F.length("ids") / 4).cast("long")
    first, last = F.expr(f"__at div {length}"), F.expr(f"(__at + __size - 1) div {length}")
    low = F.greatest(F.lit(0).cast("long"), F.col("sequence_id") * length - F.col("__at"))
    high = F.least(F.col("__size"), (F.col("sequence_id") + 1) * length - F.col("__at"))
    return (
        parts.join(placed, "uid")
        .withColumns({"__at": at, "__size": size})
        .withColumn("sequence_id", F.explode(F.sequence(first, last)))
        .withColumns({"__low": low, "__high": high})
        .select(
            F.col("id").alias(id),
            (F.col("start") + F.col("__low")).alias("start"),
            (F.col("__high") - F.col("__low")).alias("length"),
            F.expr("substring(ids, cast(__low * 4 + 1 as int), cast((__high - __low) * 4 as int))").alias("ids"),
            "doc_tokens",
            "sequence_id",
            (F.col("__at") + F.col("__low") - F.col("sequence_id") * length).alias("offset"),
        )
    )
