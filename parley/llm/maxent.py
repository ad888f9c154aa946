"""A hashed maximum-entropy language model with a class-factored softmax.

The next token's class is drawn given the words before it, then the token given class and context.
The ``SHORT`` most frequent tokens form classes of ``SLOTS`` by rank; all others are one more class,
which is a binary tree: its leaves are the other ``FREQUENT`` tokens by rank, and hashed classes of
all tokens beyond, in which a token's share is its smoothed count. Features of a
context are hashed: the word before, the two before, and the second and the third before by
themselves (skips); in the tree, the word before and the second before, each with the node. Buckets
and hashed classes grow with the number of different tokens. Each round, every task starts from the same
weights, takes gradient steps over its share of the round's documents, and sends the rows it has
changed; each row is averaged by tokens over the tasks that changed it. The rounds together read
every training document once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.arrow import small_batches
from parley.llm.store import stored
from parley.llm.words import Chunk, mix, word_chunks

SMOOTHING = 0.1
FOLDS = 10
SHORT, SLOTS = 1024, 32
CLASSES = SHORT // SLOTS
BUCKETS, INNER_BUCKETS = 2048, 256
KINDS, INNER_KINDS = 4, 2
TREE_KINDS, TREE_BUCKETS = 2, 1 << 16
TAIL_CLASSES = 1 << 16  # at most; each has about TAIL_SIZE tokens before that
TAIL_SIZE = 64
# Different tokens for each bucket, and how far buckets grow: 100 MB of weights at the most.
TOKENS_EACH, INNER_TOKENS_EACH, TREE_TOKENS_EACH = 512, 8192, 8
GROWTH, INNER_GROWTH, TREE_GROWTH = 32, 16, 64
FREQUENT = 1 << 18  # tokens whose counts go to every task; the other counts are joined
ROUNDS = 3
RATE, TREE_RATE = 0.2, 0.03
STEP = 4096  # tokens of a gradient step
MODEL_PARTS = 16
BLOCK = 16  # weights that are sent together

END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_ABSENT = np.float32(-1e9)
_SURE = 60.0


def held_out(id: str):
    """crc32 of the id as text, modulo ``FOLDS``, is 0; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def tokens_of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of all rows, each row's end included, and the rows' bounds."""
    rows = np.arange(chunk.rows)
    out = np.full(len(chunk.hashes) + chunk.rows, END, dtype=np.uint64)
    out[np.arange(len(chunk.hashes)) + chunk.row_of_word()] = chunk.hashes
    return out, chunk.bounds + np.append(rows, chunk.rows)


def _grown(least: int, growth: int, wanted: int) -> int:
    """A power of 2 times ``least``, up to ``growth`` times, that holds ``wanted`` if it can."""
    size = least
    while size < wanted and size < least * growth:
        size *= 2
    return size


def tail_classes(distinct: int) -> int:
    """The number of hashed classes of the tokens beyond the frequent ones."""
    return _grown(1, TAIL_CLASSES, -(-max(0, distinct - FREQUENT) // TAIL_SIZE))


@dataclass
class Lexicon:
    """Counts of the frequent tokens and sums over all, as every task needs them."""

    hashes: np.ndarray  # ascending
    counts: np.ndarray
    ranks: np.ndarray  # by count, from 0
    total: int
    distinct: int
    # Of the hashed classes of all other tokens: their counts, and how many tokens each has.
    tail_counts: np.ndarray | None = None
    tail_sizes: np.ndarray | None = None
    short: int = field(init=False)

    def __post_init__(self):
        self.short = min(SHORT, len(self.hashes))
        if self.tail_counts is None:
            self.tail_counts = np.array([self.total - int(self.counts.sum())])
            self.tail_sizes = np.array([self.distinct - len(self.hashes)])

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Places in the lexicon, or -1."""
        if not len(self.hashes):
            return np.full(len(tokens), -1)
        last = len(self.hashes) - 1
        at = self._firsts[(tokens >> self._shift).view(np.int64)].astype(np.int64)
        # Hashes are spread evenly, so most are found at once or a few places on.
        behind = np.flatnonzero(self.hashes[at] < tokens)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < tokens[behind]]
        return np.where(self.hashes[at] == tokens, at, -1)

    @cached_property
    def _shift(self) -> np.uint64:
        return np.uint64(63 - (2 * len(self.hashes)).bit_length())

    @cached_property
    def _firsts(self) -> np.ndarray:
        """For each value of the first bits the first place with that or more, or the last place."""
        edges = np.arange(1 << (64 - int(self._shift)), dtype=np.uint64) << self._shift
        return np.minimum(np.searchsorted(self.hashes, edges), len(self.hashes) - 1).astype(np.int32)

    @property
    def base_scale(self) -> float:
        return np.log10(self.total + SMOOTHING * (self.distinct + 1))

    @property
    def buckets(self) -> int:
        return _grown(BUCKETS, GROWTH, self.distinct // TOKENS_EACH)

    @property
    def inner_buckets(self) -> int:
        return _grown(INNER_BUCKETS, INNER_GROWTH, self.distinct // INNER_TOKENS_EACH)

    @property
    def tree_buckets(self) -> int:
        return _grown(TREE_BUCKETS, TREE_GROWTH, self.distinct // TREE_TOKENS_EACH)

    @cached_property
    def tail_scales(self) -> np.ndarray:
        """Smoothed counts of each hashed class, with those of one unknown token in it."""
        return self.tail_counts + SMOOTHING * (self.tail_sizes + 1)

    @cached_property
    def leaves(self) -> np.ndarray:
        """The smoothed count of each leaf: tokens by rank, then the hashed classes."""
        by_rank = np.empty(len(self.counts))
        by_rank[self.ranks] = self.counts
        return np.concatenate([by_rank[self.short :] + SMOOTHING, self.tail_scales])

    def tail_class(self, tokens: np.ndarray) -> np.ndarray:
        return ((tokens >> np.uint64(20)) & np.uint64(len(self.tail_counts) - 1)).astype(np.int64)

    def leaf(self, tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Each token's leaf, or -1 for one of the short list."""
        tail = len(self.hashes) - self.short + self.tail_class(tokens)
        if not len(self.hashes):
            return tail
        return np.where(places < 0, tail, np.maximum(self.ranks[places] - self.short, -1))

    @cached_property
    def tree(self) -> Tree:
        return Tree(self.leaves)


class Tree:
    """A binary tree over leaves in a row: node 1 is the root, nodes 2 n and 2 n + 1 are below n.
    ``bias`` is the log odds of the second branch by smoothed counts."""

    def __init__(self, leaves: np.ndarray):
        self.depth = int(len(leaves) - 1).bit_length()
        n = 1 << self.depth
        mass = np.concatenate([np.zeros(n), leaves, np.zeros(n - len(leaves))])
        for d in range(self.depth - 1, -1, -1):
            a = 1 << d
            mass[a : 2 * a] = mass[2 * a : 4 * a : 2] + mass[2 * a + 1 : 4 * a : 2]
        with np.errstate(divide="ignore", invalid="ignore"):
            odds = np.log(mass[1::2]) - np.log(mass[0::2])
        odds[0] = 0
        self.bias = np.clip(np.nan_to_num(odds), -_SURE, _SURE).astype(np.float32)

    def path(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the root down, each leaf's nodes, and 1 where its way takes the second branch or -1."""
        below = (leaf + (1 << self.depth)) >> np.arange(self.depth - 1, -1, -1)[:, None]
        return below >> 1, ((below & 1) * 2 - 1).astype(np.float32)


class Model:
    """Weights: class scores by feature, scores in a class by feature, their biases, and scores of
    branches by feature and node. ``shapes`` are those of the first four before they grow."""

    shapes = (
        (KINDS, BUCKETS, CLASSES + 1),
        (INNER_KINDS, INNER_BUCKETS * CLASSES, SLOTS),
        (CLASSES + 1,),
        (CLASSES, SLOTS),
    )

    def __init__(self, weights: list[np.ndarray]):
        self.outer, self.inner, self.bias, self.inner_bias, self.branches = weights

    @classmethod
    def grown(cls, lexicon: Lexicon) -> list[tuple[int, ...]]:
        (kinds, n, classes), (inner_kinds, rows, slots), *biases = cls.shapes
        n, rows = n * lexicon.buckets // BUCKETS, rows * lexicon.inner_buckets // INNER_BUCKETS
        return [(kinds, n, classes), (inner_kinds, rows, slots), *biases, (TREE_KINDS, lexicon.tree_buckets)]

    @classmethod
    def unigram(cls, lexicon: Lexicon) -> Model:
        counts = np.zeros(SHORT)
        shown = lexicon.ranks < SHORT
        counts[lexicon.ranks[shown]] = lexicon.counts[shown]
        grid = counts.reshape(CLASSES, SLOTS)
        with np.errstate(divide="ignore"):
            bias = np.log(np.append(grid.sum(1), lexicon.leaves.sum()))
            inner = np.log(grid)
        outer, within, *_, branches = [np.zeros(s, np.float32) for s in cls.grown(lexicon)]
        return cls([outer, within, *(np.maximum(x, _ABSENT).astype(np.float32) for x in (bias, inner)), branches])

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.outer, self.inner, self.bias, self.inner_bias, self.branches]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights])

    @classmethod
    def of(cls, flat: np.ndarray, lexicon: Lexicon) -> Model:
        shapes = cls.grown(lexicon)
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        parts = np.split(flat, ends[:-1])
        return cls([p.reshape(s).astype(np.float32) for p, s in zip(parts, shapes, strict=True)])


@dataclass
class Events:
    """What is to be predicted and from what: target rank (-1: rare), feature buckets, and for rare
    tokens the leaf (-1: none) and the hashes of the tree's features, if that is to go down the tree."""

    rank: np.ndarray
    features: list[np.ndarray]
    inner: list[np.ndarray]
    leaf: np.ndarray | None = None
    contexts: tuple[np.ndarray, ...] = ()
    tree: Tree | None = None

    def slice(self, a: int, b: int) -> Events:
        leaf = None if self.leaf is None else self.leaf[a:b]
        contexts = tuple(c[a:b] for c in self.contexts)
        return Events(self.rank[a:b], [f[a:b] for f in self.features], [f[a:b] for f in self.inner], leaf, contexts, self.tree)


def events(tokens: np.ndarray, bounds: np.ndarray, places: np.ndarray, lexicon: Lexicon) -> Events:
    n = len(tokens)
    since = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    before = []
    for k in (1, 2, 3):
        past = np.full(n, _START, dtype=np.uint64)
        past[k:] = tokens[: n - k] if k < n else past[k:]
        before.append(np.where(since >= k, past, _START))
    one, two, three = before
    contexts = (mix(one + np.uint64(1)), mix(mix(one) + two), mix(two + np.uint64(2)), mix(three + np.uint64(3)))
    features = [(c % np.uint64(lexicon.buckets)).astype(np.int64) for c in contexts]
    inner = [((c >> np.uint64(32)) % np.uint64(lexicon.inner_buckets)).astype(np.int64) for c in (contexts[0], contexts[2])]
    rank = np.where(places >= 0, lexicon.ranks[places] if len(lexicon.ranks) else -1, -1)
    rank = np.where(rank < SHORT, rank, -1)
    return Events(rank, features, inner, lexicon.leaf(tokens, places), (contexts[0], contexts[2]), lexicon.tree)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= np.reciprocal(logits @ np.ones(logits.shape[1], np.float32))[:, None]
    return logits


def _summed(weights: np.ndarray, features: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """The rows of weights that the features name, added up."""
    out = weights[0].take(features[0], axis=0)
    for w, f in zip(weights[1:], features[1:], strict=True):
        out += w.take(f, axis=0)
    out += bias
    return out


def _forward(model: Model, e: Events):
    """Class probabilities for all events; places, classes, rows and slot probabilities of those
    in the short list."""
    outer = _softmax(_summed(model.outer, e.features, model.bias))
    short = np.flatnonzero(e.rank >= 0)
    group = e.rank[short] // SLOTS
    rows = [f[short] * CLASSES + group for f in e.inner]
    inner = _softmax(_summed(model.inner, rows, model.inner_bias.take(group, axis=0)))
    return outer, short, group, rows, inner


def _descend(model: Model, e: Events):
    """For the rare tokens: their places, and for each node on their ways (a row for each level) the
    side taken, its probability, and the buckets of weights."""
    rare = np.flatnonzero(e.rank < 0)
    node, side = e.tree.path(e.leaf[rare])
    shift = np.uint64(65 - model.branches.shape[1].bit_length())
    salt = node.astype(np.uint64) * END
    odds, buckets = e.tree.bias.take(node), []
    for w, c in zip(model.branches, e.contexts, strict=True):
        h = c.take(rare) + salt
        h ^= h >> np.uint64(32)
        h *= _START
        h >>= shift
        buckets.append(h.view(np.int64))
        odds += w.take(buckets[-1])
    odds *= -side
    np.exp(np.minimum(odds, 80, out=odds), out=odds)
    odds += 1
    return rare, side, np.reciprocal(odds, out=odds), buckets


def log_probability(model: Model, e: Events) -> np.ndarray:
    """log10 of each event's probability; of a rare token that of its leaf, or of all rare tokens
    where no leaf is given."""
    out = np.empty(len(e.rank))
    for a in range(0, len(e.rank), STEP):
        part = e.slice(a, a + STEP)
        outer, short, group, _, inner = _forward(model, part)
        cls = np.full(len(part.rank), CLASSES)
        cls[short] = group
        p = np.log10(np.maximum(outer[np.arange(len(cls)), cls], 1e-30).astype(np.float64))
        slot = part.rank[short] % SLOTS
        p[short] += np.log10(np.maximum(inner[np.arange(len(short)), slot], 1e-30).astype(np.float64))
        if part.leaf is not None and len(short) < len(p):
            rare, _, taken, _ = _descend(model, part)
            p[rare] += np.log10(np.maximum(taken.prod(axis=0, dtype=np.float64), 1e-300))
        out[a : a + STEP] = p
    return out


def _added_rows(rows: np.ndarray, gradient: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different rows (below ``size``), ascending, and the sum of each one's gradients."""
    # Numbers of 16 bits are sorted by radix.
    order = np.argsort(rows.astype(np.uint16) if size <= 1 << 16 else rows, kind="stable")
    at = rows[order]
    heads = np.flatnonzero(np.diff(at, prepend=-1))
    nth = np.arange(len(at)) - np.repeat(heads, np.diff(heads, append=len(at)))
    sums = gradient.take(order, axis=0)
    # Neighbours of a row are added, then sums of two, of four: few rows stand more often.
    left, step = np.flatnonzero(nth), 1
    while len(left):
        bits = nth[left] & (2 * step - 1)
        add = left[bits == step]
        sums[add - step] += sums.take(add, axis=0)
        left, step = left[bits == 0], 2 * step
    return at[heads], sums.take(heads, axis=0)


class Trainer:
    """Gradient steps with a rate that falls for each weight by its squared gradients so far."""

    def __init__(self, model: Model):
        self.model = model
        self.seen = [np.full(w.shape, 1.0, np.float32) for w in model.weights]
        self.tokens = 0

    def _update(self, weight: np.ndarray, seen: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        at, g = _added_rows(rows, gradient, len(weight))
        squares = g * g
        squares += seen.take(at, axis=0)
        seen[at] = squares
        np.sqrt(squares, out=squares)
        g /= squares
        g *= np.float32(-RATE)
        g += weight.take(at, axis=0)
        weight[at] = g

    def learn(self, e: Events) -> None:
        for a in range(0, len(e.rank), STEP):
            self.step(e.slice(a, a + STEP))

    def step(self, e: Events) -> None:
        m, s = self.model, self.seen
        self.tokens += len(e.rank)
        outer, short, group, rows, inner = _forward(m, e)
        cls = np.full(len(e.rank), CLASSES)
        cls[short] = group
        outer[np.arange(len(cls)), cls] -= 1
        for k in range(KINDS):
            self._update(m.outer[k], s[0][k], e.features[k], outer)
        self._update(m.bias[None], s[2][None], np.zeros(1, np.int64), outer.sum(axis=0, keepdims=True))
        if len(short):
            inner[np.arange(len(short)), e.rank[short] % SLOTS] -= 1
            for k in range(INNER_KINDS):
                self._update(m.inner[k], s[1][k], rows[k], inner)
            self._update(m.inner_bias, s[3], group, inner)
        if len(short) < len(cls):
            _, side, gradient, buckets = _descend(m, e)
            gradient -= 1
            gradient *= side
            gradient, squares = gradient.ravel(), (gradient * gradient).ravel()
            for k in range(TREE_KINDS):
                at = buckets[k].ravel()
                np.add.at(s[4][k], at, squares)
                np.subtract.at(m.branches[k], at, TREE_RATE * gradient / np.sqrt(s[4][k].take(at)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [tokens_of(c)[0] for c in word_chunks(batch.column(0), lower=True)]
        values, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["token", "n"])


def token_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(token, n): every token's hash and count, each text's end included."""
    return texts.select(text).mapInArrow(_counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _blocks(flat: np.ndarray) -> np.ndarray:
    """The weights as parts of blocks, filled up with zeros."""
    return np.pad(flat, (0, -len(flat) % (MODEL_PARTS * BLOCK))).reshape(MODEL_PARTS, -1, BLOCK)


def _learned(lexicon, start):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = lexicon.value
        trainer = Trainer(Model.of(start.value, words))
        for batch in batches:
            for chunk in word_chunks(batch.column(0), lower=True):
                tokens, bounds = tokens_of(chunk)
                trainer.learn(events(tokens, bounds, words.find(tokens), words))
        if trainer.tokens:
            task, tokens = TaskContext.get().partitionId(), trainer.tokens
            change = trainer.model.flat()
            del trainer
            change -= start.value
            for part, blocks in enumerate(_blocks(change)):
                changed = np.flatnonzero(blocks.any(axis=1))
                yield _sent(part, task, changed, np.full(len(changed), float(tokens)), blocks[changed] * np.float32(tokens))

    return run


def _sent(part: int, task: int, blocks: np.ndarray, tokens: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    whole = [x.tobytes() for x in (blocks.astype(np.int32), tokens.astype(np.float64), weights.astype(np.float32))]
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([task]), *(pa.array([x], pa.binary()) for x in whole)],
        ["part", "task", "blocks", "tokens", "weights"],
    )


def _added(table: pa.Table) -> pa.Table:
    found = [np.frombuffer(x, np.int32) for x in table["blocks"].to_pylist()]
    size = max((int(x[-1]) + 1 for x in found if len(x)), default=0)
    tokens, weights = np.zeros(size), np.zeros((size, BLOCK))
    for at, n, w in zip(found, table["tokens"], table["weights"], strict=True):
        tokens[at] += np.frombuffer(n.as_py(), np.float64)
        weights[at] += np.frombuffer(w.as_py(), np.float32).reshape(-1, BLOCK)
    at = np.flatnonzero(tokens)
    return pa.Table.from_batches([_sent(table["part"][0].as_py(), table["task"][0].as_py() // 64, at, tokens[at], weights[at])])


_PARTS = "part long, task long, blocks binary, tokens binary, weights binary"


def train(texts: DataFrame, lexicon: Lexicon, text: str = "text") -> Model:
    """The weights after all rounds. What comes to the driver is the model, in parts; the tasks'
    weights are added up on the executors, 64 at a time."""
    spark = texts.sparkSession
    words = spark.sparkContext.broadcast(lexicon)
    weights = Model.unigram(lexicon).flat()
    share = texts.withColumn("__round", F.pmod(F.xxhash64(text), F.lit(ROUNDS)))
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast(weights)
        parts = share.filter(F.col("__round") == turn).select(text).mapInArrow(_learned(words, start), _PARTS)
        for _ in range(3):  # up to 64 ** 3 tasks
            parts = parts.groupBy("part", F.expr("task div 64")).applyInArrow(_added, _PARTS)
        change = _blocks(np.zeros_like(weights))
        for r in parts.groupBy("part").applyInArrow(_added, _PARTS).collect():
            tokens = np.frombuffer(r.tokens, np.float64)[:, None]
            change[r.part, np.frombuffer(r.blocks, np.int32)] = np.frombuffer(r.weights, np.float32).reshape(-1, BLOCK) / tokens
        weights = weights + change.ravel()[: len(weights)]
    return Model.of(weights, lexicon)


_SCORED = "uid long, n_tokens long, known long, frequent double, score double, rare array<long>, times array<int>"


def _scored(lexicon, weights, extra: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = lexicon.value
        model = Model.of(weights.value, words)
        uid = TaskContext.get().partitionId() << 33
        logs, scales = np.log10(words.counts + SMOOTHING), np.log10(words.tail_scales)
        for batch in batches:
            for chunk in word_chunks(batch.column(0), lower=True):
                tokens, bounds = tokens_of(chunk)
                sizes, rows = np.diff(bounds), np.arange(chunk.rows)
                places = words.find(tokens)
                hit = places >= 0
                e = events(tokens, bounds, places, words)
                log_count = np.where(hit, logs[places] if len(logs) else 0.0, 0.0)
                score = log_probability(model, e) - np.where(hit, 0.0, scales[words.tail_class(tokens)])
                # Counts of all other tokens are not here: they are listed, and joined later.
                row = np.repeat(rows, sizes)[~hit]
                other = tokens[~hit]
                order = np.lexsort((other, row))
                row, other = row[order], other[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (other[1:] != other[:-1])
                heads = np.flatnonzero(new)
                times = np.diff(np.append(heads, len(row))).astype(np.int32)
                lists = pa.array(np.searchsorted(row[heads], np.arange(chunk.rows + 1)).astype(np.int32))
                place = slice(chunk.first_row, chunk.first_row + chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i + 1)[place] for i in range(extra)]
                    + [
                        pa.array(uid + rows),
                        pa.array(sizes),
                        pa.array(np.add.reduceat(hit, bounds[:-1], dtype=np.int64)),
                        pa.array(np.add.reduceat(log_count, bounds[:-1])),
                        pa.array(np.add.reduceat(score, bounds[:-1])),
                        pa.ListArray.from_arrays(lists, pa.array(other[heads].view(np.int64))),
                        pa.ListArray.from_arrays(lists, pa.array(times)),
                    ],
                    batch.schema.names[1 : extra + 1] + ["uid", "n_tokens", "known", "frequent", "score", "rare", "times"],
                )
                uid += chunk.rows

    return run


def score_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of ``docs`` (columns other than ``id`` are left out): ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed unigrams) and ``score``
    (log10 probability of the text by the model).

    Tokens are the words between white space, A-Z lower-cased, and one end. Documents whose id has
    crc32 (as text) 0 modulo 10 are held out; counts and model are learned from all others, in
    whole. NULL and empty texts are the end alone; a NULL id counts as the empty text, and equal
    ids share a fold. Repeated rows are scored and learned from one by one. With nothing to learn
    from, all tokens are unknown. Tokens are told apart by a 64-bit hash.

    The counts of the ``FREQUENT`` most frequent tokens travel to the tasks, the others are joined
    by token. The model's probabilities add up to 1 over the known tokens and one unknown one in
    each hashed class.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(text).alias("__text"), F.col(id).alias(id), held_out(id).alias("held_out"))
    training = rows.filter(~F.col("held_out")).select("__text")
    counts = stored(token_counts(training, "__text"), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    hashes = top["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    n = top["n"].to_numpy().astype(np.int64)
    classes = tail_classes(distinct)
    tail_counts, tail_sizes = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    if distinct > len(n):
        least, last = int(n[-1]), int(hashes.view(np.int64)[-1])
        tail = counts.filter((F.col("n") < least) | ((F.col("n") == least) & (F.col("token") > last)))
        tail = tail.groupBy(F.shiftrightunsigned("token", 20).bitwiseAND(F.lit(classes - 1)).alias("class"))
        tail = tail.agg(F.sum("n").alias("n"), F.count("*").alias("size")).toArrow()
        at = tail["class"].to_numpy()
        tail_counts[at], tail_sizes[at] = tail["n"].to_numpy(), tail["size"].to_numpy()
    lexicon = Lexicon(hashes[order], n[order], order, total, distinct, tail_counts, tail_sizes)
    model = train(training, lexicon, "__text")

    schema = T.StructType([rows.schema[id], rows.schema["held_out"], *T.StructType.fromDDL(_SCORED)])
    run = _scored(spark.sparkContext.broadcast(lexicon), spark.sparkContext.broadcast(model.flat()), 2)
    scored = stored(rows.mapInArrow(run, schema), "scored")
    listed = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    joined = listed.select("uid", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    joined = joined.join(counts.withColumnRenamed("n", "c"), "token", "left")
    c = F.coalesce("c", F.lit(0))
    others = joined.groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(c + SMOOTHING)).alias("logs"),
        F.sum("times").alias("times"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("also"),
    )
    out = scored.select(id, "held_out", "uid", "n_tokens", "known", "frequent", "score").join(others, "uid", "left")
    logs, times = F.coalesce("logs", F.lit(0.0)), F.coalesce("times", F.lit(0))
    return out.select(
        id,
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("frequent") + logs - F.col("n_tokens") * float(lexicon.base_scale)).alias("base_score"),
        # Tokens without a count here were charged the scale of their hashed class already.
        (F.col("score") + logs).alias("score"),
    )
