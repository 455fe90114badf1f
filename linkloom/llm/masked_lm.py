"""Masked pseudo-likelihood: each word is predicted from the words on both sides.

Words are compared in lower case (A to Z). All words of the corpus are counted. The ``TOP`` most frequent ones are units of the
network; every other word belongs to one of ``TAIL`` buckets by its hash, and its bucket's probability is shared among the
bucket's words by their counts, so the sum over all words counted is 1. Counts of words whose share is ``SHARE`` or more (1 / ``SHARE``
words at most) go to the tasks; those of all rarer words are joined on Spark. A word that the training texts lack counts as seen once.

The network adds up the embeddings of the ``SIDE`` words before and after the gap, one table for each place, takes the hyperbolic
tangent, and predicts in two steps: the class of the missing word (words of like frequency), then the word within its class. Gaps at
the ends of a text see an edge mark.

Every position of every text is trained on once. Texts are dealt by their hash, not by input split, to shards of about ``SHARD_WORDS``
words, whose number follows the corpus; copies of one text are dealt to different shards. Rounds take twice as many shards each, ``FIRST`` in the
first. In a round each shard runs stochastic gradient descent (steps scaled by past gradients) in numpy from the common
parameters, over its texts in the order of their hashes; then parameters are averaged, weighted by words. Sums are of whole numbers,
so neither splits nor the order of tasks change the result. What reaches the driver has the size of the network and the common words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.near_dup import lowered
from linkloom.llm.textcols import Texts, mix, slices, texts_of
from linkloom.session import drop_path, scratch_path, stored

CLASSES = 32
MEMBERS = 32
UNITS = CLASSES * MEMBERS
TAIL = 64
TOP = UNITS - TAIL
SIDE = 2
EDGE = UNITS  # context only
WIDTH = 24
SHARE = 2.0**-21
SHARD_WORDS = 1 << 20
FIRST = 8
MOST_TASKS = 10_000
BATCHES = (256, 4096)  # the batch grows from the one to the other as words are seen
CHUNK_WORDS = 1 << 17
RATE = 0.1
SLICE_BYTES = 1 << 19
BLOCK = 1 << 13
GRAIN = 2.0**20  # parameters are summed as multiples of 1 / GRAIN

SCORED = "doc_id long, key binary, n_tokens long, log_prob double, rare array<struct<word: long, times: int>>"


@dataclass
class Vocabulary:
    """Hashes of the units' words and of all common words, each sorted, with units and logs of counts; ``total``: log of each unit's count."""

    top: np.ndarray
    numbers: np.ndarray
    common: np.ndarray
    log_count: np.ndarray
    total: np.ndarray

    def units(self, words: np.ndarray) -> np.ndarray:
        at, known = _find(self.top, words)
        unit = TOP + tail_bucket(words)
        unit[known] = self.numbers[at[known]]
        return unit

    def log_counts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of each word's count, 0 where it is not a common word, and where it is not."""
        at, known = _find(self.common, words)
        out = np.zeros(len(words))
        out[known] = self.log_count[at[known]]
        return out, ~known


def _find(table: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(table, words), len(table) - 1)
    return at, table[at] == words


def tail_bucket(words: np.ndarray) -> np.ndarray:
    return (mix(words) & np.uint64(TAIL - 1)).astype(np.int64)


def words_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    texts = lowered(texts)
    starts, ends, owner = texts.words()
    return texts.hashes(starts, ends), owner


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word (by hash) occurs in all texts, and its tail bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 * SLICE_BYTES):
            words, n = np.unique(words_of(texts_of(batch.column("text")))[0], return_counts=True)
            yield pa.record_batch(
                {"word": pa.array(words.view(np.int64)), "bucket": pa.array(tail_bucket(words).astype(np.int32)), "n": pa.array(n.astype(np.int64))}
            )

    counted = docs.select("text").where("text is not null").mapInArrow(count, "word long, bucket int, n long")
    return counted.groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, share: float = SHARE) -> tuple[Vocabulary, int]:
    """Units and common words, and the number of all words counted. Only the common words and ``TAIL`` sums come to the driver."""
    sums = np.zeros(TAIL)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        sums[bucket] = n
    words = int(sums.sum())
    common = counts.where(F.col("n") >= share * words).select("word", "n").toArrow()
    hashes, n = common["word"].to_numpy().view(np.uint64), common["n"].to_numpy()
    best = np.lexsort((hashes.view(np.int64), -n))[:TOP]
    np.subtract.at(sums, tail_bucket(hashes[best]), n[best])
    total = np.zeros(UNITS)
    total[: len(best)] = np.log(n[best])
    total[TOP:] = np.log(np.maximum(sums, 1))
    numbers, order = np.argsort(hashes[best]), np.argsort(hashes)
    return Vocabulary(hashes[best][numbers], numbers, hashes[order], np.log(n[order]), total), words


class Network:
    """Parameters in one flat vector: context tables, class weights, member weights and their biases, then their sums of squared gradients.

    A row of a context table has one sum for all of its columns.
    """

    ROWS = 2 * SIDE * (UNITS + 1)
    SHAPES = ((ROWS, WIDTH), (CLASSES, WIDTH + 1), (CLASSES, MEMBERS, WIDTH + 1), (ROWS,), (CLASSES, WIDTH + 1), (CLASSES, MEMBERS, WIDTH + 1))
    PLACES = np.arange(2 * SIDE) * (UNITS + 1)

    def __init__(self, flat: np.ndarray) -> None:
        self.flat, self.parts, at = flat, [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def fresh(cls, seed: int = 3) -> Network:
        sizes = [int(np.prod(s)) for s in cls.SHAPES]
        flat = np.zeros(sum(sizes), np.float32)
        flat[: sizes[0]] = np.random.default_rng(seed).normal(0, 0.1, sizes[0])
        flat[sum(sizes[:3]) :] = 0.1
        return cls(flat)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """One row per gap; the last column is 1, for the biases."""
        out = np.ones((len(context), WIDTH + 1), np.float32)
        total = self.parts[0][context[:, 0] + self.PLACES[0]]
        for k in range(1, 2 * SIDE):
            total += self.parts[0][context[:, k] + self.PLACES[k]]
        np.tanh(total, out=out[:, :WIDTH])
        return out

    def log_probs(self, context: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Log-probability of each unit given its context: that of its class and that within the class."""
        order, group, member, cuts = _by_class(unit)
        hidden = self.hidden(context[order])
        score = _log_softmax(self.parts[1] @ hidden.T, group)
        for c in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[c], cuts[c + 1])
            score[part] += _log_softmax(self.parts[2][c] @ hidden[part].T, member[part])
        out = np.empty(len(unit))
        out[order] = score
        return out

    def step(self, context: np.ndarray, unit: np.ndarray, rate: float = RATE) -> None:
        """One step of gradient descent on the loss of a batch, each parameter's rate by its past gradients."""
        tables, outer, inner, table_squares, outer_squares, inner_squares = self.parts
        order, group, member, cuts = _by_class(unit)
        context = context[order]
        hidden = self.hidden(context)
        error = _softmax_less_one(outer @ hidden.T, group)
        back = error.T @ outer
        slope = np.zeros_like(inner)
        for c in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[c], cuts[c + 1])
            inner_error = _softmax_less_one(inner[c] @ hidden[part].T, member[part])
            back[part] += inner_error.T @ inner[c]
            np.matmul(inner_error, hidden[part], out=slope[c])
        _descend(outer, outer_squares, error @ hidden, rate)
        _descend(inner, inner_squares, slope, rate)
        back = back[:, :WIDTH] * (1 - hidden[:, :WIDTH] ** 2)
        keys = (context + self.PLACES).ravel(order="F").astype(np.int16)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        slope, rows = np.add.reduceat(back[order % len(back)], starts, axis=0), keys[starts]
        table_squares[rows] += (slope * slope).mean(1)
        tables[rows] -= np.float32(rate) * slope / np.sqrt(table_squares[rows])[:, None]


def _descend(weights: np.ndarray, squares: np.ndarray, slope: np.ndarray, rate: float) -> None:
    squares += slope * slope
    weights -= np.float32(rate) * slope / np.sqrt(squares)


def _by_class(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by class, classes and members in that order, and where each class begins."""
    group = (unit // MEMBERS).astype(np.int8)
    order = np.argsort(group, kind="stable")
    return order, group[order], (unit % MEMBERS)[order], np.searchsorted(group[order], np.arange(CLASSES + 1))


def _softmax_less_one(x: np.ndarray, true: np.ndarray) -> np.ndarray:
    """Probabilities down each column, less 1 at the true row."""
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    x[true, np.arange(x.shape[1])] -= 1
    return x


def _log_softmax(x: np.ndarray, true: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    return x[true, np.arange(x.shape[1])] - np.log(np.exp(x).sum(0))


def contexts(unit: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Units around the positions ``at``; beyond the ends of a text stands the edge mark."""
    out = np.full((len(at), 2 * SIDE), EDGE, np.int64)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        place = at + shift
        inside = (place >= 0) & (place < len(unit))
        inside[inside] = owner[place[inside]] == owner[at[inside]]
        out[inside, k] = unit[place[inside]]
    return out


class Learner:
    """Trains a network on texts given one by one; ``seen`` words went before."""

    def __init__(self, flat: np.ndarray, seen: int) -> None:
        self.network, self.seen, self.words = Network(flat.copy()), seen, 0
        self.texts: list[np.ndarray] = []
        self.held = 0

    def add(self, unit: np.ndarray, copies: int) -> None:
        for _ in range(copies):
            self.texts.append(unit)
            self.held += len(unit)
            if self.held >= CHUNK_WORDS:
                self.flush()

    def flush(self) -> None:
        if self.held:
            unit = np.concatenate(self.texts).astype(np.int64)
            owner = np.repeat(np.arange(len(self.texts)), [len(t) for t in self.texts])
            at = np.random.default_rng(self.held).permutation(len(unit))
            context, unit = contexts(unit, owner, at), unit[at]
            k = 0
            while k < len(unit):
                size = int(np.clip((self.seen + k) // 64, *BATCHES))
                self.network.step(context[k : k + size], unit[k : k + size])
                k += size
            self.seen += len(unit)
            self.words += len(unit)
        self.texts, self.held = [], 0


def dealt_texts(docs: DataFrame, vocabulary: Vocabulary, shards: int) -> DataFrame:
    """Texts as units (two bytes a word) with their shard, the round that takes it, and how many copies stand there."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in slices(batches, "text", SLICE_BYTES):
            words, owner = words_of(texts_of(batch.column("text")))
            unit = vocab.units(words).astype(np.int16)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            packed = pa.array([unit[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
            yield pa.record_batch({"key": batch.column("key"), "units": packed})

    texts = docs.where("text is not null").select(F.unhex(F.md5("text")).alias("key"), "text").mapInArrow(encode, "key binary, units binary")
    single = texts.groupBy("key").agg(F.first("units").alias("units"), F.count("*").alias("n"))
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n"), F.lit(shards)) - 1))
    spread = single.select("key", "units", "n", places.alias("i")).select(
        "key", "units", F.pmod(F.xxhash64("key") + F.col("i"), F.lit(shards)).alias("shard"), F.ceil((F.col("n") - F.col("i")) / shards).cast("int").alias("copies")
    )
    return spread.withColumn("round", F.length(F.bin(F.floor(F.col("shard") / FIRST) + 1)) - 1)


def train_round(texts: DataFrame, network: Network, shards: int, seen: int) -> Network:
    """Shards train apart, each in one task; their parameters are averaged by the words trained on."""
    shared = texts.sparkSession.sparkContext.broadcast(network.flat)
    tasks = min(shards, MOST_TASKS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight, now, own = np.zeros(len(shared.value)), 0, None, None

        def finish() -> None:
            nonlocal total, weight
            if own is not None:
                own.flush()
                n = -(-own.words // 256)
                total += np.rint(own.network.flat * GRAIN) * n
                weight += n

        for batch in batches:
            for shard, units, copies in zip(batch.column("shard").to_pylist(), batch.column("units"), batch.column("copies").to_pylist()):
                if shard != now:
                    finish()
                    now, own = shard, Learner(shared.value, seen)
                own.add(np.frombuffer(units.as_buffer(), np.int16), copies)
        finish()
        if weight:
            yield _blocks(total, weight)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for block, n, values in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "v"))):
                before, weight = sums.get(block, (0.0, 0))
                sums[block] = before + np.frombuffer(values), weight + n
        for block, (values, n) in sums.items():
            yield pa.record_batch({"block": [block], "n": [n], "v": pa.array([values.tobytes()], pa.binary())})

    schema = "block long, n long, v binary"
    dealt = texts.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "key")
    blocks = -(-len(network.flat) // BLOCK)
    summed = dealt.select("shard", "units", "copies").mapInArrow(learn, schema).repartition(blocks, "block").mapInArrow(add, schema)
    flat = network.flat.copy()
    for block, n, values in summed.collect():  # the size of the network
        flat[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(values) / n / GRAIN
    shared.unpersist()
    return Network(flat)


def _blocks(total: np.ndarray, weight: int) -> pa.RecordBatch:
    cuts = range(0, len(total), BLOCK)
    return pa.record_batch(
        {"block": pa.array(range(len(cuts)), pa.int64()), "n": pa.array([weight] * len(cuts), pa.int64()), "v": pa.array([total[k : k + BLOCK].tobytes() for k in cuts], pa.binary())}
    )


def train(docs: DataFrame, counts: DataFrame, *, share: float = SHARE, shard_words: int = SHARD_WORDS) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of ``docs``, whose words are ``counts``."""
    vocabulary, words = build_vocabulary(counts, share)
    network, shards, round_ = Network.fresh(), -(-words // shard_words), 0
    if not shards:
        return vocabulary, network
    spark = docs.sparkSession
    dealt = dealt_texts(docs, vocabulary, shards)
    path = scratch_path(spark, "units")
    dealt.write.partitionBy("round").parquet(path)
    table = spark.read.schema(dealt.schema).parquet(path)
    first = 0
    while first < shards:
        size = min(FIRST << round_, shards - first)
        network = train_round(table.where(F.col("round") == round_), network, size, first * shard_words)
        first, round_ = first + size, round_ + 1
    drop_path(spark, path)
    return vocabulary, network


def score_documents(docs: DataFrame, *, training: DataFrame | None = None, share: float = SHARE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``n_tokens``, ``log_prob`` (sum over all words of the whole text) and
    ``mean_log_prob``. The network is trained on ``training``, ``docs`` itself by default. Word counts and the scores before the
    counts of rare words stay in the shared folder, where the result reads them.

    Null and empty texts have no words: their sum is 0 and their mean null. An empty training table leaves an untrained network, which
    still scores. Repeated rows are scored one by one and count as often in training; other columns are ignored.
    """
    known = docs if training is None else training
    counts, _ = stored(word_counts(known), "words")
    vocabulary, network = train(known, counts, share=share, shard_words=shard_words)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, network.flat))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, flat = shared.value
        net = Network(flat)
        for batch in slices(batches, "text", SLICE_BYTES):
            words, owner = words_of(texts_of(batch.column("text")))
            unit = vocab.units(words)
            value = net.log_probs(contexts(unit, owner, np.arange(len(unit))), unit)
            tail = np.flatnonzero(unit >= TOP)
            distinct, which = np.unique(words[tail], return_inverse=True)
            log_count, rare = vocab.log_counts(distinct)
            value[tail] += log_count[which] - vocab.total[unit[tail]]
            n = np.bincount(owner, minlength=batch.num_rows)
            total = np.bincount(owner, value, minlength=batch.num_rows).astype(np.float64)  # whole numbers if there are no words
            at = tail[rare[which]]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "key": batch.column("key"),
                    "n_tokens": pa.array(n.astype(np.int64)),
                    "log_prob": pa.array(total),
                    "rare": _lists(words[at], owner[at], batch.num_rows),
                }
            )

    keyed = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("key"))
    scored, _ = stored(keyed.mapInArrow(score, SCORED), "scores")
    pairs = scored.select("key", F.explode("rare").alias("pair")).groupBy("key", "pair.word").agg(F.max("pair.times").alias("times"))
    logs = counts.where("n > 1").select("word", F.ln("n").alias("log_count"))
    rest = pairs.join(logs, "word").groupBy("key").agg(F.sum(F.col("times") * F.col("log_count")).alias("rest"))
    total = F.col("log_prob") + F.coalesce("rest", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return scored.drop("rare").join(rest, "key", "left").select("doc_id", "n_tokens", total.alias("log_prob"), mean.alias("mean_log_prob"))


def _lists(words: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """For each text its distinct words and how often it has them."""
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])])) if len(words) else np.zeros(0, np.int64)
    times = np.diff(np.append(starts, len(words))).astype(np.int32)
    offsets = np.searchsorted(owner[starts], np.arange(n + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(words[starts].view(np.int64)), pa.array(times)], ["word", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)
