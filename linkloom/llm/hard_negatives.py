"""Hard negatives by rotated one-bit codes.

1. Index. Each component becomes ``floor(256 * x)``. A fixed random rotation is applied to the integer vector; the signs of the
   rotated components are its code, one bit each. Stored with it: the alignment, that is the inner product of the rotated
   vector with its code as a unit vector, and the length of what the code leaves over (the residual).
2. Estimate. An anchor's rotated vector is cut into :data:`PLANES` bit planes. Counting the bits that a code shares with each plane
   gives the inner product of the code with the planes; what the planes leave over bounds its error.
3. Interval. A score is alignment times code product plus the product of the two residuals, and by Cauchy-Schwarz that is no
   larger than the product of their lengths. So every score has a lower and an upper bound that always hold.
4. Filter and score. Only rows whose interval meets what is still wanted (better than an anchor's present last positive; within a
   positive's band and better than its present last negative) are scored, with integers.

Anchors are taken in chunks of at most :data:`ANCHORS_AT_ONCE`, which are sent to the tasks; each task runs its rows
against a chunk in blocks and keeps a few rows per anchor. So no key is shuffled but (anchor, its few best rows per task), and neither a hot label
nor copies of one vector make a task larger than others. All rows are indexed and every anchor meets every row; nothing is
approximate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import drop_path, scratch_path, stored

POSITIVES = NEGATIVES = 5
#: Negatives score between so many hundredths of their positive's score and all of it.
LEAST_PERCENT = 80
#: Anchors are the rows whose id is divisible by this.
ANCHOR_EVERY = 100
#: Bit planes of an anchor's rotated vector.
PLANES = 5
#: Components are held within these bounds (vectors of 131,072 and more are cut), so that scores of 8,192 dimensions fit 64 bits.
LARGEST = 1 << 25
#: Anchors sent to the tasks at a time: at 64 dimensions 32,768 take some 40 MB. Longer vectors make chunks smaller in proportion.
ANCHORS_AT_ONCE, AT_DIMENSIONS = 1 << 15, 64
BLOCK_ANCHORS, BLOCK_ROWS = 256, 4096
SEED = 20_240_529

INDEX = "vec_id long, label long, q binary, code binary, align double, rest double"
NOTHING = -(1 << 63)


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    width = -(-bits.shape[1] // 64) * 64
    full = np.zeros((len(bits), width), bool)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def encoded(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments and residual lengths of integer vectors (rows)."""
    y = q.astype(np.float64) @ rotation(q.shape[1])
    align = np.abs(y).sum(1) / np.sqrt(q.shape[1])
    rest = np.sqrt(np.maximum((y * y).sum(1) - align * align, 0.0))
    return packed(y >= 0), align, rest


def vectors_of(column: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors of a list column without nulls, in ``dim`` components; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    q = np.zeros((len(column), dim), np.int64)
    owner = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    q[owner, place] = np.clip(np.floor(256.0 * flat), -LARGEST, LARGEST).astype(np.int64)
    return q


class Anchors:
    """A chunk of anchors, ready for estimates; ``wanted`` are their bands or nothing."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        self.ids, self.labels, self.q = ids, labels, q
        dim = q.shape[1]
        z = q.astype(np.float64) @ rotation(dim)
        low = z.min(1, keepdims=True)
        step = np.maximum((z.max(1, keepdims=True) - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.clip(np.rint((z - low) / step), 0, (1 << PLANES) - 1).astype(np.int64)
        near = low + step * level
        root = np.sqrt(dim)
        self.planes = [packed((level >> j) & 1 == 1) for j in range(PLANES)]
        # <code, near> = (2 * (low * ones + step * shared) - sum(near)) / root
        self.low, self.step = 2 * low[:, 0] / root, 2 * step[:, 0] / root
        self.offset = near.sum(1) / root
        self.off = np.sqrt(((z - near) ** 2).sum(1))
        self.norm2 = (z * z).sum(1)

    def __len__(self) -> int:
        return len(self.ids)

    def bounds(self, part: slice, code: np.ndarray, align: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds (anchors x rows) of the scores that hold for certain."""
        n = len(self.ids[part])
        shared = np.zeros((n, len(code)), np.float64)
        for word in range(code.shape[1]):
            for j, plane in enumerate(self.planes):
                shared += float(1 << j) * np.bitwise_count(plane[part][:, word, None] & code[None, :, word])
        ones = np.bitwise_count(code).sum(1).astype(np.float64)
        product = self.low[part, None] * ones + self.step[part, None] * shared - self.offset[part, None]
        off = self.off[part, None]
        # The code's product with the anchor itself lies within ``off``; the residual is longest where that is smallest.
        least = np.maximum(np.abs(product) - off, 0.0)
        residual = np.sqrt(np.maximum(self.norm2[part, None] - least * least, 0.0))
        # Rounding of doubles is far below this.
        slack = 1e-9 * np.sqrt(self.norm2[part, None]) * (align + rest) + 1e-6
        width = align * off + rest * residual + slack
        middle = align * product
        return middle - width, middle + width


def _scored(anchors: Anchors, a: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Integer scores of pairs (anchor, row)."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        out[s] = np.einsum("ij,ij->i", anchors.q[a[s]], q[r[s]])
    return out


class Best:
    """The best few rows of each group: highest score first, ties by smaller id."""

    def __init__(self, groups: int, keep: int):
        self.keep = keep
        self.score = np.full((groups, keep), NOTHING, np.int64)
        self.id = np.zeros((groups, keep), np.int64)

    def last(self, groups: slice) -> np.ndarray:
        """Score that a row must reach to matter."""
        return self.score[groups, -1]

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        matter = score >= self.score[group, -1]
        group, score, ids = group[matter], score[matter], ids[matter]
        if not len(group):
            return
        touched = np.unique(group)
        old = np.repeat(touched, self.keep), self.score[touched].ravel(), self.id[touched].ravel()
        real = old[1] != NOTHING
        group, score, ids = (np.concatenate([x[real], y]) for x, y in zip(old, (group, score, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.searchsorted(group, touched)
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        top = rank < self.keep
        self.score[touched] = NOTHING
        self.score[group[top], rank[top]], self.id[group[top], rank[top]] = score[top], ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        group, place = np.nonzero(self.score != NOTHING)
        return group, self.score[group, place], self.id[group, place]


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Index rows in blocks: ids, labels, vectors, codes, alignments, residuals."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(i, BLOCK_ROWS)
            ids, labels, align, rest = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "align", "rest"))
            q = _binary(rows.column("q"), np.int32).reshape(len(ids), dim).astype(np.int64)
            yield ids, labels, q, _binary(rows.column("code"), np.uint64).reshape(len(ids), -1), align, rest


def _binary(column: pa.Array, kind: type) -> np.ndarray:
    """The values of a binary column, one row after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def positives_in(anchors: Anchors, batches: Iterator[pa.RecordBatch], best: Best) -> Best:
    """The best rows of each anchor's own label, without the anchor itself."""
    for ids, labels, q, code, align, rest in _blocks(batches, anchors.q.shape[1]):
        for start in range(0, len(anchors), BLOCK_ANCHORS):
            part = slice(start, start + BLOCK_ANCHORS)
            fit = (anchors.labels[part, None] == labels) & (anchors.ids[part, None] != ids)
            _, high = anchors.bounds(part, code, align, rest)
            a, r = np.nonzero(fit & (high >= best.last(part)[:, None].astype(np.float64)))
            best.offer(a + start, _scored(anchors, a + start, q, r), ids[r])
    return best


def negatives_in(anchors: Anchors, scores: np.ndarray, batches: Iterator[pa.RecordBatch], best: Best) -> Best:
    """For each anchor and positive (group anchor * POSITIVES + k, ``scores`` of that shape, NOTHING where there is none) the
    best rows of other labels whose score lies in the positive's band."""
    # 100 * s >= LEAST_PERCENT * p, with integers.
    floor = np.where(scores == NOTHING, NOTHING, -((-LEAST_PERCENT * scores) // 100))
    real = (scores != NOTHING) & (floor <= scores)
    for ids, labels, q, code, align, rest in _blocks(batches, anchors.q.shape[1]):
        for start in range(0, len(anchors), BLOCK_ANCHORS):
            part = slice(start, start + BLOCK_ANCHORS)
            if not real[part].any():
                continue
            low, high = anchors.bounds(part, code, align, rest)
            last = best.last(slice(start * POSITIVES, (start + BLOCK_ANCHORS) * POSITIVES)).reshape(-1, POSITIVES)
            cut = np.maximum(floor[part], last)
            meets = np.zeros(low.shape, bool)
            for k in range(POSITIVES):
                there = real[part, k, None]
                meets |= there & (high >= cut[:, k, None].astype(np.float64)) & (low <= scores[part, k, None].astype(np.float64))
            a, r = np.nonzero(meets & (anchors.labels[part, None] != labels))
            a = a + start
            score = _scored(anchors, a, q, r)
            for k in range(POSITIVES):
                inside = real[a, k] & (score >= floor[a, k]) & (score <= scores[a, k])
                best.offer(a[inside] * POSITIVES + k, score[inside], ids[r[inside]])
    return best


def vector_index(vectors: DataFrame, relabel: bool = True) -> tuple[DataFrame, int, str]:
    """The stored index (:data:`INDEX`), its dimensions and its path. ``vectors`` has ``vec_id, label, embedding``."""
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v")
    ).where("vec_id is not null and label is not null and v is not null")
    usable = usable.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    # A repeated id counts once; of different rows the smallest by label and vector.
    usable = usable.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    if relabel:
        usable = usable.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    dim = vectors.agg(F.max(F.size("embedding"))).first()[0]
    dim = max(1, dim or 1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                rows = batch.slice(i, BLOCK_ROWS)
                q = vectors_of(rows.column("v"), dim)
                code, align, rest = encoded(q)
                yield pa.record_batch(
                    {
                        "vec_id": rows.column("vec_id"),
                        "label": rows.column("label"),
                        "q": pa.array([x.tobytes() for x in q.astype(np.int32)], pa.binary()),
                        "code": pa.array([x.tobytes() for x in code], pa.binary()),
                        "align": align,
                        "rest": rest,
                    }
                )

    found, path = stored(usable.mapInArrow(index, INDEX), "codes")
    return found, dim, path


POSITIVE = "anchor_id long, positive_id long, positive_score long"
FOUND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def _chunks(index: DataFrame, dim: int) -> Iterator[Anchors]:
    """The anchors in ascending order of ids, at most ``ANCHORS_AT_ONCE`` (at 64 dimensions) at a time."""
    rows = index.where(F.col("vec_id") % ANCHOR_EVERY == 0).select("vec_id", "label", "q")
    most = max(1, ANCHORS_AT_ONCE * AT_DIMENSIONS // max(dim, AT_DIMENSIONS))
    while True:
        chunk = rows.orderBy("vec_id").limit(most).toArrow().combine_chunks()
        if not chunk.num_rows:
            return
        ids = chunk.column("vec_id").to_numpy()
        q = _binary(chunk.column("q"), np.int32).reshape(len(ids), dim).astype(np.int64)
        yield Anchors(ids, chunk.column("label").to_numpy(), q)
        rows = rows.where(F.col("vec_id") > int(ids[-1]))


def _first(found: DataFrame, keys: list[str], score: str, name: str, keep: int) -> DataFrame:
    """The best ``keep`` of each group over all tasks with their ``rank``; each task has sent no more than that."""
    best = Window.partitionBy(*keys).orderBy(F.col(score).desc(), name)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, relabel: bool = True) -> DataFrame:
    """For each anchor and each of its first positives the best rows of other labels whose score is in the positive's band:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows without id or label, without a vector, or with a null or non-finite component take no part. A repeated id counts once, with its smallest
    (label, vector). Vectors of different lengths are compared as if the shorter ended in zeros, so an empty one scores 0.
    Equal scores go by the smaller id. An anchor without positives, or a positive with a negative score, has no rows; an
    empty table gives none. Other columns are ignored. ``relabel`` changes labels as the query's contract says.

    The found rows stay in the shared folder, as the result reads them.
    """
    spark = vectors.sparkSession
    index, dim, index_path = vector_index(vectors, relabel)
    root, parts = scratch_path(spark, "negatives"), []
    for chunk in _chunks(index, dim):
        sent = spark.sparkContext.broadcast(chunk)
        positives = _first(_positives(index, sent), ["anchor_id"], "positive_score", "positive_id", POSITIVES).collect()
        # At most POSITIVES rows for each anchor of the chunk.
        place = {int(x): i for i, x in enumerate(chunk.ids)}
        ids = np.zeros((len(chunk), POSITIVES), np.int64)
        scores = np.full((len(chunk), POSITIVES), NOTHING, np.int64)
        for row in positives:
            ids[place[row.anchor_id], row["rank"] - 1], scores[place[row.anchor_id], row["rank"] - 1] = row.positive_id, row.positive_score
        bands = spark.sparkContext.broadcast((ids, scores))
        found = _first(_negatives(index, sent, bands), ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES)
        parts.append(f"{root}/chunk={len(parts)}")
        found.write.parquet(parts[-1])
        sent.unpersist()
        bands.unpersist()
    schema = f"{FOUND}, rank int"
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    drop_path(spark, index_path)
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _positives(index: DataFrame, sent) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        group, score, ids = positives_in(anchors, batches, Best(len(anchors), POSITIVES)).rows()
        yield pa.record_batch({"anchor_id": anchors.ids[group], "positive_id": ids, "positive_score": score})

    return index.mapInArrow(task, POSITIVE)


def _negatives(index: DataFrame, sent, bands) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (positive, scores) = sent.value, bands.value
        group, score, ids = negatives_in(anchors, scores, batches, Best(len(anchors) * POSITIVES, NEGATIVES)).rows()
        anchor, k = group // POSITIVES, group % POSITIVES
        yield pa.record_batch(
            {
                "anchor_id": anchors.ids[anchor],
                "positive_id": positive[anchor, k],
                "negative_id": ids,
                "positive_score": scores[anchor, k],
                "negative_score": score,
            }
        )

    return index.mapInArrow(task, FOUND)
