"""Near-duplicate documents by one-permutation MinHash.

1. A text's set is its distinct word shingles. One pass hashes each shingle once; the top bits name a bin, the smallest
   hash in a bin is its value. Empty bins borrow the value of a non-empty bin chosen by a hash of (bin, attempt): optimal
   densification. ``ROWS`` bins make a band, a band's values make a bucket key.
2. Texts with equal sets form one class, held by its smallest id, so copies never meet each other again.
3. Candidate edges are stars. A class's centre is the class in its buckets that meets the most others (the original of
   a family of edited copies, as a rule). Each class is compared with its own centre and with those of its bucket mates, so there are
   about as many edges as classes, however large a bucket is.
4. Comparing a class with a centre also gives their difference. Two bucket mates that are both linked to a common centre need no
   test. If one isn't, its difference from the centre is large, and the sizes of both differences and sets tell how much the differences
   must have in common if the two are linked. Order the elements of differences by the number of classes that have them; then
   the two must share an element among the first few of each (prefix filter). The first are those that nobody else
   has, so unrelated edits of one original don't meet. Pairs that do meet are tested as well. This loses no link between bucket mates.
5. All links are confirmed on full shingle sets and joined to components by minimum labels.

With 32 bands of 4 bins a pair of similarity 0.8 shares no bucket with a probability of about 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.bitmaps import key_bitmap, maybe_in
from linkloom.llm.textcols import Texts, mix, slices, texts_of, windows
from linkloom.session import drop_path, stored

WORDS = 5
PERCENT = 80
BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4
BANDS = BINS // ROWS

SKETCH = "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"


def lowered(texts: Texts) -> Texts:
    """A to Z in lower case; other characters as they are."""
    data = texts.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    return Texts(data, texts.bounds)


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Fewer words than ``size`` make one shingle."""
    texts = lowered(texts)
    starts, ends, owner = texts.words()
    words = texts.hashes(starts, ends)
    at, hashes = windows(words, owner, size)
    first = np.searchsorted(owner[at], np.arange(len(texts) + 1))
    word = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        if first[i] < first[i + 1]:
            out.append(np.unique(hashes[first[i] : first[i + 1]]))
        elif word[i] < word[i + 1]:
            h = np.uint64(word[i + 1] - word[i])
            for w in words[word[i] : word[i + 1]]:
                h = mix(np.array([h]) ^ w)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bands_of(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys (texts x BANDS) of non-empty sorted sets."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = owner * BINS + (flat >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    lead = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    values = np.zeros(len(sets) * BINS, np.uint64)
    full = np.zeros(len(sets) * BINS, bool)
    values[cell[lead]] = flat[lead]  # sets are sorted: the first of a bin is its minimum
    full[cell[lead]] = True
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        donor = empty // BINS * BINS + (mix(empty % BINS * 0x10001 + attempt * 0x9E3779B1) & np.uint64(BINS - 1)).astype(np.int64)
        found = full[donor]
        values[empty[found]] = values[donor[found]]
        empty = empty[~found]
    values = values.reshape(len(sets) * BANDS, ROWS)
    key = np.tile(np.arange(BANDS, dtype=np.uint64), len(sets))
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
    return key.reshape(len(sets), BANDS)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Set size, 128-bit set key and bucket keys of each text. A set without shingles has null bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(texts_of(batch.column("text")), size)
            some = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if some:
                for i, row in zip(some, bands_of([sets[i] for i in some]).view(np.int64)):
                    bands[i] = row
            keys = [[int(mix(s ^ np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (0x51ED270B, 0xB492B66F)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "key1": pa.array(keys[0], pa.int64()),
                    "key2": pa.array(keys[1], pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(sketch, SKETCH)


def pair_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of all ids in the pairs, once each. A bitmap of the ids keeps other texts out of the shuffle."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(ids.select(F.xxhash64("doc_id").alias("key")), "key"))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = maybe_in(bitmap.value, batch.column("key").to_numpy(zero_copy_only=False))
            if hit.any():
                yield batch.select(["doc_id", "text"]).filter(pa.array(hit))

    near = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key")).mapInArrow(wanted, "doc_id long, text string")
    return near.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int, differences: bool) -> DataFrame:
    """Full comparison of the pairs (``a``, ``b``) by their ``texts`` (one row per ``doc_id``; a stored table, so that both sides
    of the joins are shuffled for them and AQE can split a centre with very many pairs): ``linked``, that is ``100 * intersection >= percent * union``; and, if asked for, ``size``
    of the set of ``b``, ``diff``, the elements in one set only, and ``probe``: a class that is linked to ``b`` but not to ``a`` has
    one of the first so many of them in its own difference, in any order."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, centre = None, None
        for batch in slices(batches, "text_b"):
            a = batch.column("a").to_pylist()
            fresh = [i for i, x in enumerate(a) if not i or x != a[i - 1]]  # rows of one ``a`` mostly come together
            sets = shingle_sets(texts_of(batch.column("text_a").take(pa.array(fresh))), size)
            rows: dict[str, list] = {"linked": [], "size": [], "diff": [], "probe": []}
            k = -1
            for i, other in enumerate(shingle_sets(texts_of(batch.column("text_b")), size)):
                if k + 1 < len(fresh) and fresh[k + 1] == i:
                    k += 1
                    if a[i] != last_id:
                        last_id, centre = a[i], sets[k]
                both = np.intersect1d(centre, other, assume_unique=True)
                diff = len(centre) + len(other) - 2 * len(both)
                rows["linked"].append(100 * len(both) >= percent * (len(both) + diff))
                if differences:
                    rows["size"].append(len(other))
                    rows["diff"].append(np.setxor1d(centre, other, assume_unique=True).view(np.int64))
                    shared = ((100 + percent) * diff + (100 - percent) * (len(centre) - len(other))) // (2 * (100 + percent))
                    rows["probe"].append(diff - shared)
            columns = {"a": batch.column("a"), "b": batch.column("b"), "linked": pa.array(rows["linked"], pa.bool_())}
            if differences:
                columns |= {"size": pa.array(rows["size"], pa.int32()), "diff": pa.array(rows["diff"], pa.list_(pa.int64())), "probe": pa.array(rows["probe"], pa.int32())}
            yield pa.record_batch(columns)

    schema = "a long, b long, linked boolean" + (", size int, diff array<long>, probe int" if differences else "")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(test, schema)


def _apart(*keys: str) -> list:
    """Grouping columns for the keys and a number that follows from the last. Spark takes the groups to be laid out by
    all of these and shuffles both sides of a join on the keys alone, so that AQE can split a hot key of the other side."""
    return [*keys, F.pmod(F.col(keys[-1]), F.lit(64)).alias("_apart")]


def star_edges(member: DataFrame) -> DataFrame:
    """(``a``: centre, ``b``: class) for each class and the centres of its bucket mates, from (``bucket``, ``rep``)."""
    size = member.groupBy(*_apart("bucket")).agg(F.count("*").alias("size")).drop("_apart")
    weight = member.join(size, "bucket").groupBy("rep").agg(F.sum("size").alias("weight"))
    weighed = member.join(weight, "rep")
    rank = F.struct("weight", (-F.col("rep")).alias("neg"))
    lead = weighed.groupBy(*_apart("bucket")).agg(F.max(rank).alias("lead")).drop("_apart")
    centre = member.join(lead, "bucket").groupBy("rep").agg((-F.max("lead")["neg"]).alias("centre"))
    near = member.join(centre, "rep").select("bucket", "centre").distinct()
    return member.join(near, "bucket").where("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()


def side_pairs(star: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes around one centre that may be linked to each other though one isn't linked to the centre."""
    measures = ["linked", "size", "probe", F.size("diff").alias("n")]
    element = star.select("a", "b", F.explode("diff").alias("e"))
    common = element.groupBy(*_apart("a", "e")).agg(F.count("*").alias("df")).where("df > 1").drop("_apart")
    own = Window.partitionBy("a", "b")
    placed = (
        element.join(common, ["a", "e"]).join(star.select("a", "b", *measures), ["a", "b"])
        # Elements that no other class has come first; they meet nothing and only take places.
        .withColumn("place", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "e")))
    )
    one = placed.where("place <= probe").select("a", "e", *(F.col(c).alias(f"{c}1") for c in ("b", "size", "n", "place")))
    two = placed.where("not linked").select("a", "e", *(F.col(c).alias(f"{c}2") for c in ("b", "size", "n", "place")))
    up, down = 100 + percent, 100 - percent
    least = f"(({up} * (n1 + n2) - {down} * (size1 + size2) + {2 * up - 1}) div {2 * up})"  # what linked classes have in common
    met = one.join(two, ["a", "e"]).where(
        f"b1 != b2 and place1 <= n1 - {least} + 1 and place2 <= n2 - {least} + 1 and 100 * least(size1, size2) >= {percent} * greatest(size1, size2)"
    )
    return met.select(F.least("b1", "b2").alias("a"), F.greatest("b1", "b2").alias("b")).distinct()


def components(spark: SparkSession, links: DataFrame) -> tuple[DataFrame, str]:
    """Smallest reachable id of every linked id: (``doc_id``, ``label``), stored.

    Each round takes the smallest label among the neighbours and then the label of that label, so a chain of n
    links needs about log n rounds. Only (id, label) pairs move; a hub's links are combined before the shuffle.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    both, edge_path = stored(both.distinct(), "links")
    now, path = stored(both.groupBy(F.col("u").alias("doc_id")).agg(F.least(F.min("v"), F.min("u")).alias("label")), "labels")
    while True:
        near = both.join(now.withColumnRenamed("doc_id", "v"), "v").groupBy(F.col("u").alias("doc_id")).agg(F.min("label").alias("near"))
        hop = now.join(near, "doc_id").select("doc_id", "label", F.least("label", "near").alias("low"))
        jump = now.select(F.col("doc_id").alias("low"), F.col("label").alias("far"))
        new, new_path = stored(
            hop.join(jump, "low", "left").select("doc_id", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")),
            "labels",
        )
        moving = not new.where("moved").isEmpty()
        drop_path(spark, path)
        now, path = new.select("doc_id", "label"), new_path
        if not moving:
            drop_path(spark, edge_path)
            return now, path


def near_duplicates(docs: DataFrame, *, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per ``doc_id``: ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Null and empty texts have no shingles and are linked with nothing. A row that repeats an id counts once; if its
    text differs, one of the texts is taken. Rows without an id are left out. Other columns are ignored. ``docs``
    is read again for the texts of candidate pairs, so it should be a stored table.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    sketch, _ = stored(sketches(docs, size), "sketches")
    sets = ["n_shingles", "key1", "key2"]
    classes, _ = stored(
        sketch.where("bands is not null").groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes"
    )
    member = classes.select("rep", F.explode("bands").alias("bucket"))
    full = member.groupBy(*_apart("bucket")).agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("bucket")
    member, member_path = stored(member.join(full, "bucket"), "members")
    edges, edge_path = stored(star_edges(member), "edges")
    texts, text_path = stored(pair_texts(edges, docs), "texts")
    star, star_path = stored(compared(edges, texts, size, percent, True), "stars")
    tested = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    side, side_path = stored(side_pairs(star, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
    # Every class of a side pair is on a star, so its text is at hand.
    found = compared(side, texts, size, percent, False).where("linked").select("a", "b")
    label, _ = components(spark, star.where("linked").select("a", "b").union(found))
    for path in (member_path, edge_path, text_path, star_path, side_path):
        drop_path(spark, path)
    place = classes.select(*sets, "rep").join(label.withColumnRenamed("doc_id", "rep"), "rep", "left").select(*sets, F.coalesce("label", "rep").alias("component_id"))
    one = sketch.groupBy("doc_id").agg(F.min(F.struct(*sets)).alias("s")).select("doc_id", "s.*")
    found = one.join(place, sets, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
