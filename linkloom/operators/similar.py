"""Near duplicates by word shingles, with DataFrame functions only.

A page's set is its distinct shingles of :data:`WORDS` words. Two pages are linked if the Jaccard similarity of their sets reaches
the threshold; a group is what links connect.

1. Pages with equal sets form a class, held by its smallest id. Only classes are compared.
2. One permutation: the top bits of a shingle's hash name one of :data:`BINS` bins, the smallest hash of a bin is its value.
   An empty bin takes that of a bin drawn for it, the same for all sets: values of neighbours would make bands of one shingle, and every two short texts
   with a phrase in common bucket mates. Three bins make a band (two or one under a threshold of 0.8, :data:`ROWS` from 0.9 up), its values the key of a bucket.
3. A bucket is chained to representatives: a class's centre is the class in its buckets that meets most others, and each class is
   compared with the centres of its bucket mates. So comparisons grow with the rows of buckets, not with pairs.
4. Two bucket mates may be linked though one of them isn't linked to the centre. Both differ from it in known elements, and sizes tell how many of
   those they must share. With the elements ordered by rarity they then share one of the first few (prefix filter);
   only such pairs are compared.
5. Links go through exact sets. Groups come from smallest labels, doubled in reach each round.

Pages are read twice: once for sizes, set keys and buckets, which are narrow, and once for the sets of classes that are to be compared. Sets are
the widest thing here, wider than the text, so a bit mask of the ids at hand keeps all others out of tables and shuffles.

Bands of three make a pair of similarity 0.8 share no bucket with a chance of 1e-13 in long texts; in the shortest, where shingles may fall into one bin,
it is about 1e-6. Links found are always exact.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import drop_path, stored

WORDS = 5
PERCENT = 80
BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4
# Bins to take a value from, seven bits each, for each empty bin.
DONORS = [random.Random(b).getrandbits(63) for b in range(BINS)]
MASK_WORDS = 1 << 20  # at most: 8 MB
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def word_shingles(text: Column, words: int = WORDS) -> Column:
    """Distinct ``words``-word shingles of a text as ascending 64-bit hashes. Lower case; a shorter text is one shingle, a text
    without words has none."""
    parts = F.array_remove(F.split(F.lower(text), WHITE_SPACE), "")

    def of(tokens: Column) -> Column:
        last = F.greatest(F.size(tokens) - words, F.lit(0))
        # Words are hashed where they stand: no text is put together for a shingle. Places beyond the end add nothing.
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(words))))

    # One binding of the words: a second use would split the text again.
    found = F.element_at(F.transform(F.array(parts), lambda t: F.when(F.size(t) > 0, of(t)).otherwise(F.array().cast("array<bigint>"))), 1)
    # Not array_sort, which compares boxed values through a lambda.
    return F.sort_array(F.array_distinct(found))


def _bin(value: Column) -> Column:
    # Hashes are sorted as signed numbers; bins go the same way.
    return (F.shiftright(value, 64 - BIN_BITS) + BINS // 2).cast("int")


def band_rows(percent: int) -> int:
    """Bins of a band. Drawn bins agree by chance less evenly than bins of their own, so short sets need shorter bands than long ones would."""
    return ROWS if percent >= 90 else 3 if percent >= 80 else 2 if percent >= 60 else 1


def band_keys(shingles: Column, rows: int = ROWS) -> Column:
    """Bucket keys of a non-empty ascending array of hashes: minima per bin, empty bins filled from others, banded."""

    def before(a: Column, i: Column) -> Column:
        return F.when(i > 0, _bin(F.get(a, i - 1))).otherwise(F.lit(-1))

    def bound(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def filled(minima: Column) -> Column:
        # An empty bin has the next one's value at first, which belongs to another bin.
        runs = F.flatten(F.transform(minima, lambda x, i: F.array_repeat(x, _bin(x) - before(minima, i))))
        # Around the end: the last bins take the first value. The runs end with the last value's bin.
        runs = F.concat(runs, F.array_repeat(F.get(minima, F.lit(0)), F.lit(BINS - 1) - _bin(F.element_at(minima, -1))))
        return bound(runs, lambda values: F.transform(values, lambda x, j: drawn(minima, values, x, j)))

    def drawn(minima: Column, values: Column, x: Column, j: Column) -> Column:
        """The value of bin ``j``: ``x`` if it is its own, else that of the first of its donors that has one."""

        def own(value: Column, at: Column) -> Column:
            return F.when(_bin(value) == at, value)

        bits = F.get(F.array(*map(F.lit, DONORS)), j)
        donors = [F.shiftright(bits, k).bitwiseAND(F.lit(BINS - 1)).cast("int") for k in range(0, 63, BIN_BITS)]
        # With few full bins the draw may fail; then the smallest of their hashes for this bin.
        last = F.array_min(F.transform(minima, lambda y: F.xxhash64(j, y)))
        return F.coalesce(own(x, j), *(own(F.get(values, d), d) for d in donors), last)

    # The first of each bin, told by its top bits.
    first = lambda x, i: (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(shingles, i - 1)), 64 - BIN_BITS) != 0)
    minima = F.filter(shingles, first)
    keys = bound(bound(minima, filled), lambda v: F.transform(
        F.sequence(F.lit(0), F.lit(BINS // rows - 1)),
        lambda b: F.xxhash64(b, *(F.get(v, b * rows + k) for k in range(rows))),
    ))
    return F.when(F.size(shingles) > 0, keys)


def _apart(*keys: str) -> list:
    """Grouping columns with one more that follows from the last: a join on the keys alone then shuffles both of its sides,
    so that AQE can split a hot key."""
    return [*keys, F.pmod(F.col(keys[-1]), F.lit(64)).alias("_apart")]


def _met(members: DataFrame) -> DataFrame:
    """Rows of buckets that have more than one."""
    full = members.groupBy(*_apart("bucket")).agg(F.count("*").alias("met")).where("met > 1").select("bucket")
    return members.join(full, "bucket")


def _narrowed(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ``ids`` (one column), and few others: what an inner join on it needs. No row is shuffled; tasks get
    a bit mask with 64 bits for each id, as far as :data:`MASK_WORDS` go, beyond which only more of the others stay."""
    spark, key = rows.sparkSession, ids.columns[0]
    words = min(MASK_WORDS, 1 << max(10, ids.count().bit_length()))

    def place(c: str) -> tuple[Column, Column]:
        hashed = F.xxhash64(c)
        return F.pmod(hashed, F.lit(words)).cast("int"), F.shiftrightunsigned(hashed, 58).cast("int")

    word, bit = place(key)
    some = ids.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    every = spark.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    mask = (
        some.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("mask")).scalar()
    )
    word, bit = place(column)
    return rows.where(F.call_function("shiftrightunsigned", F.get(mask, word), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1)


def _centres(members: DataFrame) -> DataFrame:
    """(``a``: centre, ``b``: class) for each class and the centres of its bucket mates."""
    size = members.groupBy(*_apart("bucket")).agg(F.count("*").alias("met")).drop("_apart")
    weight = members.join(size, "bucket").groupBy("class").agg(F.sum("met").alias("weight"))
    lead = (
        members.join(weight, "class").groupBy(*_apart("bucket"))
        .agg(F.max(F.struct("weight", (-F.col("class")).alias("smaller"))).alias("lead")).drop("_apart")
    )
    centre = members.join(lead, "bucket").groupBy("class").agg((-F.max("lead")["smaller"]).alias("centre"))
    near = members.join(centre, "class").select("bucket", "centre").distinct()
    met = members.join(near, "bucket").where("class != centre")
    return met.select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct()


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with ``set_a``, ``set_b`` and ``common``, the size of what they share."""
    left = _narrowed(sets, "class", pairs.select("a")).select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = _narrowed(sets, "class", pairs.select("b")).select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(right, "b").join(left, "a")
    return both.withColumn("common", F.size(F.array_intersect("set_a", "set_b")))


def _linked(percent: int) -> Column:
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return 100 * F.col("common") >= percent * union


def _stars(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Classes against their centres: ``linked``; ``size`` of the class's set; ``diff``, the elements in one set only; ``probe``:
    a class that is linked to ``b`` but not to ``a`` has one of so many of them in its own difference, in any order."""
    a, b, n = F.size("set_a"), F.size("set_b"), F.size("diff")
    shared = F.floor(((100 + percent) * n + (100 - percent) * (a - b)) / (2 * (100 + percent))).cast("int")
    diff = F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a"))
    return _with_sets(pairs, sets).withColumn("diff", diff).select(
        "a", "b", _linked(percent).alias("linked"), b.alias("size"), n.alias("n"), (n - shared).alias("probe"), "diff"
    )


def _placed(star: DataFrame) -> DataFrame:
    """Differences of classes from their centres, one row per element that another class around the centre may meet it with;
    ``place`` is the element's place by rarity."""
    # The element leads in keys, as sorts compare the first of them fastest, and it tells most rows apart; a centre may have very many.
    element = star.select("a", "b", "size", "n", "probe", "linked", F.explode("diff").alias("e"))
    shared = element.groupBy(*_apart("e", "a")).agg(F.count("*").alias("df")).where("df > 1").drop("_apart")
    own = Window.partitionBy("b", "a")
    # Elements of one class alone come first and meet nothing.
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "e"))
    placed = element.join(shared, ["e", "a"]).withColumn("place", place)
    return placed.where("place <= probe or not linked").select("a", "e", "b", "size", "n", "place", "probe", "linked")


def _side_pairs(star: DataFrame, percent: int, placed: DataFrame | None = None) -> DataFrame:
    """Pairs of classes around one centre that may be linked though one of them isn't linked to the centre. ``placed`` is read
    twice, so it may be given as a stored table."""
    placed = _placed(star) if placed is None else placed
    columns = ("b", "size", "n", "place")
    one = placed.where("place <= probe").select("a", "e", *(F.col(c).alias(f"{c}1") for c in columns))
    two = placed.where("not linked").select("a", "e", *(F.col(c).alias(f"{c}2") for c in columns))
    up, down = 100 + percent, 100 - percent
    least = F.ceil((up * (F.col("n1") + F.col("n2")) - down * (F.col("size1") + F.col("size2"))) / (2 * up))
    met = one.join(two, ["e", "a"]).where(
        (F.col("b1") != F.col("b2")) & (100 * F.least("size1", "size2") >= percent * F.greatest("size1", "size2"))
        & (F.col("place1") <= F.col("n1") - least + 1) & (F.col("place2") <= F.col("n2") - least + 1)
    )
    return met.select(F.least("b1", "b2").alias("a"), F.greatest("b1", "b2").alias("b")).distinct()


def connected(links: DataFrame) -> tuple[DataFrame, str]:
    """``id, label``: the smallest id that links (``a``, ``b``) connect each linked id to, stored, and the table's path.

    A round takes the smallest label around and then that label's label, so n links in a row need about log n rounds. Only
    ids move; the driver learns whether anything changed.
    """
    spark = links.sparkSession
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct()
    both, both_path = stored(both, "similar-links")
    now, path = stored(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.min("u")).alias("label")), "similar-labels")
    moving = True
    while moving:
        around = both.join(now.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near"))
        hop = now.join(around, "id").select("id", "label", F.least("label", "near").alias("low"))
        far = now.select(F.col("id").alias("low"), F.col("label").alias("far"))
        best = F.least("low", "far")
        new, new_path = stored(hop.join(far, "low", "left").select("id", best.alias("label"), (best < F.col("label")).alias("moved")), "similar-labels")
        moving = not new.where("moved").isEmpty()
        drop_path(spark, path)
        now, path = new.select("id", "label"), new_path
    drop_path(spark, both_path)
    return now, path


def near_duplicates(pages: DataFrame, text: Column, threshold: float = PERCENT / 100, words: int = WORDS) -> DataFrame:
    """One row per ``page_id``: ``n_shingles``, ``group_id`` (smallest id that links connect it to), ``similarity`` to that page and
    ``is_first`` (it is that page itself).

    ``text`` is an expression over ``pages``, such as the visible text of a capture. Neither it nor the sets of all pages are shuffled or
    written, so ``pages`` is read again for the sets of pages to compare and should be a stored table. ``threshold`` is taken in whole
    percent. A page without words is alone. ``page_id`` is unique; rows without one are left out. The groups that the result reads stay
    in the shared folder.
    """
    spark, percent = pages.sparkSession, round(100 * threshold)
    pages = pages.select("page_id", F.coalesce(text, F.lit("")).alias("text")).where("page_id is not null")
    shingles = word_shingles(F.col("text"), words).alias("shingles")
    keyed, keyed_path = stored(
        pages.select("page_id", shingles).select(
            "page_id", F.size("shingles").alias("n_shingles"), *(F.xxhash64(F.lit(k), "shingles").alias(f"key{k}") for k in (1, 2)),
            band_keys(F.col("shingles"), band_rows(percent)).alias("buckets"),
        ),
        "similar-keys",
    )
    keys = ["n_shingles", "key1", "key2"]
    # Equal sets have equal buckets.
    first = keyed.where("n_shingles > 0").groupBy(*keys).agg(F.min("page_id").alias("class"), F.first("buckets").alias("buckets"))
    first, first_path = stored(first, "similar-classes")
    # A smaller set is linked with an equal one only: one shingle more or less is too much.
    able = first.where((100 - percent) * F.col("n_shingles") >= percent)
    members, members_path = stored(_met(able.select("class", F.explode("buckets").alias("bucket"))), "similar-members")
    tested, tested_path = stored(_centres(members), "similar-centres")
    compared = tested.select("a").union(tested.select("b"))
    classes, classes_path = stored(_narrowed(pages, "page_id", compared).select(F.col("page_id").alias("class"), shingles), "similar-sets")
    star, star_path = stored(_stars(tested, classes, percent), "similar-stars")
    known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    placed, placed_path = stored(_placed(star), "similar-places")
    side, side_path = stored(_side_pairs(star, percent, placed).join(known, ["a", "b"], "left_anti"), "similar-pairs")
    links = star.where("linked").select("a", "b").union(_with_sets(side, classes).where(_linked(percent)).select("a", "b"))
    labels, labels_path = connected(links)
    labels = labels.select(F.col("id").alias("class"), F.col("label").alias("group_id"))
    # Similarity of each class to the first page of its group, which holds a class itself.
    to_first = _with_sets(labels.where("class != group_id").select(F.col("group_id").alias("a"), F.col("class").alias("b")), classes)
    score = F.col("common") / (F.size("set_a") + F.size("set_b") - F.col("common"))
    scored = to_first.select(F.col("b").alias("class"), F.col("a").alias("group_id"), score.alias("similarity"))
    classed, _ = stored(
        first.select(*keys, "class").join(scored, "class", "left").select(
            *keys, F.coalesce("group_id", "class").alias("group_id"), F.coalesce("similarity", F.lit(1.0)).alias("similarity")
        ),
        "similar-groups",
    )
    pages_of, _ = stored(keyed.select("page_id", *keys), "similar-pages")
    for path in (keyed_path, first_path, members_path, tested_path, classes_path, star_path, placed_path, side_path, labels_path):
        drop_path(spark, path)
    return pages_of.join(classed, keys, "left").select(
        "page_id",
        "n_shingles",
        F.coalesce("group_id", "page_id").alias("group_id"),
        F.coalesce("similarity", F.lit(1.0)).alias("similarity"),
        F.coalesce(F.col("group_id") == F.col("page_id"), F.lit(True)).alias("is_first"),
    )
