"""Text fingerprints of spot signatures, with DataFrame functions only.

1. A spot is a common word (:data:`ANCHORS`), or the last of several in a row; its signature is the anchor and the next :data:`CHAIN` words
   that are not anchors. Where a text ends sooner, the chain is shorter. Menus, lists and numbers have few
   anchors, so the signatures lie in prose. The start of a text counts as a spot too, so every text with a word has a signature.
2. A text's fingerprint is the set of its signatures, each as the first twelve hex digits of its MD5, in ascending order. It depends on
   the text only, after lower-casing and up to white space.
3. Sets are partitioned by their size: partition k holds sizes from ``(1 / LEAST) ** k`` up. Two sets of a similarity of
   ``LEAST`` or more lie in one partition or in neighbouring ones, and their sizes differ by no more than that factor. Pairs that fail this
   are pruned without a look at their elements; the others are compared by exact Jaccard similarity.

Each step is one pattern over the whole text with possessive, bounded repeats, so a text of any shape costs linear time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, German, Spanish and French that open a spot.
ANCHORS = tuple((
    "the of and to a in is that for it was on with be as by this are at from or an "
    "der die und den von zu das sich mit auf des für ist nicht im dem ein eine als "
    "de la que el en y los se del las por un no con su una es para al "
    "le et les du est qui dans par pas au sur pour plus une ce il"
).split())
CHAIN = 3
#: Similarities below this are reported as 0; it bounds the sizes and partitions that are compared.
LEAST = 0.05
#: Hex digits of a signature in a fingerprint.
DIGITS = 12
#: Documents that one range of ids holds on average, and the most ranges. Ranges are what tasks sort.
RANGE_ROWS, MOST_RANGES = 512, 1 << 16

#: Stands before an anchor; in a text it becomes another control character.
_MARK, _NO_MARK = "\x01", "\x02"


def _any_of(words: list[str]) -> str:
    """Pattern for one of the words, which shares their beginnings."""
    if words == [""]:
        return ""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    return "(?:" + "|".join(h + _any_of(rest) if h else "" for h, rest in sorted(heads.items(), reverse=True)) + ")"


def spot_signatures(text: Column, anchors: tuple[str, ...] = ANCHORS) -> Column:
    """The signatures of a text as an array of strings, in order, with repeats: the anchor (nothing for the start of the
    text) and its chain, blank-separated."""
    flat = F.regexp_replace(F.lower(F.replace(text, F.lit(_MARK), F.lit(_NO_MARK))), "[\\t-\\r][ \\t-\\r]*+| [ \\t-\\r]++", " ")
    padded = F.concat(F.lit(" "), F.btrim(flat))
    marked = F.regexp_replace(padded, f" ({_any_of(sorted(set(anchors)))})(?= |\\z)", f" {_MARK}$1")
    # Of anchors in a row the last one counts: all have the same chain.
    single = F.concat(F.lit(_MARK), F.regexp_replace(marked, f"{_MARK}[^ ]++ (?={_MARK})", ""))
    word = f" (?:{_MARK}[^ ]++ )?+[^ {_MARK}][^ ]*+"
    spans = F.regexp_extract_all(single, F.lit(f"(?=({_MARK}[^ ]*+(?:{word}){{0,{CHAIN}}}+)){_MARK}"), 1)
    # Anchors within chains are cut out of all spans in one go.
    chains = F.regexp_replace(F.array_join(spans, "\n"), f" {_MARK}[^ \\n]++", "")
    return F.filter(F.split(F.replace(chains, F.lit(_MARK), F.lit("")), "\n"), lambda s: s != "")


def spot_set(text: Column) -> Column:
    """The distinct signatures as hashes in ascending order; empty for a text without words, null for a null text."""
    hashed = F.transform(spot_signatures(text), lambda s: F.left(F.md5(s.cast("binary")), F.lit(DIGITS)))
    return F.array_sort(F.array_distinct(hashed))


def fingerprint(spots: Column) -> Column:
    """A set of signatures as text: equal sets give equal fingerprints and the other way round."""
    return F.array_join(spots, "")


def partition_of(spots: Column, least: float = LEAST) -> Column:
    """The size partition of a set; empty sets have none."""
    size = F.size(spots)
    return F.when(size > 0, F.floor(F.log(size.cast("double")) / F.lit(-math.log(least)) + 1e-9).cast("int"))


def likeness(one: Column, other: Column, least: float = LEAST) -> Column:
    """Jaccard similarity of two sets, 0 below ``least``. Equal sets have 1, also empty ones."""
    n, m = F.size(one), F.size(other)
    apart = F.abs(partition_of(one, least) - partition_of(other, least)) > 1
    pruned = apart | (F.least(n, m) < least * F.greatest(n, m))
    common = F.size(F.array_intersect(one, other))
    exact = common / (n + m - common)
    return (
        F.when(one == other, F.lit(1.0))
        .when((n == 0) | (m == 0) | pruned, F.lit(0.0))
        .otherwise(F.when(exact >= least, exact).otherwise(F.lit(0.0)))
    )


def _range_of(value: Column, tops: list[int]) -> tuple[Column, Column]:
    """Number of the first of the ascending ``tops`` that a value doesn't exceed, and that top. Two short scans instead of
    one over all tops."""
    step = math.isqrt(len(tops)) + 1
    parts = [tops[i : i + step] for i in range(0, len(tops), step)]

    def longs(values: list[int]) -> Column:
        return F.array(*(F.lit(v).cast("long") for v in values))

    part = F.size(F.filter(longs([p[-1] for p in parts]), lambda v: v < value))
    inner = F.get(F.array(*map(longs, parts)), part)
    place = F.size(F.filter(inner, lambda v: v < value))
    return (part * step + place).cast("int"), F.get(inner, place)


def id_ranges(docs: DataFrame) -> list[int]:
    """Greatest ``doc_id`` of each range of ids, ascending: at most :data:`MOST_RANGES` numbers, whatever the table's size. The
    ranges come from quantiles of all ids; their tops are exact."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    n = min(MOST_RANGES, -(-ids.count() // RANGE_ROWS))
    if not n:
        return []
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n + 1)], max(10_000, 4 * n))).first()[0]
    # Quantiles are taken over doubles; ids above the last of them belong to the last range.
    own, _ = _range_of(F.col("doc_id"), sorted({int(c) for c in cuts})[:-1] or [-(1 << 63)])
    return sorted(row.top for row in ids.groupBy(own.alias("range")).agg(F.max("doc_id").alias("top")).collect())


def in_ranges(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` (null: empty) with ``_range`` and ``_copy``, so that every document stands in one range with the next
    one in descending order of ids.

    The order is cut into ranges (:func:`id_ranges`). The first document of a range also goes, as a copy, to the end of the
    range before it, and the very first to the end of the last: one shuffle of the texts, no join, and no task
    sees the whole order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tops = id_ranges(docs) or [0]
    own, top = _range_of(F.col("doc_id"), tops)
    before = F.when(own == len(tops) - 1, F.lit(0)).otherwise(own + 1)

    def place(number: Column, copy: bool) -> Column:
        return F.struct(number.alias("_range"), F.lit(copy).alias("_copy"))

    apart = F.array(place(-1 - F.pmod(F.xxhash64("text"), F.lit(MOST_RANGES)).cast("int"), False))
    places = (
        F.when(F.col("doc_id").isNull(), apart)
        # Descending, a range begins with its top.
        .when(F.col("doc_id") == top, F.array(place(own, False), place(before, True)))
        .otherwise(F.array(place(own, False)))
    )
    return rows.select(F.explode(places).alias("_place"), "doc_id", "text").select("_place.*", "doc_id", "text")


def spot_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose last half is the beginning of the next document, in
    descending order of ids, the last being followed by the first.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` (likeness to the
    edited text and to the next document), ``n_spots`` and ``spot_partition``. A null text is empty. Texts without
    words have an empty set, like each other and nothing else. Rows with one id follow each other by text, so a repeated row's next is its repetition; a
    row without an id is its own next. A single document is, too. Other columns are ignored; an empty table gives
    no rows. ``docs`` is read three times, twice for the ids alone.
    """
    order = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").desc(), "text")

    def following(name: str) -> Column:
        return F.when(F.col("doc_id").isNull(), F.col(name)).otherwise(F.lead(name).over(order))

    text, after = F.col("text"), F.col("_after")
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    rows = in_ranges(docs).withColumn("_after", following("text"))
    # The last row of a range is a copy, which nothing follows.
    edited = F.concat(F.left(text, n - half), F.left(F.coalesce(after, F.lit("")), half))
    rows = rows.select("_range", "_copy", "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("_edited"))
    rows = rows.select(
        "_range", "_copy", "doc_id", "text", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        spot_set(text).alias("_spots"), F.when(~F.col("_copy"), spot_set(F.col("_edited"))).alias("_edited_spots"),
    )
    rows = rows.withColumn("_next_spots", following("_spots")).where(~F.col("_copy"))
    own = F.col("_spots")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(own).alias("fingerprint"),
        fingerprint(F.col("_edited_spots")).alias("edited_fingerprint"),
        likeness(own, F.col("_edited_spots")).alias("near_edited"),
        likeness(own, F.col("_next_spots")).alias("near_next"),
        F.size(own).cast("long").alias("n_spots"),
        partition_of(own).alias("spot_partition"),
    )


def near_pairs(pairs: DataFrame, docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Likeness of given pairs (``a``, ``b``) of ``doc_id``: pairs of the same or neighbouring size partitions only, the
    others cannot reach ``least``. One row per pair that does."""
    sets = docs.select("doc_id", spot_set(F.coalesce("text", F.lit(""))).alias("_spots"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("_spots").alias("_one"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("_spots").alias("_other"))
    found = pairs.select("a", "b").join(left, "a").join(right, "b")
    return found.select("a", "b", likeness(F.col("_one"), F.col("_other"), least).alias("likeness")).where(F.col("likeness") >= least)
