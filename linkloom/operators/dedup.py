"""Exact duplicates by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SIMILAR_LIMIT = 5


def drop_duplicate_content(captures: DataFrame) -> DataFrame:
    """First capture per content hash in the order depth, highest priority, ``seq``, URL.

    Needs ``hash, depth, priority, seq, url``; carries the other columns along, so give it narrow
    rows (no page text). ``min`` over a struct combines copies before the shuffle: a hash shared
    by a third of all pages reaches its reducer as one row per map task.
    """
    order = ["depth", "_rank", "seq", "url"]
    carried = [c for c in captures.columns if c not in ("hash", "depth", "seq", "url")]
    first = (
        captures.withColumn("_rank", -F.col("priority"))
        .groupBy("hash")
        .agg(F.min(F.struct(*order, *carried)).alias("_first"))
    )
    return first.select(
        *(c if c == "hash" else F.col(f"_first.{c}").alias(c) for c in captures.columns)
    )


def similar_by_hash(pages: DataFrame, content_hash: str, k: int = SIMILAR_LIMIT) -> DataFrame:
    """At most ``k`` pages with the given hash, smallest ids first."""
    return (
        pages.filter(F.col("hash") == content_hash)
        .select("page_id", "url", "title", "hash")
        .orderBy("page_id")
        .limit(k)
    )


def similar_content(pages: DataFrame, k: int = SIMILAR_LIMIT) -> DataFrame:
    """For every page the first ``k`` other pages with the same hash, by id.

    The ``k + 1`` smallest ids of a hash hold the answer for each of its pages, so pairs of copies
    are never formed. Ids are ranked among the copies of a hash in one input split, and then among the
    leaders of the splits: the shares of a much-copied hash grow with the data. Every page is then joined with its
    hash's list. The lists are grouped by one column more than the join, so both sides of it are shuffled for
    the join and AQE can split a hash with a third of all pages. The plan is the same for every ``k``.
    """
    rows = pages.select("page_id", "url", "title", "hash").filter(F.col("hash").isNotNull())
    split = Window.partitionBy("hash", "_split").orderBy("page_id")
    overall = Window.partitionBy("hash", "_group").orderBy("page_id")
    leaders = (
        rows.withColumn("_split", F.spark_partition_id())
        .withColumn("_rank", F.row_number().over(split))
        .filter(F.col("_rank") <= k + 1)
        .withColumn("_group", F.substring("hash", 1, 2))
        .withColumn("_rank", F.row_number().over(overall))
        .filter(F.col("_rank") <= k + 1)
    )
    lists = (
        leaders.groupBy("hash", "_group")
        .agg(F.array_sort(F.collect_list(F.struct("page_id", "url", "title"))).alias("members"))
        .filter(F.size("members") > 1)
        .select("hash", "members")
    )
    probes = rows.select(F.col("page_id").alias("probe_id"), "hash")
    others = F.slice(
        F.filter("members", lambda m: m.page_id != F.col("probe_id")), 1, k
    )
    found = probes.join(lists, "hash").select(
        "probe_id", "hash", F.posexplode(others).alias("pos", "m")
    )
    return found.select(
        "probe_id", (F.col("pos") + 1).alias("rank"), "m.page_id", "m.url", "m.title", "hash"
    )
