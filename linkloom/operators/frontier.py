"""The crawl frontier: one row per URL, kept by aggregation and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scoring import MAX_PRIORITY
from ..schemas import COMPLETED, CONTEXT, FRONTIER, PENDING
from ..session import stored


def seed_frontier(seeds: DataFrame, priority: int = MAX_PRIORITY) -> DataFrame:
    """Frontier rows for start URLs at depth 0; seeds are taken as they are, unvalidated.

    ``seeds`` has ``url`` and may have ``seq`` and ``scheduled_at``. Priority 0 gives the
    breadth-first flavour.
    """
    context = F.struct(
        F.lit(1.0).alias("importance"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("double").alias("link_density"),
    )
    values = {
        "url": F.col("url"),
        "priority": F.lit(priority),
        "depth": F.lit(0),
        "parent_url": F.lit(None),
        "scheduled_at": F.col("scheduled_at") if "scheduled_at" in seeds.columns else F.lit(None),
        "seq": F.col("seq") if "seq" in seeds.columns else F.lit(0),
        "status": F.lit(PENDING),
        "context": context if priority else F.lit(None).cast(CONTEXT),
    }
    return seeds.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in FRONTIER.fields))


def frontier_rows(links: DataFrame, seq: Column, scheduled_at: Column) -> DataFrame:
    """Scored links as frontier rows.

    ``seq`` only has to grow from one merge to the next; among links of one merge the smallest
    depth and parent URL count as first.
    """
    stamped = links.withColumns({"seq": seq, "scheduled_at": scheduled_at})
    return stamped.select(*(F.col(f.name).cast(f.dataType) for f in FRONTIER.fields))


def add_to_frontier(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """Merge links into the frontier by URL.

    A repeated URL gets the greatest priority and keeps everything else from its row in the
    frontier or, for a new URL, from the link with the smallest ``seq``. So a completed URL stays
    completed whatever ``seq`` the links carry. The aggregation combines repeats before the shuffle.
    """
    rows = frontier.withColumn("_new", F.lit(False)).unionByName(
        links.select(*frontier.columns).withColumn("_new", F.lit(True))
    )
    first = ["_new", "seq", *[c for c in frontier.columns if c not in ("url", "priority", "seq")]]
    merged = rows.groupBy("url").agg(
        F.max("priority").alias("priority"), F.min(F.struct(*first)).alias("_first")
    )
    return merged.select(
        *(c if c in ("url", "priority") else F.col(f"_first.{c}").alias(c)
          for c in frontier.columns)
    )


def within_depth(frontier: DataFrame, max_depth: int) -> DataFrame:
    return frontier.filter(F.col("depth") <= max_depth)


def next_urls(frontier: DataFrame, k: int) -> DataFrame:
    """The ``k`` best pending URLs: highest priority, earliest scheduled, then URL. See :func:`best_urls`."""
    return best_urls(frontier, k)[0]


def best_urls(frontier: DataFrame, k: int) -> tuple[DataFrame, str]:
    """The ``k`` best pending URLs, and the path of a table in the shared folder that they read, for removal afterwards.

    One way for every ``k``. Rows are counted per priority; priorities wholly inside the batch are taken as
    they are. Only the priority at the border is range-sorted, written to the shared folder and numbered partition by
    partition, so no task and no driver sees the batch. The two windows without a partition key run over one
    row per priority and one row per partition.
    """
    pending = frontier.filter(F.col("status") == PENDING)
    counts = pending.groupBy("priority").agg(F.count("*").alias("_n"))
    better = Window.orderBy(F.col("priority").desc()).rowsBetween(Window.unboundedPreceding, -1)
    wanted = counts.withColumn("_before", F.coalesce(F.sum("_n").over(better), F.lit(0)))
    near = pending.join(wanted.filter(F.col("_before") < k), "priority")
    inside = F.col("_before") + F.col("_n") <= k
    order = [F.col("scheduled_at").asc(), F.col("url").asc()]
    border = near.filter(~inside).repartitionByRange(*order)
    border, path = stored(border.withColumn("_part", F.spark_partition_id()), "border")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = border.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_earlier")
    )
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    chosen = (
        border.withColumn("_rank", rank).join(parts, "_part")
        .filter(F.col("_before") + F.col("_earlier") + F.col("_rank") <= k)
    )
    columns = frontier.columns
    return near.filter(inside).select(*columns).unionByName(chosen.select(*columns)), path


def combined_links(links: DataFrame) -> DataFrame:
    """One row per URL of links that one merge would add: what the merge keeps of them."""
    return add_to_frontier(links.limit(0), links)


def fold_frontier(frontier: DataFrame, merges: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The frontier after merges in order, each given by its links and the URLs completed with it: the same as
    :func:`add_to_frontier` and :func:`mark_processed` one after the other, in one aggregation.
    """
    others = [c for c in frontier.columns if c not in ("url", "priority")]

    def rows(df: DataFrame, number: int) -> DataFrame:
        # Earlier merges first, then the smallest seq.
        first = F.struct(F.lit(number).alias("_merge"), "seq", *(c for c in others if c != "seq"))
        return df.select("url", "priority", first.alias("_first"), F.lit(False).alias("_done"))

    log = rows(frontier, 0)
    for number, (links, done) in enumerate(merges, 1):
        log = log.unionByName(rows(links, number)).unionByName(
            done.select("url", F.lit(True).alias("_done")), allowMissingColumns=True
        )
    folded = log.groupBy("url").agg(
        F.max("priority").alias("priority"), F.min("_first").alias("_first"), F.max("_done").alias("_done")
    ).where(F.col("_first").isNotNull())
    status = F.when(F.col("_done"), F.lit(COMPLETED)).otherwise(F.col("_first.status")).alias("status")
    return folded.select(
        *(c if c in ("url", "priority") else status if c == "status" else F.col(f"_first.{c}").alias(c)
          for c in frontier.columns)
    )


def mark_processed(frontier: DataFrame, urls: DataFrame) -> DataFrame:
    """Frontier with the given URLs completed, whatever their outcome was."""
    done = urls.select("url").distinct().withColumn("_done", F.lit(True))
    status = F.when(F.col("_done"), F.lit(COMPLETED)).otherwise(F.col("status"))
    return (
        frontier.join(done, "url", "left").withColumn("status", status).select(*frontier.columns)
    )


def drop_crawled(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows whose URL has not been stored yet."""
    return frontier.join(pages.select("url"), "url", "left_anti")


def already_crawled(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows that :func:`drop_crawled` leaves out."""
    return frontier.join(pages.select("url"), "url", "left_semi")


def drop_visited(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct link URLs not visited before; plain string comparison, no normalisation."""
    return links.select("url").distinct().join(visited.select("url"), "url", "left_anti")
