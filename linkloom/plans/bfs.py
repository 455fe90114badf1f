"""Breadth-first reachability over a link graph."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..session import drop_path, scratch_path, stored

# Out-links that one share of a page holds; a page with more is a hub and has as many shares as it needs.
SHARE_EDGES = 100_000
# Edges that one bucket should hold when the number of buckets is not given.
BUCKET_EDGES = 5_000_000


def _bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: list[str]) -> None:
    """Add rows to a table in the shared folder that is bucketed by ``keys``."""
    (
        df.repartition(buckets, *keys)
        .write.mode("append")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )


def bfs_depths(
    edges: DataFrame, seeds: DataFrame, max_depth: int, buckets: int | None = None,
    share_edges: int = SHARE_EDGES,
) -> DataFrame:
    """``url, depth, parent_url`` of everything within ``max_depth`` links of the seeds.

    ``edges`` has ``src, dst``; ``seeds`` has ``url``. Each URL gets its first depth and,
    among its parents one level up, the smallest. Level-synchronous: one level is joined with
    the edges at a time, and repeated targets are combined before their shuffle.

    Out-links are counted once. Only pages with more than ``share_edges`` are split, by target and into as many shares as
    their count asks for, so no task gets more of a hub than that, and other pages meet the level as they are.

    Edges and visited URLs are tables bucketed alike (``buckets``, by default from the number of edges), so neither
    is shuffled again: only the level and its targets move. A level is appended to the visited
    table, which is also the result, so the plan does not grow and a lost executor costs no more than the level
    at hand. The driver only learns whether a level is empty. The edge table and all catalog entries are
    removed at the end, also after a failure; the visited files stay for the result.
    """
    spark = edges.sparkSession
    run = uuid.uuid4().hex
    edge_name, seen_name = f"edges_{run}", f"visited_{run}"
    edge_path, seen_path = scratch_path(spark, "bfs-edges"), scratch_path(spark, "bfs-visited")
    hub_path = scratch_path(spark, "bfs-hubs")
    try:
        links = edges.select("src", "dst").dropna(subset=["src", "dst"])
        links, raw_path = stored(links, "bfs-links")
        if buckets is None:
            parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
            buckets = max(parallel, -(-links.count() // BUCKET_EDGES))
        hub_shares(links, share_edges).write.parquet(hub_path)
        hubs = spark.read.schema("src string, shares long").parquet(hub_path)
        salt = F.pmod(F.xxhash64("dst"), F.coalesce("shares", F.lit(1))).cast("int")
        links = links.join(hubs, "src", "left").select("src", "dst", salt.alias("salt"))
        _bucketed(links, edge_name, edge_path, buckets, ["src", "salt"])
        drop_path(spark, raw_path)
        level = seeds.select("url").distinct().select(
            "url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent_url")
        )
        _bucketed(level, seen_name, seen_path, buckets, ["url"])
        for depth in range(1, max_depth + 1):
            fresh = _next_level(spark.table(edge_name), spark.table(seen_name), hubs, depth)
            fresh, fresh_path = stored(fresh, "bfs-level")
            found = not fresh.isEmpty()
            if found:
                _bucketed(fresh, seen_name, seen_path, buckets, ["url"])
            drop_path(spark, fresh_path)
            if not found:
                break
        schema = spark.table(seen_name).schema
    finally:
        for name in (edge_name, seen_name):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(spark, edge_path)
        drop_path(spark, hub_path)
    return spark.read.schema(schema).parquet(seen_path)


def hub_shares(links: DataFrame, share_edges: int) -> DataFrame:
    """``src, shares`` of the pages with more than ``share_edges`` links; the counts combine before their shuffle."""
    counts = links.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") > share_edges)
    return counts.select("src", F.ceil(F.col("n") / share_edges).cast("long").alias("shares"))


def _next_level(links: DataFrame, visited: DataFrame, hubs: DataFrame, depth: int) -> DataFrame:
    """URLs first reached at ``depth``, given everything visited before."""
    level = visited.filter(F.col("depth") == depth - 1).select(F.col("url").alias("src")).join(hubs, "src", "left")
    salts = F.sequence(F.lit(0), (F.coalesce("shares", F.lit(1)) - 1).cast("int"))
    reached = (
        links.join(level.select("src", F.explode(salts).alias("salt")), ["src", "salt"])
        .groupBy(F.col("dst").alias("url"))
        .agg(F.min("src").alias("parent_url"))
    )
    fresh = reached.join(visited.select("url"), "url", "left_anti")
    return fresh.select("url", F.lit(depth).alias("depth"), "parent_url")
