"""What became of each captured URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.urls import is_relevant_content
from ..schemas import (
    ALREADY_CRAWLED, DUPLICATE, ERROR, FETCH_FAILED, IRRELEVANT_TYPE, NOT_CAPTURED, PROCESSED,
    SKIPPED,
)


def drop_irrelevant(captures: DataFrame) -> DataFrame:
    """Captures with a content type worth analysing; a missing type is irrelevant."""
    return captures.filter(is_relevant_content(F.col("content_type")))


def capture_facts(captures: DataFrame) -> DataFrame:
    """Captures without their text: what :func:`classify_outcomes` needs to decide."""
    return captures.withColumns(
        {
            "hash": F.md5("html"),
            "size": F.octet_length("html").cast("long"),
            "fetched": F.col("html").isNotNull(),
        }
    ).drop("html")


def only_keys_of(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The distinct keys of ``table`` that ``batch`` has as well.

    The table is on the side that streams: Spark broadcasts the batch's keys where they are few, or makes a Bloom filter of
    them where both are large, and either drops the other keys in the scan, before any shuffle.
    """
    return table.select(key).join(batch.select(key), key, "left_semi").distinct()


def classify_outcomes(
    facts: DataFrame, pages: DataFrame, seen: DataFrame | None = None
) -> DataFrame:
    """One outcome per URL: crawled before, failed, irrelevant, duplicate or processed.

    ``facts`` has ``url, hash, size, fetched, content_type, load_time_ms, captured_at, strategy,
    depth, priority, seq``; a ``captured`` flag marks rows without any capture. The tests apply in
    that order, and only rows that pass the first three compete for a content hash. Hashes in
    ``seen`` were processed earlier in the same crawl and beat all others.

    Repeated URLs are combined before the one shuffle of the facts. The winner of each hash comes from an
    aggregation, which combines copies early, and goes back to the facts by URL, where they already are; all
    joins are on keys that are unique on one side. Nothing is ranked within a hash.

    ``pages`` and ``seen`` may be far larger than the facts. Only those of their keys that the facts have take part
    (see :func:`only_keys_of`), so a stored batch that is small enough for Spark to broadcast moves nothing else of either table.
    """
    if "captured" not in facts.columns:
        facts = facts.withColumn("captured", F.lit(True))
    order = F.struct("depth", (-F.col("priority")).alias("_rank"), "seq")
    carried = [c for c in facts.columns if c != "url"]
    single = facts.groupBy("url").agg(
        F.min(F.struct(order.alias("_order"), *carried)).alias("_row")
    ).select("url", *(f"_row.{c}" for c in carried))
    known = only_keys_of(pages, single, "url").withColumn("_known", F.lit(True))
    flagged = single.join(known, "url", "left").withColumn(
        "_reason",
        F.when(F.col("_known"), ALREADY_CRAWLED)
        .when(~F.col("captured"), NOT_CAPTURED)
        .when(~F.col("fetched"), FETCH_FAILED)
        .when(~is_relevant_content(F.col("content_type")), IRRELEVANT_TYPE),
    )
    eligible = flagged.filter(F.col("_reason").isNull())
    rank = F.struct("depth", (-F.col("priority")).alias("_rank"), "seq", "url")
    winners = eligible.groupBy("hash").agg(F.min(rank).alias("_first"))
    if seen is not None:
        winners = winners.join(only_keys_of(seen, winners, "hash"), "hash", "left_anti")
    winners = winners.select(F.col("_first.url").alias("url"), F.lit(True).alias("_wins"))
    decided = flagged.join(winners, "url", "left").withColumn(
        "reason",
        F.coalesce(F.col("_reason"), F.when(F.col("_wins").isNull(), F.lit(DUPLICATE))),
    )
    outcome = (
        F.when(F.col("reason").isNull(), PROCESSED)
        .when(F.col("reason").isin(NOT_CAPTURED, FETCH_FAILED), ERROR)
        .otherwise(SKIPPED)
    )
    return decided.select(
        "url", "strategy", outcome.alias("outcome"), "reason", "size", "load_time_ms",
        F.col("captured_at").alias("ts"),
    )
