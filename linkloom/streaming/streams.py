"""Structured Streaming forms of scoring, de-duplication, frontier upkeep and counters.

Stores fed by a stream are append-only logs with one directory per micro-batch. A store belongs to one
checkpoint: a batch that is replayed after a failure finds its directory committed and leaves it alone, so nothing is
counted twice, and a batch costs what it holds, not what the store holds. Readers see committed batches only. Reading
a store folds the log by the same rule as the batch operator; :func:`compact` does that once for all later readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import is_relevant_content
from ..operators.content import analyze_content
from ..operators.frontier import add_to_frontier
from ..operators.pages import fold_pages, page_rows, upsert_pages
from ..schemas import ERROR, FETCH_FAILED, FRONTIER, IRRELEVANT_TYPE, PAGES, PROCESSED, SKIPPED
from ..session import drop_path
from ..sources.tables import committed_numbers, current_version, read_table, write_table

LOG, FOLDED = "log", "folded"
# Captures that were stored and those that weren't, as folders of a batch.
KIND, PAGE, FAULT = "kind", "page", "fault"
SCORED = T.StructType([f for f in PAGES.fields if f.name != "content"]).add("reason", "string")


def _start(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _append(rows: DataFrame, root: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write a micro-batch unless an earlier attempt has committed it."""
    if batch_id not in committed_numbers(rows.sparkSession, f"{root}/{LOG}", "batch_id"):
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/{LOG}/batch_id={batch_id}")


def _read_batches(spark: SparkSession, root: str, after: int, schema: T.StructType) -> DataFrame:
    """Committed batches with a greater number, with their ``batch_id`` and what else they are partitioned by."""
    numbers = [n for n in committed_numbers(spark, f"{root}/{LOG}", "batch_id") if n > after]
    schema = T.StructType(list(schema.fields)).add("batch_id", T.IntegerType())
    if not numbers:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{LOG}/batch_id={n}" for n in numbers]
    return spark.read.schema(schema).option("basePath", f"{root}/{LOG}").parquet(*paths)


def stream_score(
    captures: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Score a stream of captures into the page store at ``root``; the page text is not kept.

    Failed fetches and irrelevant content types never reach the pages, so they replace nothing; they go
    to a log of their own (:func:`read_faults`). A micro-batch is read once and written once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _append(scored_batch(batch), root, batch_id, (KIND,))

    return _start(captures, write, checkpoint, trigger)


def scored_batch(captures: DataFrame) -> DataFrame:
    """Page rows with ``kind``, and ``reason`` for what must not be stored: of that only the URL counts, its text is
    left out before it is looked at."""
    fault = F.when(F.col("html").isNull(), FETCH_FAILED).when(
        ~is_relevant_content(F.col("content_type")), IRRELEVANT_TYPE
    )
    judged = captures.withColumn("reason", fault).withColumn(
        "html", F.when(F.col("reason").isNull(), F.col("html"))
    )
    kind = F.when(F.col("reason").isNull(), PAGE).otherwise(FAULT)
    return page_rows(analyze_content(judged), ("reason",)).withColumn(KIND, kind)


def _read_kind(spark: SparkSession, root: str, after: int, kind: str) -> DataFrame:
    schema = T.StructType(list(SCORED.fields)).add(KIND, "string")
    # A batch that is not partitioned holds pages only.
    rows = _read_batches(spark, root, after, schema)
    return rows.filter(F.coalesce(KIND, F.lit(PAGE)) == kind).drop(KIND)


def read_faults(spark: SparkSession, root: str) -> DataFrame:
    """``url, reason, batch_id`` of the captures that were not stored."""
    return _read_kind(spark, root, -1, FAULT).select("url", "reason", "batch_id")


def _folded(spark: SparkSession, root: str) -> tuple[int, DataFrame | None]:
    """Last compacted batch and the table up to it."""
    upto = current_version(spark, f"{root}/{FOLDED}")
    if upto is None:
        return -1, None
    return upto, read_table(spark, f"{root}/{FOLDED}", version=upto)


def read_scored(spark: SparkSession, root: str) -> DataFrame:
    """Current pages of the store: the last batch wins, the first origin stays."""
    upto, folded = _folded(spark, root)
    newer = _read_kind(spark, root, upto, PAGE).drop("reason")
    if folded is None:
        return fold_pages(newer, "batch_id")
    return upsert_pages(folded.withColumn("batch_id", F.lit(upto)), newer, "batch_id").drop(
        "batch_id"
    )


def stream_frontier(
    links: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream of frontier rows to the frontier store at ``root``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _append(batch, root, batch_id)

    return _start(links.select(*FRONTIER.fieldNames()), write, checkpoint, trigger)


def read_frontier(spark: SparkSession, root: str) -> DataFrame:
    """Current frontier of the store. A URL keeps the values of the first batch that had it: the batch
    number takes the place of ``seq``."""
    upto, folded = _folded(spark, root)
    if folded is None:
        folded = spark.createDataFrame([], FRONTIER)
    newer = _read_batches(spark, root, upto, FRONTIER)
    return add_to_frontier(folded, newer.withColumn("seq", F.col("batch_id").cast("long")))


def compact(
    spark: SparkSession, root: str, read: Callable[[SparkSession, str], DataFrame]
) -> None:
    """Fold the log of a store so that readers start from there, and drop what was folded.

    ``read`` is :func:`read_scored`, :func:`read_frontier` or :func:`read_unique`. The new version carries the number of
    the last batch in it; call this between micro-batches, while nobody reads. Faults are not folded and stay.
    """
    numbers = committed_numbers(spark, f"{root}/{LOG}", "batch_id")
    if not numbers:
        return
    write_table(read(spark, root), f"{root}/{FOLDED}", version=numbers[-1])
    for n in numbers:
        folded = f"{root}/{LOG}/batch_id={n}"
        drop_path(spark, f"{folded}/{KIND}={PAGE}" if read is read_scored else folded)


def stream_dedup(captures: DataFrame, delay: str | None = None) -> DataFrame:
    """Streaming captures without repeated bodies; which copy stays depends on arrival.

    Hash and size stand for the body: the page text goes no further than the scan. Seen hashes are kept for the
    life of the stream. With ``delay`` (needs ``captured_at``) they expire, which bounds the state and lets a copy
    through that comes later than that.
    """
    hashed = captures.withColumns(
        {"hash": F.md5("html"), "size": F.octet_length("html").cast("long")}
    ).drop("html")
    if delay is None:
        return hashed.dropDuplicates(["hash"])
    return hashed.withWatermark("captured_at", delay).dropDuplicatesWithinWatermark(["hash"])


def stream_unique(
    captures: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Captures without bodies that were seen before, however long ago, into the store at ``root``.

    The store is the memory: a micro-batch loses its own copies (the smallest row stays) and then those whose hash
    an earlier batch has. So the stream keeps no state, nothing expires and no late copy passes. The hashes that a batch
    shares with the store are found first: of the store only the hash column is read, and where the batch is small Spark sends
    its hashes to that scan, so that the store isn't shuffled. Hash and size stand for the body, as in :func:`stream_dedup`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _hashed(batch)
        others = [c for c in rows.columns if c != "hash"]
        # A hash that came very often reaches its reducer as one row per task.
        first = rows.groupBy("hash").agg(F.min(F.struct(*others)).alias("_first"))
        spark = batch.sparkSession
        earlier = [n for n in committed_numbers(spark, f"{root}/{LOG}", "batch_id") if n < batch_id]
        if earlier or current_version(spark, f"{root}/{FOLDED}") is not None:
            known = read_unique(spark, root).where(F.col("batch_id") < batch_id).select("hash")
            common = known.join(rows.select("hash"), "hash", "left_semi")
            first = first.join(common, "hash", "left_anti")
        _append(first.select("hash", *(F.col(f"_first.{c}").alias(c) for c in others)), root, batch_id)

    return _start(captures, write, checkpoint, trigger)


def _hashed(captures: DataFrame) -> DataFrame:
    """Captures with hash and size of their body in its place; a failed fetch has no body and is left out."""
    return captures.where("html is not null").withColumns(
        {"hash": F.md5("html"), "size": F.octet_length("html").cast("long")}
    ).drop("html")


def read_unique(spark: SparkSession, root: str) -> DataFrame:
    """The rows that :func:`stream_unique` has kept, with the ``batch_id`` that brought them."""
    upto, folded = _folded(spark, root)
    numbers = [n for n in committed_numbers(spark, f"{root}/{LOG}", "batch_id") if n > upto]
    paths = [f"{root}/{LOG}/batch_id={n}" for n in numbers]
    newer = spark.read.option("basePath", f"{root}/{LOG}").parquet(*paths) if paths else None
    if folded is None or newer is None:
        found = folded if newer is None else newer
        if found is None:
            raise FileNotFoundError(f"no committed batch in {root}")
        return found
    return folded.unionByName(newer)


def stream_stats(
    outcomes: DataFrame, window: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Running counters per strategy; with ``window`` per time window, closed by a watermark."""
    keys = [F.col("strategy")]
    if window:
        outcomes = outcomes.withWatermark("ts", delay)
        keys.insert(0, F.window("ts", window).alias("window"))
    processed = F.col("outcome") == PROCESSED
    return outcomes.groupBy(*keys).agg(
        F.count_if(processed).alias("pages_processed"),
        F.count_if(F.col("outcome") == SKIPPED).alias("pages_skipped"),
        F.count_if(F.col("outcome") == ERROR).alias("errors"),
        F.coalesce(F.sum(F.when(processed, F.col("size"))), F.lit(0)).alias("total_size"),
    )
