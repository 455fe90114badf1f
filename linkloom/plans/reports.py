"""Crawl reports over outcome and page tables. All are partial-then-final hash aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import report_texts as R
from ..schemas import ERROR, PROCESSED, SKIPPED

BASELINE, CANDIDATE = "traditional", "smart"


def _counters() -> list[Column]:
    processed = F.col("outcome") == PROCESSED
    return [
        F.count_if(processed).alias("pages_processed"),
        F.count_if(F.col("outcome") == SKIPPED).alias("pages_skipped"),
        F.count_if(F.col("outcome") == ERROR).alias("errors"),
        F.coalesce(F.sum(F.when(processed, F.col("size"))), F.lit(0)).alias("total_size"),
    ]


def crawl_stats(outcomes: DataFrame) -> DataFrame:
    """Run counters per strategy; only processed pages add to the size."""
    return outcomes.groupBy("strategy").agg(*_counters())


def skip_reasons(outcomes: DataFrame) -> DataFrame:
    skipped = outcomes.filter(F.col("outcome") == SKIPPED)
    return skipped.groupBy("strategy", "reason").agg(F.count(F.lit(1)).alias("n"))


def avg_load_time(outcomes: DataFrame) -> DataFrame:
    """Mean load time and mean size of processed pages."""
    return outcomes.filter(F.col("outcome") == PROCESSED).groupBy("strategy").agg(
        F.avg("load_time_ms").alias("avg_load_time_ms"), F.avg("size").alias("avg_size")
    )


def _span_micros() -> Column:
    ts = F.col("ts").cast("timestamp")
    return F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))


def throughput(outcomes: DataFrame) -> DataFrame:
    """Processed pages per second of each strategy's run; NULL when the run has no length."""
    totals = outcomes.groupBy("strategy").agg(
        F.count_if(F.col("outcome") == PROCESSED).alias("pages_processed"),
        _span_micros().alias("duration_us"),
    )
    seconds = F.col("duration_us") / F.lit(1e6)
    rate = F.when(F.col("duration_us") > 0, F.try_divide(F.col("pages_processed"), seconds))
    return totals.withColumn("pages_per_second", rate)


def compare_strategies(outcomes: DataFrame) -> DataFrame:
    """One row per metric with both strategies' values and the improvement.

    Errors and duration improve by falling; skipped pages are listed without a verdict.
    """
    stats = outcomes.groupBy("strategy").agg(*_counters(), _span_micros().alias("duration_us"))
    rate = F.when(
        F.col("duration_us") > 0,
        F.try_divide(F.col("pages_processed"), F.col("duration_us") / F.lit(1e6)),
    )
    metrics = {
        "pages_processed": F.col("pages_processed"),
        "pages_skipped": F.col("pages_skipped"),
        "errors": F.col("errors"),
        "duration_seconds": F.col("duration_us") / F.lit(1e6),
        "total_size": F.col("total_size"),
        "pages_per_second": rate,
    }
    entries = F.array(
        *(F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
          for name, value in metrics.items())
    )
    long = stats.select("strategy", F.inline(entries))
    wide = long.groupBy("metric").pivot("strategy", [BASELINE, CANDIDATE]).agg(F.first("value"))
    falling = F.col("metric").isin("errors", "duration_seconds")
    base, new = F.col(BASELINE), F.col(CANDIDATE)
    pct = (
        F.when(F.col("metric") == "pages_skipped", F.lit(None).cast("double"))
        .when(falling, R.improvement_pct_reverse(base, new))
        .otherwise(R.improvement_pct(base, new))
    )
    return wide.withColumn("improvement_pct", pct).withColumn(
        "improvement", R.improvement_text(F.col("improvement_pct"))
    )


def crawl_metrics(outcomes: DataFrame, window: str = "1 hour") -> DataFrame:
    """Per time window: pages per second, and counts of each reason for not processing."""
    bucket = F.window(F.col("ts").cast("timestamp"), window)
    counted = outcomes.groupBy(bucket.alias("w"), "outcome", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )
    seconds = (F.unix_micros("w.end") - F.unix_micros("w.start")) / F.lit(1e6)
    return counted.select(
        F.col("w.start").alias("window_start"), "outcome", "reason", "n",
        (F.col("n") / seconds).alias("per_second"),
    )


def quality_report(pages: DataFrame) -> DataFrame:
    """Mean quality and share of duplicate bodies over a page table.

    Distinct bodies are counted by grouping on the hash first, which combines copies early.
    """
    per_hash = pages.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.sum("content_quality").alias("quality")
    )
    pages_n = F.sum("n")
    return per_hash.agg(
        pages_n.alias("pages"),
        F.count("hash").alias("distinct_bodies"),
        F.try_divide(F.sum("quality"), pages_n).alias("avg_content_quality"),
        (F.lit(1.0) - F.try_divide(F.count("hash"), pages_n)).alias("duplicate_share"),
    )
