"""Time the headline queries.

Prints one JSON line. ``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores. Each
query is run once to warm up and then timed to the last row, without collecting it.
"""

from __future__ import annotations

import json
import os
import re
import time

from linkloom.session import build_session
from verification.queries import QUERIES

HEADLINE = (
    "page_scores", "page_features", "extracted_links", "scored_links", "page_links",
    "dedup_content", "similar_content", "outcomes", "crawled_split", "upsert_pages",
    "frontier_merge", "next_urls", "bfs_depths", "expand_frontier_1", "crawl_stats",
    "compare_strategies", "crawl_metrics", "quality_report", "format_bytes", "stream_score",
    "stream_dedup", "stream_frontier", "stream_stats",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "pages": pages,
                "pages_scored_per_second": round(pages / seconds["page_scores"], 1)
                if "page_scores" in seconds else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
