import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from linkloom.functions import report_texts as R
from linkloom.plans import reports

SCHEMA = (
    "url string, strategy string, outcome string, reason string, size long, load_time_ms long, "
    "ts timestamp"
)
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _log(spark):
    rows = []
    for i in range(30):
        rows.append((f"u{i}", "traditional", "processed", None, 1024, 10, T0 + timedelta(minutes=i)))
    for i in range(45):
        outcome, reason = ("skipped", "duplicate_content") if i % 9 == 0 else ("processed", None)
        rows.append((f"v{i}", "smart", outcome, reason, 2048, 30, T0 + timedelta(minutes=i / 2)))
    rows.append(("e", "traditional", "error", "fetch_failed", None, None, T0))
    return spark.createDataFrame(rows, SCHEMA)


def test_stats_and_reasons(spark):
    got = {r.strategy: tuple(r)[1:] for r in reports.crawl_stats(_log(spark)).collect()}
    assert got == {"traditional": (30, 0, 1, 30720), "smart": (40, 5, 0, 81920)}
    assert [tuple(r) for r in reports.skip_reasons(_log(spark)).collect()] == [
        ("smart", "duplicate_content", 5)
    ]


def test_average_load_time_is_of_times_not_bytes(spark):
    got = {r.strategy: tuple(r)[1:] for r in reports.avg_load_time(_log(spark)).collect()}
    assert got == {"traditional": (10.0, 1024.0), "smart": (30.0, 2048.0)}


def test_throughput(spark):
    got = {r.strategy: r.pages_per_second for r in reports.throughput(_log(spark)).collect()}
    assert got == {"traditional": 30 / 1740.0, "smart": 40 / 1320.0}
    single = _log(spark).limit(1)
    assert reports.throughput(single).first().pages_per_second is None


def test_comparison(spark):
    got = {r.metric: tuple(r)[1:] for r in reports.compare_strategies(_log(spark)).collect()}
    assert got["pages_processed"] == (30.0, 40.0, 10 / 30 * 100, "+33.3%")
    assert got["pages_skipped"] == (0.0, 5.0, None, "N/A")
    assert got["errors"] == (1.0, 0.0, 100.0, "+100.0%")
    assert got["duration_seconds"][3] == "+24.1%"
    assert got["total_size"][3] == "+166.7%"
    assert set(got) == {
        "pages_processed", "pages_skipped", "errors", "duration_seconds", "total_size",
        "pages_per_second",
    }


def test_metrics_per_window(spark):
    got = reports.crawl_metrics(_log(spark), "10 minutes").collect()
    first = [r for r in got if r.window_start == min(x.window_start for x in got)]
    assert {(r.outcome, r.reason, r.n, r.per_second) for r in first} == {
        ("processed", None, 27, 27 / 600.0), ("skipped", "duplicate_content", 3, 3 / 600.0),
        ("error", "fetch_failed", 1, 1 / 600.0),
    }


def test_quality_report(spark):
    pages = spark.createDataFrame(
        [("a", 0.5), ("a", 0.5), ("b", 1.0), ("c", 0.0)], "hash string, content_quality double"
    )
    assert tuple(reports.quality_report(pages).first()) == (4, 3, 0.5, 0.25)
    assert reports.quality_report(pages.filter("false")).first().avg_content_quality is None


def test_improvement(evaluate):
    cases = {
        (0, 5): ("N/A", "N/A"), (10, 15): ("+50.0%", "-50.0%"), (10, 5): ("-50.0%", "+50.0%"),
        (10, 10): ("0%", "0%"), (3000, 3001): ("+0.0%", "-0.0%"), (3, 4): ("+33.3%", "-33.3%"),
        (800, 801): ("+0.1%", "-0.1%"), (80, 81): ("+1.2%", "-1.2%"), (80, 83): ("+3.8%", "-3.8%"),
    }
    got = evaluate(
        list(cases), "b long, n long",
        R.improvement_text(R.improvement_pct(F.col("b"), F.col("n"))),
        R.improvement_text(R.improvement_pct_reverse(F.col("b"), F.col("n"))),
    )
    assert dict(zip(cases, got)) == cases


def test_bytes(evaluate):
    cases = {
        0: "0 B", 1023: "1023 B", 1024: "1.0 KB", 1536: "1.5 KB", 1048575: "1024.0 KB",
        1048576: "1.0 MB", 1280: "1.2 KB", 1792: "1.8 KB", 2**40: "1.0 TB", 2**50: "1.0 PB",
        2**60: "1.0 EB", 2**63 - 1: "8.0 EB", 5 * 2**30 + 2**29: "5.5 GB",
    }
    got = evaluate([(n,) for n in cases], "n long", R.format_bytes(F.col("n")))
    assert dict(zip(cases, got)) == cases


def test_one_decimal_rounds_the_exact_value(evaluate):
    rng = random.Random(8)
    values = [rng.random() * 10 ** rng.randint(-3, 9) for _ in range(3000)]
    values += [i / 20 for i in range(400)] + [i / 4 for i in range(50)]
    values += [0.0, 2.0**60, 1e15, 2.0**63 * 100, 2.0**53 - 1, 2.0**50 + 0.25, 9.96, 99.95]
    got = evaluate([(v,) for v in values], "v double", R.one_decimal(F.col("v")))
    assert got == [f"{v:.1f}" for v in values]
