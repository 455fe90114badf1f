from itertools import product

import pytest
from pyspark.sql import functions as F

from linkloom.functions.scoring import link_priority
from linkloom.operators.links import extract_links, extract_scored_links, page_links
from verification.queries import QUERIES

SPOT = [
    ("read", None, None, 0.5, 60),
    ("Latest News", None, "content", 1.0, 100),
    ("Login", "nofollow", "nav-item", 0.5, 5),
    ("Blog about us", None, None, 0.7999999999999999, 70),
    ("read", "NOFOLLOW", "Article", 0.5, 60),
    ("news news blog", None, None, 0.0, 70),
    ("terms privacy", None, None, 0.0, 35),
    ("login", "nofollow", "menu nav", 0.0, 1),
    ("x", "noopener nofollow", "nav content", 0.0, 25),
]


def _priority(evaluate, rows):
    return evaluate(
        rows, "a string, r string, c string, i double",
        link_priority(F.col("a"), F.col("r"), F.col("c"), F.col("i")),
    )


def test_spot_values(evaluate):
    assert _priority(evaluate, [r[:4] for r in SPOT]) == [r[4] for r in SPOT]


def test_truth_table(evaluate):
    def rule(anchor, rel, css, importance):
        text, css = anchor.lower(), css or ""
        value = 50
        value += 20 * any(w in text for w in ("news", "blog"))
        value -= 15 * any(w in text for w in ("login", "about"))
        value -= 30 * ("nofollow" in (rel or ""))
        value -= 10 * ("nav" in css)
        value += 15 * ("content" in css or "article" in css)
        return min(100, max(1, value + int(importance * 20)))

    rows = list(product(
        ["read", "Latest News", "Login", "Blog about us"],
        [None, "nofollow", "noopener nofollow", "NOFOLLOW"],
        [None, "nav-item", "content", "nav content", "Article"],
        [0.5, 0.7999999999999999, 1.0],
    ))
    got = _priority(evaluate, rows)
    assert got == [rule(*r) for r in rows]
    assert all(1 <= p <= 100 for p in got)


PAGE = """<title>A page about linking</title><body><nav>
<a href="/news/1">One</a><a href="two.html">Two &amp; <b>more</b></a><a name=here>no link</a>
<a href="#top">top</a><a HREF='/doc?x=1&amp;y=2' class="nav" rel=nofollow>Docs</a>
<a href="mailto:a@b.c">mail</a><a href="/a.pdf">pdf</a><a href="http://[bad">bad</a>
<a href>self</a><a href="/news/1">again</a><!-- <a href="/no">no</a> --></nav>"""


@pytest.fixture
def captures(spark):
    return spark.createDataFrame(
        [(1, "http://h/p/q", PAGE), (2, "http://h/news/1", "x"), (3, "http://h/none", None)],
        "page_id long, url string, html string",
    )


def test_links_in_document_order_with_repeats(captures):
    rows = extract_links(captures).orderBy("pos").collect()
    assert [(r.url, r.anchor, r.rel) for r in rows] == [
        ("http://h/news/1", "One", None),
        ("http://h/p/two.html", "Two & more", None),
        ("http://h/p/q#top", "top", None),
        ("http://h/doc?x=1&y=2", "Docs", "nofollow"),
        ("mailto:a@b.c", "mail", None),
        ("http://h/a.pdf", "pdf", None),
        ("http://h/p/q", "self", None),
        ("http://h/news/1", "again", None),
    ]
    assert {r.source_url for r in rows} == {"http://h/p/q"}


def test_scored_links(captures):
    rows = extract_scored_links(captures.withColumn("depth", F.lit(3))).orderBy("pos").collect()
    # Importance: 0.5, title +0.1, nav +0.1, which adds 14 (0.7 * 20) to each priority.
    assert [(r.url, r.priority, r.context.content_type) for r in rows] == [
        ("http://h/news/1", 64, "news"),
        ("http://h/p/two.html", 64, "general"),
        ("http://h/doc?x=1&y=2", 24, "documentation"),
        ("http://h/p/q", 64, "general"),
        ("http://h/news/1", 64, "news"),
    ]
    assert {(r.depth, r.parent_url, r.status) for r in rows} == {(4, "http://h/p/q", "pending")}
    assert all(r.context.importance == r.priority / 100.0 for r in rows)


def test_page_links(captures):
    rows = page_links(captures).orderBy("pos").collect()
    assert [(r.source_id, r.target_id) for r in rows] == [
        (1, 2), (1, None), (1, None), (1, None), (1, None), (1, None), (1, 1), (1, 2)
    ]


def test_each_link_is_resolved_once(captures):
    plan = extract_scored_links(captures)._jdf.queryExecution().executedPlan().treeString()
    assert plan.count("(?is)(?=<)") == 1
    assert plan.count("posexplode") == 1
    # The page text does not pass the explode.
    exploded = next(line for line in plan.splitlines() if "Generate" in line)
    assert "html#" not in exploded.split("], false")[0].rsplit("[", 1)[-1]


def test_a_text_is_searched_once_for_all_its_links(spark, tmp_path):
    """The text is searched below the explodes, and its 18 links get the priorities that they have one by one."""
    schema = "doc_id long, text string, lang string, n_chars long"
    docs = [(1, "a story", "de", 4), (2, "terms", "fr", 5), (2, None, "es", 7), (None, "x", None, None), (3, "\u2003ABOUT", "en", 6)]
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["link_priority"](spark, str(tmp_path))
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    explodes = [n for n, line in enumerate(lines) if "Generate" in line]
    searches = [n for n, line in enumerate(lines) if "documentation" in line]
    assert len(explodes) == 2 and len(searches) == 1 and searches[0] > explodes[-1]
    prefix = {None: "", 0: "", 1: "Latest News ", 2: "Login ", 3: "Blog about us "}
    rel = {"de": "nofollow", "fr": "noopener nofollow", "es": "NOFOLLOW"}
    shapes = [None, "nav-item", "content", "nav content", "Article", "menu"]
    links = [
        (d, s, i, None if text is None else prefix[n if n is None else n % 4] + text, rel.get(lang), css)
        for d, text, lang, n in docs for s, css in enumerate(shapes) for i in (0.5, 0.7999999999999999, 1.0)
    ]
    each = spark.createDataFrame(links, "d long, s long, i double, a string, r string, c string").select(
        "d", "s", "i", link_priority(F.col("a"), F.col("r"), F.col("c"), F.col("i")).cast("long")
    )
    plain = [sorted(map(repr, map(tuple, df.collect()))) for df in (found, each)]
    assert plain[0] == plain[1] and len(plain[0]) == 90
