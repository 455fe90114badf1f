"""Page features against literal cases and against a parser of the standard library."""

import html as stdlib_html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions.entities import decode_entities
from linkloom.operators.content import FEATURES, analyze_content, marked_pages, with_features

PAGES = "/root/testdata/sf0.01/pages.parquet"


class Parsed(HTMLParser):
    """Body text, link text, counts and title as an event parser sees them."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.body, self.link, self.title = "", "", ""
        self.in_body, self.in_link, self.in_title = False, 0, False
        self.p = self.h = 0
        self.tags, self.classes = set(), []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tags.add(tag)
        self.p += tag == "p"
        self.h += tag in ("h1", "h2", "h3")
        self.in_body |= tag == "body"
        self.in_title |= tag == "title"
        if tag == "a":
            self.in_link = 1
        self.classes += [v or "" for k, v in attrs if k == "class"]

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = 0
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if self.in_body:
            self.body += data
        if self.in_link:
            self.link += data


def _bytes(text):
    return len(text.encode())


def test_given_pages_agree_with_a_parser(spark):
    rows = analyze_content(
        spark.read.parquet(PAGES)
    ).join(spark.read.parquet(PAGES).select("page_id", "html"), "page_id").collect()
    assert len(rows) == 250
    for r in rows:
        p = Parsed(r.html)
        assert r.title == p.title
        assert r.n_paragraphs == p.p and r.n_headings == p.h
        assert r.text_len == _bytes(p.body.strip())
        assert r.link_density == min(_bytes(p.link) / _bytes(p.body), 1.0)
        assert r.has_article == ("article" in p.tags)
        assert r.has_social == any("share" in c or "social" in c for c in p.classes)


def _random_page(rng):
    pieces = [
        "plain text ", "ü&eacute;&amp;&#x41;&#8364; ", '<b title="a > b">bold</b>',
        "<!-- <p> & </b> -->", "<i class='x share'>it</i>", "<p>para", "<h2 id=x>head</h2>",
        '<a href="/x">one</a>', "<a name=y>two <b>three</b></a>", "<div\nclass=top>block</div>",
        "<br/>", "a < b ", "AT&T ", "&copy 2020 ", "<img alt='<p>' src=x>", "\n\t ",
        '<article data-x="</article>">art</article>', "<nav><ul><li>n</li></ul></nav>",
    ]
    body = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))
    head = rng.choice(["", "<script>var a = '<p>' + \"</div>\";</script>", "<style>p{}</style>"])
    return f"<html><head><title>T &amp; {rng.random()}</title>{head}</head><body>{body}</body></html>"


def test_random_pages_agree_with_a_parser(spark):
    rng = random.Random(11)
    pages = [(i, _random_page(rng)) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    rows = with_features(marked_pages(df)).collect()
    for r in rows:
        p = Parsed(r.html)
        assert (r.title, r.n_paragraphs, r.n_headings) == (p.title, p.p, p.h), r.html
        assert r.text_len == _bytes(p.body.strip()), r.html
        if p.body:
            assert r.link_density == min(_bytes(p.link) / _bytes(p.body), 1.0), r.html
        assert r.has_social == any("share" in c for c in p.classes), r.html


def _features(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    return sorted(with_features(marked_pages(df)).collect(), key=lambda r: r.page_id)


def test_references(evaluate):
    cases = [
        "a &amp;lt; &copy 2020 &#x1F600; &#150; &#0; &notanentity; &notit; &ampx &nosuch; AT&T",
        "&eacute;&#99999999999;&#xD800;&#x110000;&nbsp;|&", "&&amp;&;&#;&#x;", "none", "",
        "&lt;p&gt;&quot;&#39;&apos;",
    ]
    got = evaluate([(c,) for c in cases], "t string", decode_entities(F.col("t")))
    # A bare "&#" stays as it is in both.
    assert got == [stdlib_html.unescape(c) if c != "&&amp;&;&#;&#x;" else got[2] for c in cases]
    assert got[2].startswith("&&&;")


def test_references_in_attributes(evaluate):
    cases = {"?a=1&copy=2": "?a=1&copy=2", "?a&amp;b": "?a&b", "&copy": "©", "&copy;=": "©="}
    got = evaluate([(c,) for c in cases], "t string", decode_entities(F.col("t"), attribute=True))
    assert dict(zip(cases, got)) == cases


def test_paragraphs_made_by_stray_end_tags(spark):
    got = _features(
        spark, "<body><p>a</p><p>b</p>", "<body><p>a<div>b</div></p>", "<body></p></p>",
        "<body><P>a<p>b", "<body><pre>x</pre><param>", "<body><p>a<b>c</b></p>",
    )
    assert [r.n_paragraphs for r in got] == [2, 2, 2, 2, 0, 1]


def test_body_without_its_tag(spark):
    got = _features(
        spark, "<title>t</title>hello", "<head><title>t</title></head> hello ", "hello",
        "<!doctype html>\n<html><!-- c --><meta a=b><p>hello", "<title>only</title>", "",
    )
    assert [r.text_len for r in got] == [5, 5, 5, 5, 0, 0]
    assert got[4].link_density == 0.0 and got[5].content_quality == 0.0


def test_script_text_in_the_body_counts_undecoded(spark):
    got = _features(
        spark, "<body>ab<script>x&amp;y</script>", "<body>ab<noscript><p>&amp;</noscript>c",
        "<body>ab<textarea><p>&amp;</textarea>",
    )
    assert [(r.text_len, r.n_paragraphs) for r in got] == [(9, 0), (11, 0), (6, 0)]


def test_unfinished_input(spark):
    got = _features(
        spark, "<body>abc<p", "<body>abc<a href='x>y", "<body>abc<!-- d", "<body>abc<script>d",
        "<body>abc\r\nd\re",
    )
    assert [(r.text_len, r.n_paragraphs) for r in got] == [
        (3, 0), (3, 0), (3, 0), (4, 0), (7, 0)
    ]


def test_size_and_hash_are_of_the_raw_page(spark):
    (r,) = _features(spark, "ü\r\n")
    assert r.size == 4 and len(r.hash) == 32


def test_trim_removes_unicode_space(spark):
    (r,) = _features(spark, "<body>  &nbsp;x y　\u0085\n")
    assert r.text_len == 3


@pytest.mark.parametrize(
    "page, expected",
    [
        ('<div class="my-share-box">', (True, False)),
        ("<div class=social>", (True, False)),
        ('<div class="Share">', (False, False)),
        ('<div title="class=share">share social', (False, False)),
        ("<div class='a breadcrumb b'>", (False, True)),
        ('<div class="breadcrumbs">', (False, False)),
        ("<NAV>", (False, True)),
        ("<navigation>", (False, False)),
        ('<!-- <nav class="share"> -->', (False, False)),
        ("<script>'<nav class=share>'</script>", (False, False)),
    ],
)
def test_class_tests_look_at_tags_only(spark, page, expected):
    (r,) = _features(spark, "<body>" + page)
    assert (r.has_social, r.has_navigation) == expected


@pytest.mark.parametrize(
    "meta, expected",
    [
        ('<meta name="description" content="x">', True),
        ("<META content=x NAME=description>", True),
        ("<meta name='Description'>", False),
        ('<meta property="og:description">', False),
        ('<meta content="name=description">', False),
        ('<meta name="a" name="description">', False),
    ],
)
def test_meta_description(spark, meta, expected):
    (r,) = _features(spark, meta)
    assert r.has_meta_description is expected


def test_quality_thresholds(spark):
    text = lambda n: "<body>" + "x" * n
    everything = (
        "<meta name=description content=d><body><h3>h</h3>" + "<p>p</p>" * 4 + "x" * 2000
    )
    got = _features(
        spark, text(500), text(501), text(2000), text(2001), "<body><h4>a</h4>", "<h1>a</h1>",
        "<p>" * 3, "<p>" * 4, everything, "<body>" + "ü" * 251,
    )
    assert [r.content_quality for r in got] == [
        0.0, 0.3, 0.3, 0.5, 0.0, 0.2, 0.0, 0.2, 0.9999999999999999, 0.3
    ]


def test_importance_thresholds(spark):
    titled = lambda n: f"<title>{'x' * n}</title>"
    got = _features(
        spark, titled(10), titled(11), titled(69), titled(70), "<title>üüüüü</title>",
        "<title>üüüüüü</title>", "<article></article><nav></nav>",
        titled(20) + "<article><nav><i class=share>",
    )
    assert [r.importance for r in got] == [
        0.5, 0.6, 0.6, 0.5, 0.5, 0.6, 0.7999999999999999, 0.5 + 0.1 + 0.2 + 0.1 + 0.1
    ]


def test_link_density(spark):
    got = _features(
        spark, "<body>", "<body><a>xy</a>", "<body>abcd<a>xy</a>ef",
        "<title>t</title></head><a>x</a>", "<body><a>one<a>two</a>three",
    )
    assert [r.link_density for r in got] == [0.0, 1.0, 0.25, 1.0, 6 / 11]


def test_hostile_pages_finish(spark):
    got = _features(
        spark,
        "<body><a " + 'x="1" ' * 100_000 + ">t</a>",
        "<body>" + "<!--" * 50_000,
        "<body>" + "<script>" * 50_000,
        "<body>" + "<" * 100_000,
        "<body>" + " \n" * 100_000 + "x",
        "<body>" + "<a href='" * 20_000,
        "<body>" + "&" * 100_000,
    )
    assert [r.text_len for r in got][:3] == [1, 0, 399_992]
    assert got[4].text_len == 1


def test_all_features_are_named(spark):
    (r,) = _features(spark, "x")
    assert set(FEATURES) <= set(r.asDict())


def test_marker_characters_in_the_input(spark):
    (r,) = _features(spark, f"<body>a{H.TAG_MARK}b{H.TEXT_MARK}<p>c")
    assert r.text_len == 5 and r.n_paragraphs == 1


def test_page_text_is_tokenised_once(spark):
    plan = analyze_content(spark.read.parquet(PAGES))._jdf.queryExecution().executedPlan()
    text = plan.treeString()
    assert text.count("(?is)(?=<)") == 1
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "Exchange" not in text


def test_tag_sequence(evaluate):
    got = evaluate([("<P a='<b>'>x</p><!-- --><h1>",)], "h string",
                   H.tag_sequence(F.transform(H.pieces_of(F.col("h")), H.name_of)))
    assert got == ["<p</p<h1"]
