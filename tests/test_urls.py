import random
import string
from urllib.parse import quote, urljoin

import pytest
from pyspark.sql import functions as F

from linkloom.functions import urls as U

VALIDITY = {
    "": False,
    "ftp://h/x": False,
    "https://": False,
    "/a": False,
    "HTTP://h/x": True,
    "https://h/a.json": False,
    "http://www.icons.com/": False,
    "http://h/x.PDF?y": False,
    "https://h/help": True,
    "http://h:8080/x?y#z": True,
    "http://h:80a/": False,
    "http://user:pw@h/": True,
    "http://user@/x": False,
    "http:///x": False,
    "http:opaque": False,
    "http://h/%zz": False,
    "http://h/?%zz": True,
    "http://h/a b": True,
    "http://a b/": False,
    "http://h/\tx": False,
    "https://bücher.example/ü": True,
    "http://[::1]:80/": True,
    "http://h_1/": True,
    "http://h/tel:1": False,
    "mailto:a@h": False,
    "//h/x": False,
}

NORMALISED = {
    "http://h": "http://h/",
    "http://h#t": "http://h/",
    "http://h?q=1": "http://h/?q=1",
    "http://h/a#t": "http://h/a",
    "HTTP://h/A": "http://h/A",
    "http://h/ü b": "http://h/%C3%BC%20b",
    "http://h/%zz#t": "http://h/%zz#t",
    "mailto:x@h#t": "mailto:x@h",
    "http://h/a?": "http://h/a?",
    "": "/",
}

BASE = "http://h/a/b?x=1"
RESOLVED = [
    ("/c", "http://h/c", "http://h/c"),
    ("c", "http://h/a/c", "http://h/a/c"),
    ("../c", "http://h/c", "http://h/c"),
    ("../../../c", "http://h/c", "http://h/c"),
    ("?y=2", "http://h/a/b?y=2", "http://h/a/b?y=2"),
    ("//k/z", "http://k/z", "http://k/z"),
    ("/für", "http://h/f%C3%BCr", "http://h/f%C3%BCr"),
    ("#t", "http://h/a/b?x=1#t", "http://h/a/b?x=1#t"),
    ("", "http://h/a/b?x=1", "http://h/a/b?x=1"),
    ("/a/b#t", "http://h/a/b#t", None),
    ("/a/./b#t", "http://h/a/b#t", None),
    ("/a/%62#t", "http://h/a/%62#t", None),
    ("/a/b?#t", "http://h/a/b?#t", None),
    ("/a/b?q#t", "http://h/a/b?q#t", "http://h/a/b?q#t"),
    ("http://other/a/b#t", "http://other/a/b#t", None),
    ("/a/b#", "http://h/a/b", "http://h/a/b"),
    ("mailto:a@b", "mailto:a@b", "mailto:a@b"),
    ("./x:y", "http://h/a/x:y", "http://h/a/x:y"),
    ("x:y/z", "x:y/z", "x:y/z"),
    ("1x:y", None, None),
    (":x", None, None),
    ("/%zz", None, None),
    ("/x\ny", None, None),
    ("/a(b)", "http://h/a(b)", "http://h/a(b)"),
    ("/ü(b)*'!", "http://h/%C3%BC%28b%29%2A%27%21", "http://h/%C3%BC%28b%29%2A%27%21"),
    ("/ü%41%2f%ff", "http://h/%C3%BCA/%FF", "http://h/%C3%BCA/%FF"),
    ("/?q=ü b", "http://h/?q=ü b", "http://h/?q=ü b"),
    ("/#ü b", "http://h/#%C3%BC%20b", "http://h/#%C3%BC%20b"),
    ("HTTPS://K/x", "https://K/x", "https://K/x"),
    ("http://k", "http://k", "http://k"),
    ("http://k/a/../b//c/.", "http://k/b//c/", "http://k/b//c/"),
]


def test_validity(evaluate):
    got = evaluate([(u,) for u in VALIDITY], "u string", U.is_valid_url(F.col("u")))
    assert dict(zip(VALIDITY, got)) == VALIDITY


def test_strict_validity_looks_at_the_extension_only(evaluate):
    cases = {
        "http://www.icons.com/": True,
        "http://h/a.js": False,
        "http://h/a.json": True,
        "http://h/a.js?x": False,
        "http://h/?f=a.js": True,
    }
    got = evaluate([(u,) for u in cases], "u string", U.is_valid_url(F.col("u"), strict=True))
    assert dict(zip(cases, got)) == cases


def test_missing_url_is_invalid(evaluate):
    assert evaluate([(None,)], "u string", U.is_valid_url(F.col("u"))) == [False]


def test_normalised(evaluate):
    got = evaluate([(u,) for u in NORMALISED], "u string", U.normalize_url(F.col("u")))
    assert dict(zip(NORMALISED, got)) == NORMALISED


def test_resolution(evaluate):
    got = evaluate(
        [(BASE, h) for h, _, _ in RESOLVED], "b string, h string",
        U.resolve_url(F.col("b"), F.col("h")),
        U.resolve_url(F.col("b"), F.col("h"), drop_same_page=True),
    )
    assert [(h, *r) for (h, _, _), r in zip(RESOLVED, got)] == RESOLVED


@pytest.mark.parametrize("base", ["http://h", "https://h:81/x/y/", "http://u@h/a?b#c"])
def test_resolution_agrees_with_urljoin(evaluate, base):
    rng = random.Random(7)
    # urljoin drops empty segments, which the RFC keeps, so none are made here.
    parts = ["a", "b.html", "..", ".", "x-y_z", "~", "ü", "c,d"]
    hrefs = []
    for _ in range(300):
        path = "/".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))
        hrefs.append(rng.choice(["", "/"]) + path + rng.choice(["", "/", "?q=1", "?q=1#f"]))
    got = evaluate(
        [(base, h) for h in hrefs], "b string, h string", U.resolve_url(F.col("b"), F.col("h"))
    )
    safe = string.punctuation
    expected = [quote(urljoin(base, h), safe=safe) for h in hrefs]
    assert [(h, g) for h, g, e in zip(hrefs, got, expected) if g != e] == []


def test_content_types(evaluate):
    guesses = {
        "/BLOG/x": "article",
        "/news/article/x": "article",
        "/news/x": "news",
        "/docs": "documentation",
        "/help/": "documentation",
        "/help": "general",
    }
    got = evaluate([(u,) for u in guesses], "u string", U.guess_content_type(F.col("u")))
    assert dict(zip(guesses, got)) == guesses
    relevant = {
        "text/html; charset=x": True, "TEXT/HTML": False, "": False, None: False,
        "application/xhtml+xml": True, "text/plain": True, "application/xhtmlxxml": False,
    }
    got = evaluate([(c,) for c in relevant], "c string", U.is_relevant_content(F.col("c")))
    assert dict(zip(relevant, got)) == relevant
