"""Blocks, gradients and verdicts of the page labeller; archives written and read back."""

import base64
import gzip
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import page_text as P
from linkloom.llm import token_store, warc
from linkloom.llm.queries import op9_warc


def texts(page):
    return [b.text for b in P.blocks_of(page)]


def test_blocks():
    assert texts(None) == texts("") == texts("<p></p> \n") == []
    assert texts("<p>a<p>b <b>c</b>\n d<br>e</p>f") == ["a", "b c d e", "f"]
    assert texts("x &amp; y &lt;p&gt; &eacute;&#233;&nbsp;z") == ["x & y <p> éé z"]
    assert texts("<script>var a='</p>x';</script><style>p{}</style><!-- <p>no</p> --><p>yes") == ["yes"]
    assert texts('<div title="a > b">t</div><p>cut <a href="x') == ["t", "cut"]
    assert texts("<ul><li>a<li>b</ul></div></x>c") == ["a", "b", "c"]
    assert texts("a < b and 3 > 2") == ["a < b and 3 > 2"]
    started = time.time()
    assert len(texts("<a" * 100_000)) <= 1 and len(texts("<!" * 100_000)) <= 1
    assert texts("<div>x</y>" * 20_000) == ["x"] * 20_000
    assert texts('<p "' * 50_000 + "z") is not None
    assert time.time() - started < 20
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert texts(deep) == ["x"]


def test_gradient():
    rng = np.random.default_rng(0)
    pages = [P.made_page(rng, ["one two three. Four", "five six"], ["seven", "eight nine"])[:9] for _ in range(3)]
    f, model = P.Features(pages), P.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grad = model.gradients(f)
    for name in ("wf", "ub", "cf", "out", "path", "word"):
        flat = model.p[name].ravel()
        spots = np.argsort(-np.abs(grad[name].ravel()))[:3]
        for i in spots:
            old = flat[i]
            flat[i] = old + 1e-3
            up = model.gradients(f)[0]
            flat[i] = old - 1e-3
            down = model.gradients(f)[0]
            flat[i] = old
            assert abs((up - down) / 2e-3 - grad[name].ravel()[i]) < 2e-3 + 0.05 * abs(grad[name].ravel()[i])


def plain_main(page):
    """The given pages' main text: what stands in the article."""
    inner = page.split("<article>")[1].split("</article>")[0]
    return "\n".join(texts(inner))


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r.text for r in P.extract_main_text(pages).collect()}
    wrong = [r.page_id for r in pages.collect() if rows[r.page_id] != plain_main(r.html)]
    assert len(wrong) <= 1


def test_other_layouts(spark):
    given = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(150).collect()]
    model = P.train_labeller(given)
    rng = np.random.default_rng(123)
    unseen = [b for h in given[100:] for b in P.labelled(h)]
    made = [P.made_page(rng, [b.text for b in unseen if b.label], [b.text for b in unseen if not b.label]) for _ in range(60)]
    f = P.Features(made)
    assert (model.predict(f) == (f.labels == 1)).mean() > 0.98


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "plain words only", "x"), (3, None, "plain words only", "x"), (None, "u", "<p>A</p>" * 3000, "x")], "page_id long, url string, html string, text string")
    rows = sorted((r.page_id or 9, r.text, r.n_blocks) for r in P.extract_main_text(pages).collect())
    assert [r[0] for r in rows] == [1, 2, 3, 3, 9] and rows[0][1:] == ("", 0) and rows[4][2] == 3000
    assert P.extract_main_text(pages.limit(0)).count() == 0


# --- archives ---------------------------------------------------------------------------------------------------


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_chunk_framing():
    for n in (0, 1, 4095, 4096, 4097, 30_000):
        payload = random.Random(n).randbytes(n)
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def folder(spark):
    return token_store.shared_uri(spark, "warc-test")


def test_round_trip(spark):
    long = "é" * 40_000
    rows = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (3, None, long), (4, "u", long), (5, "u", None), (6, "u", ""), (7, "u", "x\r\n0\r\n\r\n"), (8, "u", "a" * 20_000), (8, "u", "a" * 20_000)]
    pages = spark.createDataFrame([(i, u, h, 0) for i, u, h in [*rows, (None, "u", "lost")]], "page_id long, url string, html string, number int").repartition(3)
    manifest = warc.write_archives(pages, folder(spark))
    got = {r.record_id.rsplit(":", 1)[1]: r for r in warc.read_archives(manifest).collect()}
    assert set(got) == {str(i) for i in range(1, 9)} and not any(r.error for r in got.values())
    for i, _, h in rows:
        payload, r = (h or "").encode(), got[str(i)]
        first = min(j for j, _, g in rows if (g or "") == (h or ""))
        assert r.digest == digest(payload)
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", f"{warc.PAGE_URN}{first}"))
        assert r.payload == (payload if first == i else None)
    kept = warc.read_archives(warc.write_archives(pages, folder(spark), min_revisit=5)).where("record_type = 'revisit'").collect()
    assert {r.record_id.rsplit(":", 1)[1] for r in kept} == {"4"}


def write_file(spark, records):
    from pyarrow import fs

    path = folder(spark) + ".warc.gz"
    store, where = fs.FileSystem.from_uri(path)
    with store.open_output_stream(where, compression=None) as f:
        for r in records:
            f.write(r)
    return spark.createDataFrame([(path, 1, 1)], warc.MANIFEST)


def test_damaged_segments(spark):
    payload = random.Random(5).randbytes(50_000)
    records = list(warc.page_records(7, "u", payload, 7, 10_000))
    assert len(records) > 4

    def read(records):
        (row,) = warc.read_archives(write_file(spark, records)).collect()
        return row.payload, row.error

    assert read(records) == (payload, None)
    assert read([*records[::-1], records[2]]) == (payload, None)  # any order, a part twice
    assert read(records[:2] + records[3:]) == (None, "a segment is missing")
    assert read(records[:-1]) == (None, "the last segment is missing")
    assert read(records[1:]) == (None, "a segment is missing")
    other = list(warc.page_records(7, "u", payload + b"x" * 3, 7, 10_000))
    assert read(records[:-1] + other[-1:])[1] in ("total length differs", "payload digest differs", "chunk is cut short")


def test_query(spark):
    rows = op9_warc(spark, "/root/testdata/sf0.001").collect()
    html = {r.page_id: (r.html or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {i: (len(h), digest(h)) for i, h in html.items()}
    assert warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder(spark)).count() == 0


def test_unreadable_files_and_members(spark):
    """A bad member costs itself, a bad file its rest; the other files come back whole."""
    good = [r for i in (1, 2, 3) for r in warc.page_records(i, "u", b"page %d" % i, i, 10_000)]
    foreign = gzip.compress(b"HTTP/1.1 200 OK\r\n\r\nno archive")
    headless = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n")
    badly_numbered = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: many\r\n\r\n")

    def read(*files):
        paths = [write_file(spark, f).first().path for f in files]
        rows = warc.read_archives(spark.createDataFrame([(p, 1, 1) for p in paths], warc.MANIFEST)).collect()
        assert all(r.payload is None and r.record_type is None and r.record_id in paths for r in rows if r.error)
        return sorted(r.payload for r in rows if not r.error), [r.error for r in rows if r.error]

    pages = [b"page 1", b"page 2", b"page 3"]
    assert read(good) == (pages, [])
    for bad in (foreign, headless, badly_numbered):
        payloads, errors = read([good[0], bad, *good[1:]])
        assert payloads == pages and len(errors) == 1 and errors[0].startswith("member 2: ")
    payloads, errors = read([*good[:2], good[2][:-9]], [b"plain text, not packed at all"], [], good)
    assert payloads == sorted(pages[:2] + pages) and len(errors) == 3
    assert any("ends inside a record" in e for e in errors) and "0 members instead of 1" in errors
    assert warc.read_archives(spark.createDataFrame([], warc.MANIFEST)).count() == 0


def test_a_very_long_page(spark):
    """Some 1,000 parts are joined in linear time; the text never comes to the driver."""
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(500_000)), lambda i: F.substring(F.md5(i.cast("string")), 1, 32)), "")
    pages = spark.range(1).select(F.lit(1).alias("page_id"), F.lit("u").alias("url"), text.alias("html"))
    start = time.time()
    found = warc.read_archives(warc.write_archives(pages, folder(spark)))
    (row,) = found.select("error", "digest", F.octet_length("payload").alias("n"), F.sha1("payload").alias("sha")).collect()
    assert row.error is None and row.n == 16_000_000 and base64.b32encode(bytes.fromhex(row.sha)).decode() == row.digest
    assert time.time() - start < 60
