"""HTML extraction and the WARC archive."""

import hashlib
import html
import re

import pytest

from recflow.llm import html_extract as H
from recflow.llm import plans, warc

from .conftest import SF

PAGES = "page_id long, url string, html string"


def test_extracts_the_article_of_every_page(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = plans.op1_html_extract(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = (" ".join(html.unescape(re.sub("</?(b|br)>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


WEIGHTS = {"w": 1.0, "a": -0.5, "<div": -2.0, "</div": -2.0, "<body": -3.0, "<article": -3.0}


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("<<<", "<<<"),
    ("<body><nav>Home</nav><div class='cookie-notice'>We use cookies</div><article><h1>T &amp; t</h1><p>one\n two&nbsp;three</p>"
     "<aside>side</aside><p>four <b>five</b><br>six<form>mail</form><div id=comments><p>nice!</p></div></article><footer>f</footer>",
     "T & t\none two three\nfour five six"),
    ("<div class=ad>buy<article><p>text here</article>", "text here"),
    ("<main><header><h1>Title</h1></header><script>if (a < b) '</p>'</script><p>Body<!-- x > y --></p></main>", "Title\nBody"),
    ("<p title='a > b'>x</p>", "x"),
    ("<div id='siteHeader'>My site</div><div class='entry-header'><h1>A title of five words</h1></div><p>Some text of the entry</p>", "A title of five words\nSome text of the entry"),
    ("<ul><li><a href=1>menu</a></li></ul><p>a long text of many plain words that is the page</p>", "a long text of many plain words that is the page"),
    ("<article><p>open <b>bold<p>next <i>it</article>", "open bold\nnext it"),
])
def test_markup(page, text):
    assert H.extract(page, WEIGHTS) == text


@pytest.fixture(scope="module")
def learned(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


STORY = "A long story of many words that somebody wrote down here. " * 20


@pytest.mark.parametrize("page, text", [
    (f"<body><main><img src=x></main><div><p>{STORY}</p></div></body>", STORY.strip()),
    (f"<body><article>Three word teaser</article><div><p>{STORY}</p><p>{STORY}</p></div></body>", f"{STORY.strip()}\n{STORY.strip()}"),
    (f"<body><div role='main'><p>{STORY}</p></div><div>{'side words ' * 70}</div></body>", STORY.strip()),
    (f"<article><p>{STORY}</p><p class='share-price'>Shares rose</p><p hidden>no</p><p style='color:red; display: none'>no</p></article>",
     f"{STORY.strip()}\nShares rose"),
    (f"<article><p>{STORY}</p><p title='not hidden here'>yes</p><div class='social-share'>no</div><div class='share-buttons'>no</div></article>",
     f"{STORY.strip()}\nyes"),
])
def test_landmarks_are_evidence_not_a_switch(learned, page, text):
    assert H.extract(page, learned) == text


def test_weights_decide(spark, learned):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(20).collect()]
    for page in pages:
        text = H.extract(page, learned)
        assert text and H.extract(page, {}) == ""
        assert H.extract(page, {k: -w for k, w in learned.items()}) != text
    mixed = f"<p>{STORY}</p><table><tr><td>{STORY}</td></tr></table>"
    assert H.extract(mixed, {"w": 1.0, "w:td": -1.0, "w:p": 1.0, "<table": -40.0}) == STORY.strip()
    assert H.extract(mixed, {"w": 1.0, "w:td": 2.0, "w:p": 0.01, "<table": -40.0, "<tr": -1.0}) == STORY.strip()
    assert learned["w@"] > 0 > learned["w-"]
    none = H.fit(spark.createDataFrame([], PAGES))
    assert H.extract("<p>plain words</p>", none) == "plain words"


def test_best_region_equals_all_regions():
    import random
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-2, -1, 0.5, 1, 2]) for _ in range(rng.randrange(0, 9))]
        a, b = H.best_region(s)
        best = max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])
        assert sum(s[a:b]) == pytest.approx(best)


def test_very_long_and_broken_pages_end():
    assert H.extract("<div " + "a=\"" * 2000, WEIGHTS) is not None
    text = H.extract("<p>" + "word " * 200_000, WEIGHTS)
    assert len(text) == 200_000 * 5 - 1
    assert H.extract("<a" * 5000 + "'" * 5001, WEIGHTS) is not None


def test_html_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "<article><p>x</p></article>")]
    df = spark.createDataFrame([(*r, "c") for r in rows], PAGES + ", text string")
    got = H.extracted(df)
    assert sorted((r.page_id or 0, r.main_text, r.text) for r in got.collect()) == [(0, "x", "c"), (1, "", "c"), (2, "", "c"), (2, "", "c")]
    assert H.extracted(spark.createDataFrame([], PAGES)).collect() == []


def test_archive_round_trip(spark):
    big = "<p>" + "é" * 200 + "</p>"
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://c", big), (9, "http://c", big), (1, "u", None), (2, "u", ""),
            (4, "u", "short"), (6, "u", "short"), (None, "n", big), (7, "u", big + "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], PAGES + ", digest string")
    payloads, headers = warc.write_archive(pages)
    assert payloads.count() == len({r[2] or "" for r in rows})
    got = warc.read_archive(payloads, headers).collect()
    assert len(got) == len(rows)
    for r in got:
        body = r.payload.encode()
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha256(body).hexdigest()
        copy = r.payload == big and r.id != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if copy else ("response", None)), r
    assert sorted((r.id or 0, r.payload) for r in got) == sorted((x[0] or 0, x[2] or "") for x in rows)
    for r in warc.records(payloads, headers).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[size:] == b"\r\n\r\n"
        if b"WARC-Type: response" in head:
            assert hashlib.sha256(body[:size]).hexdigest().encode() in head
    assert b"http://a/%0D%0AX: y" in b"".join(bytes(r.header, "utf-8") for r in got)
    empty = warc.write_archive(spark.createDataFrame([], PAGES))
    assert warc.read_archive(*empty).collect() == []


def test_wrong_bytes_are_an_error(spark):
    payloads, headers = warc.write_archive(spark.createDataFrame([(1, "u", "abc")], PAGES))
    broken = payloads.selectExpr("digest", "'abd' AS payload")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(broken, headers).collect()
