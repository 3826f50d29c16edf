import html as H
import random
import re
import time

import numpy as np
import pytest
from helpers import with_clashes

from assetrank.llm import html_extract
from assetrank.llm.catalog import op6_text_to_tag_ratio

SF = "/root/testdata/sf0.01"


def article_by_hand(page):
    inner = re.sub(r"<br/?>", " ", page[page.index("<article>") + 9 : page.index("</article>")])
    blocks = (" ".join(H.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_query_gives_every_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = op6_text_to_tag_ratio(spark, SF).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    for r in out:
        assert r.url == pages[r.page_id].url and r.text == article_by_hand(pages[r.page_id].html) and r.n_chars == len(r.text)


LONG = "This is a paragraph of the article, which goes on for a while so that it has some weight."
CASES = [
    (None, ""),
    ("", ""),
    ("just text &amp; more", "just text & more"),
    (f"<body><nav><a href=x>Home</a></nav><p>{LONG}<p>Short.</p><footer>c</footer></body>", f"{LONG}\n\nShort."),
    (f"<div class='content'><h2>Head</h2><p>{LONG}</p><ul><li>a<li>b</ul></div><div id='comments'><p>{LONG} I disagree.</p></div>", f"Head\n\n{LONG}\n\na\n\nb"),
    (f"<main><p>{LONG}</p><form><p>Your mail</p></form><div class='ad-banner ad'>{LONG}</div><aside>x</aside><p>End.</p></main>", f"{LONG}\n\nEnd."),
    (f"<div class='page with-sidebar'><article><header><h1>T</h1><p>by me</p></header><p>{LONG}</p></article></div><div class=cookie-notice>{LONG}</div>", f"T\n\n{LONG}"),
    (f"<article><p>a&nbsp;b\n c&#233;&lt;p&gt;</p><script>if (a<b) {{}}</script><!-- {LONG} --><p hidden>{LONG}</p></article>", "a b cé<p>"),
    (f"<article><p><b>{LONG}<br>x</article><p>outside</p>", f"{LONG} x"),
    ("<article>" * 300 + LONG, LONG),
    # declarations of any kind, closed or not
    ("<article><p>x</p><![foo[ bar ]]></article>", "x"),
    ("<article><p>x</p><![CDATA[ bar ]]><!doctype a><!ELEMENT b><!><!-><!--></article>", "x"),
    (f"<article><p>{LONG}</p><!-- unclosed <article><p>no</p>", LONG),
    ("<article><p>x</p><![if", "x"),
    ("<article><p>x</p><!", "x"),
    # linked headlines and paragraphs, formulas, menus of text, a short second article
    (f"<div><h1><a href=x>A linked headline</a></h1><p>{LONG}</p><p>{LONG}</p><p><a href=y>Mostly a link, this one</a> here.</p></div>", f"A linked headline\n\n{LONG}\n\n{LONG}\n\nMostly a link, this one here."),
    (f"<main><p>Let <math>x=2</math> be.</p><menu><li>First</li></menu><p>{LONG}</p></main>", f"Let x=2 be.\n\nFirst\n\n{LONG}"),
    (f"<article><p>{LONG}</p><p>{LONG}</p></article><article><p>Brief.</p></article>", f"{LONG}\n\n{LONG}\n\nBrief."),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert html_extract.main_text(page) == text


def test_edges_through_spark(spark):
    rows = [(k % 4, None if k == 2 else "u", page) for k, (page, _) in enumerate(CASES)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_extract.extract_pages(with_clashes(pages)).collect()
    assert sorted(r.text for r in out) == sorted([t for _, t in CASES] + [""])
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_gaussian_against_direct_sums():
    ratios = np.random.default_rng(2).uniform(0, 100, 57)
    got = html_extract.smoothed(ratios, 2.0)
    for k in range(57):
        near = [j for j in range(57) if abs(j - k) <= 6]
        w = [np.exp(-0.5 * ((j - k) / 2.0) ** 2) for j in near]
        assert got[k] == pytest.approx(sum(ratios[j] * x for j, x in zip(near, w)) / sum(w))


def test_clusters_choose_the_region_without_landmark():
    menu = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(40))
    page = f"<body><div><ul>{menu}</ul></div><div><p>{LONG}</p><p>{LONG}</p><p>Ok.</p></div><div><span>Imprint</span> <a href=x>Contact</a></div></body>"
    assert html_extract.main_text(page) == f"{LONG}\n\n{LONG}\n\nOk."


def test_no_page_ends_the_job():
    """Random pieces of markup, and random bytes, are read without an exception."""
    rng = random.Random(6)
    pieces = ["<!", "<![", "<!--", "-->", "--!>", "]]>", "<?", "<", ">", "</", "<p", "<a href='", "'", '"', "=", "&", "&#", "&#x", ";", "&#99999999999;", "&amp", "<script>", "</script", "<style>",
              "<![CDATA[", "<![if IE]>", "<!DOCTYPE", "[", "]", "text ", "\x00", "\ud800", "\U0001f600", "/", "<article>", "</article>", "<svg/>", "<br", "<title>", "<textarea>", "<plaintext>", "-", "!"]
    for _ in range(10_000):
        assert isinstance(html_extract.main_text("".join(rng.choice(pieces) for _ in range(rng.randrange(25)))), str)
    for _ in range(2000):
        html_extract.main_text(rng.randbytes(rng.randrange(200)).decode("latin-1"))


def test_time_grows_with_the_page():
    def seconds(n):
        pages = ["<font>" * n + "<h1>x</h1>" * n, "<p>" + "<b>" * n + "<h1>x</h1>" * n, "<ul><li>" * n + "x" * n, "<!--" * n, "<![" * n, "a&" * n]
        began = time.process_time()
        for page in pages:
            html_extract.main_text(page)
        return time.process_time() - began

    seconds(500)
    assert seconds(16_000) < 12 * max(0.1, seconds(4000))


def test_very_long_page():
    text = " ".join(f"word{k}" for k in range(200_000))
    assert html_extract.main_text(f"<nav>x</nav><article><p>{text}</p></article>") == text
