from __future__ import annotations

import html
import re

import duckdb
import pytest

from ledgerloom.llm import html_text
from ledgerloom.llm.html_text import main_text

SMALL = "/root/testdata/sf0.001"


def article(page):
    """The text of the tables' pages, which have one article each, by their own marks."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL).group(1)
    return " ".join(html.unescape(re.sub(r"</?b>", "", b)).strip() for b in re.split(r"</?(?:p|h1|br)>", inner) if b.strip()).strip()


def test_given_pages(spark):
    got = html_text.extract(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()
    pages = dict(duckdb.connect().execute(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall())
    assert {r.page_id: r.text for r in got} == {k: " ".join(article(p).split()) for k, p in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


LONG = "The river had risen for three days before the bridge gave way, and nobody in the village slept. " * 3
BODY = f"<h1>Bridge lost</h1><p>{LONG}</p><p>Short end.</p>"
TEXT = " ".join(f"Bridge lost {LONG} Short end.".split())


@pytest.mark.parametrize("page", [
    f"<nav><a href=/>Home</a></nav><article>{BODY}</article><footer>&copy; us</footer>",
    f"<header><h2>Daily Paper</h2></header><main><div>{BODY}</div></main><aside>{LONG}</aside>",
    f"<body><div class='cookie-notice'>{LONG}</div><div class=content>{BODY}</div><div id='comments'><div><p>{LONG}</p></div><p>{LONG}</p></div></body>",
    f"<div role=navigation>{LONG}</div><section>{BODY}</section><form><p>{LONG}</p><input><textarea>{LONG}</textarea></form>",
    f"<ul><li><a href=/a>News</a><li><a href=/b>Sports and more sports</a></ul><div>{BODY}</div><div>© 2024 Daily Paper, all rights reserved and so on</div>",
    f"<script>var a='<p>{LONG}</p>';</script><style>p{{}}</style><!-- <p>{LONG}</p> --><noscript>{LONG}</noscript><div>{BODY}</div>",
    f"<article><header><h1>Bridge lost</h1></header><p>{LONG}</p><div class='ad'><div>{LONG}</div>{LONG}</div><p>Short end.</p><footer>{LONG}</footer></article>",
    f"<form id=aspnet><nav>Menu</nav><article>{BODY}</article><p>other</p></form>",
    f"<div class='layout has-sidebar no-ads'><div class='sidebarLeft'>{LONG}</div>{BODY}</div>",
    f"<article>{BODY}</article><article class='comment'>{LONG}</article>",
    f"<article class='news'>{BODY}<p class='notice'>{LONG}<p hidden>{LONG}</p><p aria-hidden='true'>{LONG}</p>",
    f"<main>{BODY}<div style='display: none'>{LONG}</div><div class=\"x > y\" data-id='ad'></div></main>",
])
def test_regions_that_are_no_article_go(page):
    assert main_text(f"<!DOCTYPE html><html><head><title>{LONG}</title></head>{page}</html>") == TEXT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<nav>only a menu</nav>", ""),
    ("<p>a&nbsp;b\n\t c</p>", "a b c"), ("<p>1 &lt;b&gt; 2 &amp;amp; &#x41;&#66;</p>", "1 <b> 2 &amp; AB"),
    ("<p>a<b>b</b>c<br>d</p>", "abc d"), ("<table><tr><td>x<td>y</table>", "x y"), ("<p>cut &am", "cut &am"),
    ("<p>cut <a href='x", "cut"), ("<p>3 < 4 and 5 > 2</p>", "3 < 4 and 5 > 2"), ("<!-- never closed <p>x</p>", ""),
    ("<article></article><p>outside only</p>", "outside only"), ("<article><h1>T</h1></article><p>" + LONG + "</p>", "T"),
    ("<article><a href=/x>linked words</a> end</article>", "linked words end"), ('<a title="open>x</a> y', "x y"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_long_pages_stay_whole():
    paragraphs = [f"Paragraph {k} " + "word " * 20 for k in range(20_000)]
    page = "<nav>menu</nav><div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
    assert main_text(page) == " ".join(p.strip() for p in paragraphs)
    assert main_text("<" * 200_000) == "<" * 200_000
    assert main_text("<article>" + "<div>" * 100_000 + "x").endswith("x")


def test_surge_and_dive():
    import numpy as np
    weights = np.array([0, 5, 0, 0, 0, 90, 4, 0, 0, 30, 0, 0, 0, 3])
    kept = html_text.kept_lines(weights, 80)
    assert np.flatnonzero(kept).tolist() == [5, 6, 7, 8, 9]


def test_rows_and_columns(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_text.extract(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(got.collect(), key=str) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert html_text.extract(table.limit(0)).collect() == []
