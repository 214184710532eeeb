"""Main text of pages of many shapes, and rows that are odd in every column."""

import pytest

from eventlens.llm import html_text as H

LONG = "A long paragraph of the article with very many words in it that goes on and on to its end. "
P = f"<p>{LONG * 3}</p>"
OPINION = "<div class=comment><p>" + "A reader has a very long opinion about all of this and writes it down. " * 8 + "</div>"
MENU = "<div><a href=1>One</a> <a href=2>two</a></div>"

SHAPES = {
    "sidebar longer than the article": (
        f"<article>{P}{P}</article><div class='sidebar-right'>{'<p>' + 'Side text that is long. ' * 40 + '</p>' * 1}</div>",
        ["goes on"], ["Side text"]),
    "comments without an article element": (
        f"<div id=content><h1>Title</h1>{P}{P}</div><div class=comments>{OPINION * 6}</div>", ["Title", "goes on"], ["reader"]),
    "comments inside the article": (f"<article>{P}<section id=comment-list>{OPINION * 3}</section>{P}</article>", ["goes on"], ["reader"]),
    "a menu without a name": (f"{MENU}<div>{P}{P}{P}</div>", ["goes on"], ["One", "two"]),
    "links inside an article": (f"<article>{P}<p><a href=x>All about it</a></p>{P}</article>", ["All about it"], []),
    "formulas": (f"<article><p>{LONG}As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> shows.</p>{P}</article>", ["As x=2 shows."], []),
    "heading and byline before the article": (
        f"<main><h1>Title</h1><p class=byline>By someone</p><article>{P}{P}</article></main>", ["Title By someone A long"], []),
    "a paragraph about shares": (f"<article>{P}<p class=share>{LONG}Shares fell.</p>{P}</article>", ["Shares fell."], []),
    "buttons to share": (f"<article>{P}{P}<div class=share><a>Send</a> <a>Post</a></div></article>", ["goes on"], ["Send", "Post"]),
    "a comment that never ends": (f"<article>{P}{P}</article><!-- <p>gone</p> <b>x", ["goes on"], ["gone", "<", "x"]),
    "a tag that never ends": (f"<article>{P}{P}</article><div class='no end", ["goes on"], ["no end", "<"]),
    "article within article": (f"<article>{P}<article class=comment>{OPINION}</article>{P}</article>", ["goes on"], ["reader"]),
    "table layout": (f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a><td>{P}{P}{P}</table>", ["goes on"], ["Home"]),
    "hidden parts": (f"<div>{P}{P}<div style='display: none'>hidden words</div><p hidden>more of it</p></div>", ["goes on"], ["hidden", "more of"]),
    "adverts in the text": (f"<article>{P}<div class='ad ad-box'><p>Buy this now, it is really cheap</p></div>{P}</article>", ["goes on"], ["Buy"]),
    "footer and header of the page": (
        f"<body><header><h1>Site</h1></header><div class=page>{P}{P}</div><footer>all rights</footer></body>", ["goes on"], ["Site", "rights"]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_main_text_of_many_shapes(shape):
    html, inside, outside = SHAPES[shape]
    for page in (html, f"<!doctype html><html><head><title>t</title></head><body>{html}"):
        got = H.main_text(page)
        assert all(x in got for x in inside), got
        assert not any(x in got for x in outside), got
        assert got.count("goes on") == html.count("goes on")


def test_odd_pages_are_carried(spark):
    from pyspark.sql import functions as F
    rows = [(1, "u", P), (1, "u", P), (None, None, P), (2, "", None), (3, "u", ""), (4, "u", "x" * 300_000), (5, None, "<p>a")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {n: F.lit("clash") for n in ("text", "n_chars", "blocks", "ratio")})
    got = sorted(map(tuple, H.extract(pages).collect()), key=repr)
    assert got == sorted(((i, u, H.main_text(h), len(H.main_text(h))) for i, u, h in rows), key=repr)
    assert H.extract(pages.limit(0)).collect() == []
