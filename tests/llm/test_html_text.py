"""Main texts of pages: the given ones, other layouts, and odd markup."""

import html as entities
import random
import re
import time

import pytest

from delayhouse.llm import html_text as h

SF = "/root/testdata/sf0.001"
LONG = "It was the first of the days on which they had been told that the road to the village would be closed for the rest of the year."
MORE = "The people who lived there did not know what to do with all of their time, and so they went for a walk by the river in the evening."


def test_given_pages(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = h.query(spark, SF).collect()
    assert len(found) == len(rows) > 0
    for r in found:
        article = re.search("<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        parts = (" ".join(entities.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page", [
    # no marks at all: stop words, length and links decide
    f"<body><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><h1>A title</h1><p>{LONG}</p><p>Short one.</p><p>{MORE}</p><p><a href=3>More</a> | <a href=4>Next</a></p><p>© 2020 Someone</p></body>",
    # containers named by class
    f"<div class='site-header'><p>{MORE}</p></div><div id='content'><h1>A title</h1><p>{LONG}<p>Short one.<p>{MORE}</div><div class='cookie-notice'>{LONG}</div><div id='comments'><div class=comment><p>{LONG}</p></div></div>",
    # an article with things in it that are none
    f"<header><h2>{LONG}</h2></header><main><article class='post has-sidebar'><header><h1>A title</h1></header><div class='ad'>{LONG}</div><p>{LONG}</p><p>Short one.</p><p>{MORE}</p><aside>{LONG}</aside><form><p>{LONG}</p></form><ul class=related><li>{MORE}</ul><section id=comments><article><p>{MORE}</p></article></section><footer>{LONG}</footer></article></main>",
    # a form around the whole page
    f"<form><div class=menu>{LONG}</div><article><h1>A title</h1><p>{LONG}</p><p>Short one.</p><p>{MORE}</p></article><label>{MORE}</label></form>",
    f"<article><h1>A title</h1><p>{LONG}<br><br>Short one.<br><br>{MORE}</p><script>if (a < b) document.write('<p>x</p>')</script><style>p{{}}</style><!-- <p>no</p> --><p hidden>{LONG}</p><p>Tags:</p><ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>",
])
def test_layouts(page):
    assert h.main_text(page).split("\n") == ["A title", LONG, "Short one.", MORE]


def test_short_articles_and_other_languages():
    assert h.main_text("<nav><a href=1>Home</a></nav><article><h1>Title</h1><p>Word.</p></article>") == "Title\nWord."
    text = "これは長い文章です。" * 12
    assert h.main_text(f"<ul><li><a href=1>リンク</a></li></ul><p>{text}</p>") == text
    assert h.main_text(f"<article><p>{LONG} <a href=1>with a link</a>.</p></article>") == f"{LONG} with a link."


def test_references_and_white_space():
    assert h.main_text("<article><p>a&amp;b &lt;i&gt;\n\t &nbsp; c&#233; &eacute;<br>d <b>e</b>f</p></article>") == "a&b <i> cé é d ef"
    assert h.main_text("<article><p title='a > b'>x</p><table><tr><td>1<td>2</table></article>") == "x\n1\n2"


def test_any_markup_is_read_once():
    rng = random.Random(1)
    signs = ["<p>", "</p>", "<div class='ad'>", "<![", "]]>", "<!--", "-->", "&amp", "&#x", '<a href="', '"', ">", "<script>", "</script", "text ", "<br>", "</", "<article>", "\0", "<td>", "=", "'"]
    for _ in range(3000):
        h.main_text("".join(rng.choice(signs) for _ in range(rng.randint(1, 15))))
    started = time.time()
    for page in ("<" * 200_000, "<p " * 50_000, "<!--" * 50_000, '<a href="' * 50_000, "<b>" * 10_000 + "</i>" * 10_000, "<i><div>" + "<b>" * 10_000 + "</i>" * 10_000, "<p>" * 50_000, "</p " * 50_000):
        h.main_text(page)
    assert time.time() - started < 30
    assert h.main_text("<p>" + LONG + "<!-- never closed <p>" + MORE) == LONG


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, links string"
    long = " ".join([LONG] * 20_000)
    rows = [(1, "a", f"<p>{LONG}</p>", "x", "x", "x")] * 2 + [(None, None, None, "x", "x", "x"), (3, "c", "", "x", "x", "x"), (4, "d", f"<article>{long}", "x", "x", "x")]
    got = {tuple(r) for r in h.extract(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "a", LONG, len(LONG)), (None, None, "", 0), (3, "c", "", 0), (4, "d", long, len(long))}
    assert h.extract(spark.createDataFrame(rows, schema)).count() == 5
    assert h.extract(spark.createDataFrame([], schema)).count() == 0
