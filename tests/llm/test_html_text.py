"""Hand-written pages, and whole tables against a plain cut of the article."""

from __future__ import annotations

import html
import re
import time

import pytest

from coursetide.llm import html_text
from coursetide.llm.html_text import main_text

from ..conftest import TESTDATA

LONG = "A sentence that is long enough to be the text of an article and not a menu. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text only", "plain text only"),
        ("a < b and c > d", "a < b and c > d"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("<p>x</p><!-- c <p>y --><p>z", "x\nz"),
        ("<p> a\n\t b <b>c</b>d<br>e </p>", "a b cd e"),
        ("<p>&eacute;&#x41;&amp;lt;&nbsp;x&middot;</p>", "éA&lt; x·"),
        ("<script>if(a<b)document.write('</p>')</script><p>x</p><style>p{}</style>", "x"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
        ("<title>t</title><p>x</p>", "x"),
        ("<article><p>x</p></article><article>", "x"),
        ("<p title='a > b'>x</p>", "x"),
        ("</div></p></b>x", "x"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "waste",
    [
        '<nav><a href="/">Home</a><a href="/b">More</a></nav>',
        "<header><h1>The site</h1></header>",
        f"<footer>{LONG}</footer>",
        f"<aside>{LONG}</aside>",
        f'<div class="sidebar left">{LONG}</div>',
        f'<div id="comments"><p>{LONG}</p><p>{LONG}</p></div>',
        f"<section class='reader-comments'><p>{LONG}</p></section>",
        f'<div class="ad">{LONG}</div>',
        f'<div class="cookie-notice">{LONG}</div>',
        f'<div role="navigation">{LONG}</div>',
        f'<div class="pageFooter">{LONG}</div>',
        f'<div id="userComments-list">{LONG}</div>',
        f'<div class="cookiebar">{LONG}</div>',
        f"<form><p>{LONG}</p><input><button>Send</button></form>",
        f"<p hidden>{LONG}</p>",
        f"<noscript>{LONG}</noscript>",
    ],
)
@pytest.mark.parametrize("inside", ["article", "div"])
def test_what_is_left_out(waste, inside):
    own = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p>"
    for page in (f"{waste}<{inside}>{own}</{inside}>", f"<{inside}>{own}</{inside}>{waste}"):
        assert main_text(f"<html><head><title>t</title></head><body>{page}</body></html>") == f"Title\n{LONG.strip()}\nShort."


def test_names_that_only_look_alike():
    page = f'<div class="headline shadow readable"><p class="lead header-less adding">{LONG}</p></div>'
    assert main_text(page) == LONG.strip()


def test_density_finds_the_text_among_links():
    links = "".join(f'<li><a href="/{k}">Link number {k} of the list</a></li>' for k in range(40))
    page = f"<body><div><ul>{links}</ul></div><div><div><p>{LONG}</p><p>{LONG}</p></div></div></body>"
    assert main_text(page) == f"{LONG.strip()}\n{LONG.strip()}"


def test_broken_pages_take_linear_time():
    for page in ("<div>" * 60_000, "<p>" * 60_000 + "x", "<a b='" * 5000, "<" * 200_000, "<div><b>" * 30_000 + "</i><p>x" * 20_000):
        began = time.process_time()
        main_text(page)
        assert time.process_time() - began < 20


def test_whole_table(spark):
    pages = spark.read.parquet(str(TESTDATA / "sf0.01" / "pages.parquet"))
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1]
        blocks = [re.sub(r"</?b>|<br>", "", b) for b in re.split("</?(?:h1|p)>", article)]
        want = "\n".join(filter(None, (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks)))
        assert got[r.page_id] == want


def test_columns_rows_and_nulls(spark):
    rows = [(1, "<p>x", "own"), (1, "<p>x", "own"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = html_text.extract(pages)
    assert out.columns == ["page_id", "text"]
    assert sorted(map(str, out.collect())) == sorted(
        ["Row(page_id=1, text='x')", "Row(page_id=1, text='x')", "Row(page_id=None, text='')"]
    )
    assert html_text.extract(pages.limit(0)).count() == 0


OWN = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p>"
WANT = f"Title\n{LONG.strip()}\nShort."


@pytest.mark.parametrize(
    "page",
    [
        f'<form id="aspnetForm"><article>{OWN}</article></form>',
        f'<form id="aspnetForm"><div><div>{OWN}</div></div></form>',
        f'<div id="content-sidebar-wrap"><main>{OWN}</main></div>',
        f'<div class="content has-sidebar"><article>{OWN}</article></div>',
        f'<div class="post no-comments"><div>{OWN}</div></div>',
        f'<div class="commentary"><div>{OWN}</div></div>',
        f'<div class="noticeboard-post"><div>{OWN}</div></div>',
        f'<div id="social-care-news"><div>{OWN}</div></div>',
        f'<div class="elementor-widget-theme-post-content"><div>{OWN}</div></div>',
        f'<article><div class="elementor-widget-theme-post-content">{OWN}</div></article>',
        f'<div class="widget"><article>{OWN}</article><div class="sidebar"><p>{LONG}</p></div></div>',
        f'<header class="page"><main>{OWN}</main></header>',
    ],
)
@pytest.mark.parametrize("around", ["", "links", "comments"])
def test_names_on_what_surrounds_an_article(page, around):
    links = "".join(f'<li><a href="/{k}">Link {k} of the list</a></li>' for k in range(30))
    extra = {"": "", "links": f'<div class="navbar"><ul>{links}</ul></div>', "comments": f'<div id="comments"><p>{LONG}</p></div>'}[around]
    assert main_text(f"<body>{page}{extra}</body>") == WANT


@pytest.mark.parametrize("inside", ["article", "div"])
def test_more_comments_than_article(inside):
    said = "".join(f"<div><p>{k} {LONG}</p></div>" for k in range(9))
    for name in ("comments", "comment-list", "discussion", "commentlist"):
        assert main_text(f'<body><{inside}>{OWN}</{inside}><div class="{name}">{said}</div></body>') == WANT


def test_a_long_sidebar_beside_an_article():
    more = "".join(f"<p>{k} {LONG}</p>" for k in range(2))
    for name in ("sidebar", "widget", "related-posts", "social"):
        assert main_text(f'<body><div class="{name}">{more}</div><article>{OWN}</article></body>') == WANT


def test_teasers_in_marked_articles_give_way_to_the_one_outside():
    teasers = "".join(f"<article><p>{LONG[:60]} {k}</p></article>" for k in range(5))
    assert main_text(f'<body><div class="related">{teasers}</div><main>{OWN}</main></body>') == WANT


def test_density_chooses_among_articles():
    teasers = "".join(f'<article><a href="/{k}">{LONG[:80]}</a> <a href="/{k}">More</a></article>' for k in range(5))
    for page in (f"{teasers}<article>{OWN}</article>", f"<article>{OWN}</article>{teasers}"):
        assert main_text(f"<body>{page}</body>") == WANT
