from __future__ import annotations

import html
import re
import time

import pytest

from scanyard.llm import html_text
from scanyard.llm.html_text import main_text

PARAGRAPH = "<p>" + "word and more words, " * 12 + "</p>"
TEXT = " ".join(("word and more words, " * 12).split())


@pytest.mark.parametrize("page,text", [
    ("", ""),
    ("plain  text &amp; more\n here", "plain text & more here"),
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<b>un<i>closed", "unclosed"),
    ("<p>x<!-- c", "x"),
    ("x<script>var a='</p>'", "x"),
    ("a<br>b", "a b"),
    ("<p>one <b>two</b><i>three</i></p>", "one twothree"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<p title='a>b' class=\"x\">t</p>", "t"),
    ("<p>a &lt;b&gt; &#233; &#x1F600; &nbsp; c</p>", "a <b> é 😀 c"),
    ("<p>x</p><p cla", "x"),
    ("<DIV CLASS='Side-Bar'>menu</DIV><P>x</P>", "x"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("junk", [
    "<nav><a href='/'>Home</a></nav>", "<header>Site name</header>", "<footer>Legal</footer>",
    "<aside>Other things</aside>", "<div class='ad'>Buy this</div>", "<form>Name <input></form>",
    "<script>x('<p>no</p>')</script>", "<style>p{}</style>", "<div id='comments'><p>First!</p></div>",
    "<div class='cookie-notice'>We use cookies</div>", "<div role='navigation'>Menu</div>",
    "<div hidden>secret</div>", "<ul class='menu'><li>a<li>b</ul>"])
@pytest.mark.parametrize("wrap", ["article", "main", "div", "section"])
def test_boilerplate_goes_and_the_article_stays(junk, wrap):
    body = f"<{wrap}><h1>Title</h1>{PARAGRAPH}<p>short</p>{PARAGRAPH}</{wrap}>"
    for page in (f"<body>{junk}{body}</body>", f"<body>{body}{junk}</body>",
                 f"<body><div class='page-with-sidebar'>{junk}{body}</div></body>"
                 if wrap in ("article", "main") else f"<body><div>{junk}{body}</div></body>"):
        assert main_text(page) == f"Title\n\n{TEXT}\n\nshort\n\n{TEXT}"


def test_boilerplate_inside_the_article_goes():
    page = f"<article><h1>T</h1>{PARAGRAPH}<div class='share'>Tell</div>" \
           f"<section class='comments'><p>hi</p></section>{PARAGRAPH}</article>"
    assert main_text(page) == f"T\n\n{TEXT}\n\n{TEXT}"


def test_links_lower_the_density():
    links = "<div>" + "<a href='/x'>link text of some length</a> " * 30 + "</div>"
    assert main_text(f"<body>{links}<div>{PARAGRAPH * 3}</div></body>") == "\n\n".join([TEXT] * 3)


def test_any_depth_and_any_markup():
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert main_text("</p></div><li></ul><<>< p><p>x</b></p>") .endswith("x")
    assert main_text("<p>" + "a " * 200_000) == ("a " * 200_000).strip()


def test_given_pages_equal_their_article(spark):
    """The test pages hold the article in an element of that name."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.id: r.text for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert got[row.page_id] == "\n\n".join(filter(None, blocks))


def test_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "<p>x")]
    schema = "page_id long, url string, html string, text string, body string, id int"
    pages = spark.createDataFrame([(*r, "a", "b", 3) for r in rows], schema)
    got = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=repr)
    assert got == sorted([(1, None, ""), (2, "u", ""), (2, "u", ""), (None, "v", "x")], key=repr)
    assert html_text.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("outer", [
    "div class='page-with-sidebar'", "div class='layout has-sidebar'", "div id='no-comments'",
    "div class='content-sidebar-wrap'", "div class='post social'", "div class='elementor-widget'",
    "form action='/'", "section class='main related'"])
@pytest.mark.parametrize("wrap", ["article", "main", "div", "section"])
def test_what_wraps_the_text_is_not_boilerplate(outer, wrap):
    junk = "<div class='ad'>Buy this</div><form>Name <input></form>"
    body = f"<{wrap}><h1>Title</h1>{PARAGRAPH}<p>short</p>{PARAGRAPH}</{wrap}>"
    page = f"<body><{outer}>{junk}{body}</{outer.split()[0]}><div class='footer'>Legal</div></body>"
    assert main_text(page) == f"Title\n\n{TEXT}\n\nshort\n\n{TEXT}"


def test_hints_do_not_empty_a_page():
    widget = f"<div class='elementor-widget'>{PARAGRAPH}</div>"
    assert main_text(f"<body><div>{widget * 3}</div></body>") == "\n\n".join([TEXT] * 3)
    assert main_text("<body><div class='social'>few words</div></body>") == "few words"
    page = "<body>" + f"<div class='related'>{PARAGRAPH}</div>" * 3 + "</body>"
    assert main_text(page) == "\n\n".join([TEXT] * 3)


def test_long_comments_beside_an_article_go():
    comments = f"<div id='comments' class='comments-area'>{PARAGRAPH * 9}</div>"
    assert main_text(f"<body><article>{PARAGRAPH}</article>{comments}</body>") == TEXT


def test_a_short_article_does_not_displace_the_text():
    page = f"<div class='post social'>{PARAGRAPH * 5}</div><article>{PARAGRAPH}</article>"
    assert main_text(f"<body>{page}</body>").count(TEXT) >= 5


@pytest.mark.parametrize("page,text", [
    ("<p title=don't>one</p><p>two</p>", "one\n\ntwo"),
    ("<a href=\"x\"\">one</a><p class=\"y\">two</p>", "one\n\ntwo"),
    ("<p x'y>one</p><p>it's two</p>", "one\n\nit's two"),
    ("<p \">one</p><p class='y'>two</p>", "one\n\ntwo"),
    ("<p title=a\"b>c\">one</p>", "c\">one"),
    ("<p a = 'x>y' b=\"z>\"c>one</p>", "one"),
    ("<p a= >one</p><p b=>two</p><br/>x", "one\n\ntwo\n\nx"),
    ("<p a=/x/y/>one</p><p =\"b>two\"</p>", "one\n\ntwo\""),
    ("<div class='ad'\"x>no</div><p>one", "one"),
    ("<div x=it's class=ad>no</div><p>one", "one"),
    ("x<p title=\"y>z", "x"),
])
def test_quotes_open_a_value_only_after_an_equals_sign(page, text):
    assert main_text(page) == text


def test_a_tag_without_end_is_read_once():
    assert main_text("x<p " + "a='\" = " * 100_000) == "x"


@pytest.mark.parametrize("wrap", ["{}", "<div>{}</div>", "<main>{}</main>"])
def test_sibling_articles_all_stay(wrap):
    article = f"<article><h2>Title</h2>{PARAGRAPH * 6}</article>"
    got = main_text(f"<body><div class='ad'>Buy this</div>{wrap.format(article * 3)}</body>")
    assert got == "\n\n".join(["Title", *[TEXT] * 6] * 3)


def test_stray_end_tags_cost_nothing():
    """Many open elements and many end tags of none of them."""
    start = time.monotonic()
    tree = html_text.Tree("<div>" * 50_000 + "</section>" * 200_000 + "<p>" * 50_000
                          + "</b>" * 100_000 + "<td>" * 20_000)
    assert len(tree.tag) > 100_000 and time.monotonic() - start < 20
