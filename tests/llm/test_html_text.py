import html
import re
import time
import tracemalloc

import pytest

from skylattice.llm.html_text import extract_text, main_text
from skylattice.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var a = "<p>no</p>";</script></head><body class="page sidebar-left">
<header class="top"><a href="/">Home</a><p>The site's own slogan, which is long enough.</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies. They are good for you, so please accept.</p></div>
{open}<h1>A   title &amp; more</h1>
<p>First paragraph with <b>bold</b>, a <a href="x">link</a>&nbsp;and text; quite long.<br>New line.
<p>Second one, unclosed <i>too. It goes on, and on, and on.</p>
<ul><li>Point one</li><li>Point two.</li></ul>
<div class="ad banner"><p>Buy now! It is cheap, good, and yours.</p></div>
<blockquote>Quoted &lt;text&gt;.</blockquote>
<form><label>Mail</label><input name="m"><button>Go</button></form>{close}
<aside><p>Related: another story, which you may like. Or not.</p></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Nice article, I liked it. Very much
so, and I write long comments, longer than anything, as you see here.</p></div></section>
<div hidden><p>Unseen words. Never shown, of course.</p></div>
<footer><p>&copy; Somebody, all rights reserved. Imprint.</p></footer></body></html>"""

TEXT = "\n\n".join(
    [
        "A title & more",
        "First paragraph with bold, a link and text; quite long. New line.",
        "Second one, unclosed too. It goes on, and on, and on.",
        "Point one",
        "Point two.",
        "Quoted <text>.",
    ]
)


@pytest.mark.parametrize(
    ("open_", "close"),
    [
        ("<article>", "</article>"),
        ("<main>", "</main>"),
        ('<div class="content">', "</div>"),
        ("<div id=x1><div class='q7'>", "</div></div>"),
        ("<main><article class='post'>", "</article></main>"),
        ("<table><tr><td>", "</td></tr></table>"),
    ],
)
def test_article_without_the_rest(open_, close):
    page = PAGE.replace("{open}", open_).replace("{close}", close)
    assert main_text(page) == TEXT


def article_of(page):
    """The test pages' own article by plain string work; they have just one template."""
    body = page.split("<article>", 1)[1].split("</article>", 1)[0]
    parts = re.split(r"</?(?:p|h1)>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
    return "\n\n".join(x for x in texts if x)


def test_query_against_the_template(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op10_path_ratio_text"](spark, SF_DIR).collect()}
    assert len(got) == len(pages)
    for page in pages:
        row = got[page.page_id]
        assert row.text == article_of(page.html)
        assert row.n_chars == len(row.text) and row.url == page.url


def test_awkward_pages(spark):
    rows = [
        (1, None, None),
        (1, "u", ""),
        (2, "u", "   <p></p><div> </div>"),
        (3, "u", "plain text, no markup. At all."),
        (4, "u", "<p>open <b>bold <p>next &amp; last"),
        (5, "u", "<p a='>\">x < y > z</p></div></p>"),
        (6, "u", "<!-- never closed <p>a</p>"),
        (7, "u", "<div>" * 3000 + "deep, but there." + "</div>" * 10),
        (None, "u", "<p>" + "long words. " * 50_000),
        (8, "u", "<script>x</script"),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = table.selectExpr("*", "'x' as text", "1 as n_chars")
    got = {(r.page_id, r.url): r for r in extract_text(table).collect()}
    assert got[(1, None)].text == got[(1, "u")].text == got[(2, "u")].text == ""
    assert got[(3, "u")].text == "plain text, no markup. At all."
    assert got[(4, "u")].text == "open bold\n\nnext & last"
    assert got[(6, "u")].text == "" and got[(8, "u")].text == ""
    assert got[(7, "u")].text == "deep, but there."
    assert got[(None, "u")].n_chars == 12 * 50_000 - 1
    assert extract_text(table.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("open_", "close"),
    [
        ("<article class='post no-sidebar'>", "</article>"),
        ("<article class='post category-social'>", "</article>"),
        ("<article class='comment'>", "</article>"),
        ("<div class='content-sidebar-wrap'>", "</div>"),
    ],
)
def test_names_do_not_bar_the_article(open_, close):
    assert main_text(PAGE.replace("{open}", open_).replace("{close}", close)) == TEXT


def test_names_are_not_heeded_if_they_leave_nothing():
    page = "<nav>Menu, here.</nav><div class='social'><p>All there is, in one div.</p></div>"
    assert main_text(page) == "All there is, in one div."


def test_formulas_stay_in_the_text():
    page = "<article><p>So <math><mi>a</mi><mo>=</mo><mi>b</mi></math> holds.</p></article>"
    assert main_text(page) == "So a=b holds."


#: What a page around or in the article may hold, none of it the article's.
REMARK = """<div {0}><h3>Remarks</h3><p>REMARK one, which is long; so long, in fact, that it is longer
than the article, with commas, points, and all that text has. Is it? It is!</p><p>REMARK two.</p>
</div>"""

NAMES = """post-comments entry-comments user-comments reader-comments comments-area commentlist
comment-list userComments comment-thread disqus_thread article-footer site-footer entry-footer
pageFooter left-sidebar sidebar-right sidebarLeft main-nav site-navigation js-ad-slot ad-top
advert-box sponsored-content promo-box cookie-bar cookieConsent gdpr-notice newsletter-signup
related-posts recommended-stories share-buttons social-links widget-area breadcrumb-trail
copyright-line""".split()

BODY = """<h1>The title</h1><p>First paragraph, which says a few things; some of them long.</p>
<h2>Part</h2><p>Second paragraph. It goes on, and on, and has a <a href="x">link</a> in it.</p>
<ul><li>A</li><li>B</li></ul><table><tr><td>1<td>2<tr><td>3</table><p>Last words.</p>"""

WORDS = [
    "The title",
    "First paragraph, which says a few things; some of them long.",
    "Part",
    "Second paragraph. It goes on, and on, and has a link in it.",
    *"AB123",
    "Last words.",
]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("attribute", ["class='{}'", "class='box {} x2'", "id={}"])
def test_named_parts_go_inside_and_beside_the_article(name, attribute):
    remark = REMARK.format(attribute.format(name))
    for open_, close in (
        ("<article>", "</article>"),
        ("<main><article class='post'>", "</article></main>"),
        ("<div class='content'>", "</div>"),
        ("<div><section>", "</section></div>"),
        ("<div role=main>", "</div>"),
    ):
        for page in (
            f"<body>{open_}{BODY}{remark}{close}</body>",
            f"<body>{open_}{BODY}{close}{remark}</body>",
            f"<body>{remark}{open_}{BODY}{close}</body>",
        ):
            assert main_text(page) == "\n\n".join(WORDS), page


@pytest.mark.parametrize(
    "opening",
    [
        "<article class='post no-sidebar'>",
        "<article class='post category-social tag-comment'>",
        "<article class='hentry share-enabled'>",
        "<div class='content-sidebar-wrap'>",
        "<div class='with-sidebar'>",
        "<div class='sidebar-layout'>",
        "<div class='commentary'>",
        "<div class='left-sidebar-page' id='page'>",
        "<div data-class='comments' title='class=footer'>",
        "<div class='social'>",
        "<form action='/postback'><div>",
    ],
)
def test_names_that_are_not_about_the_article_do_not_bar_it(opening):
    close = "".join(f"</{x}>" for x in reversed(re.findall(r"<(\w+)", opening)))
    rest = REMARK.format("id='comments'") + "<footer>REMARK, of the footer.</footer>"
    for page in (f"{opening}{BODY}{close}{rest}", f"<div>{opening}{BODY}{rest}{close}</div>"):
        assert main_text(page) == "\n\n".join(WORDS), page


def test_runs_of_links_go_by_their_ratio():
    menu = "".join(f"<li><a href=/{n}>Entry number {n}</a></li>" for n in range(9))
    page = f"<article><ol class=x>{menu}</ol>{BODY}<p><a href=y>Source</a></p></article>"
    assert main_text(page) == "\n\n".join([*WORDS, "Source"])


def test_long_comments_do_not_outweigh_a_short_article():
    remarks = "".join(
        f"<article class='comment'><p>REMARK {n}, {'as long as can be, ' * 20}.</p></article>"
        for n in range(50)
    )
    for around in ("<div class='comments'>{}</div>", "{}"):
        page = f"<article><h1>News</h1><p>Great news today</p></article>{around.format(remarks)}"
        assert main_text(page) == "News\n\nGreat news today"


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<a " * n,
        lambda n: "<a \"'>" * n + '"',
        lambda n: "<!" * n,
        lambda n: "</" * n,
        lambda n: "<script" + " </script" * n,
        lambda n: "<p " + "class " * n + ">x",
        lambda n: "<p " + 'class="' * n + ">x",
        lambda n: "<p class" + " " * n + ">x",
        lambda n: "<div>" * n + "x",
        lambda n: "<div class=a>" * n + "</section>" * n + "x",
        lambda n: "<ul><li>" + "<blockquote>" * n + "<li></li>" * n,
        lambda n: "<table>" + "<tr><td>x" * n,
        lambda n: "<p>" + "<blockquote><p>x" * n,
        lambda n: "&" * n + "<" * n + "&#" * n,
    ],
)
def test_time_and_memory_grow_with_the_page(page):
    def cost(n):
        text = page(n)
        tracemalloc.start()
        main_text(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        seconds = []
        for _ in range(3):
            start = time.process_time()
            main_text(text)
            seconds.append(time.process_time() - start)
        return min(seconds), peak

    seconds, peak = cost(4_000)
    more_seconds, more_peak = cost(16_000)
    assert more_seconds < 8 * seconds + 0.05
    assert more_peak < 6 * peak + 100_000
