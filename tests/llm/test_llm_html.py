import html
import re

import pytest

from conftest import SF_ORACLE
from fundflow.llm import html_extract as S
from fundflow.llm.common import table

PAGE = """<html><body class="has-sidebar"><div id="cookie-notice">We use cookies. Accept all of them, please.</div>
<header><a href=x>Home</a> Site name</header><div class="menu"><a>One</a> <a>Two</a></div>
<div class="content"><h1>Title &amp; more</h1><p>First&nbsp;para with <a href="q">a link</a> and <b>bold</b>text
that is rather long so that it surges well over the threshold.<p>Second short.<div class="ad">Buy now</div>
<p>Third one<br>with break; still inside the text and long enough.</p><ul><li>item one<li>item two</ul></div>
<aside>Related stuff that is long and would otherwise be kept as it has lots of text in it</aside>
<form><p>Name <input><textarea>abc</textarea></form>
<section id="comments"><p>I am a reader comment, quite long, and should not be in the text at all.</p></section>
<footer>(c) 2020</footer></body></html>"""


def test_page_without_a_named_article():
    assert S.main_text(PAGE).split("\n") == [
        "Title & more",
        "First para with a link and boldtext that is rather long so that it surges well over the threshold.",
        "Second short.", "Third one with break; still inside the text and long enough.", "item one", "item two"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<script>x", ""),
    ("a < b & c &lt;d&gt; <3", "a < b & c <d> <3"), ('<p title="a>b">q</p>', "q"), ('<p class="ad">ad<p>real', "real"),
    ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>"
     "<article class='comment'><p>no</p></article>", "T\nx"),
    ('<article><p title="a class=ad b">keep<span class="ad">zz</span>this</p><button>Go</button></article>', "keepthis"),
    ("<div><article></article><p>only text outside</div>", "only text outside"),
    ("<article>a<!-- > -->b<style>p{}</style></article>", "ab"), ("<article><p>&#233;&eacute;&#x1F600;", "éé😀"),
    ("<article><p>x</p>" + "<p></p>" * 50 + "<p>y</p></article>", "x\ny"),
    ("<div class='entry-header'><h1>Head</h1></div><p>" + "w " * 100 + "</p>", "Head\n" + ("w " * 100).strip()),
    ("<main><p>t</main><div>outside text that is long enough to be picked up by itself, were it not for main</div>", "t"),
    ("<div id=content><h1>T</h1><p>short</div><div>out</div>", "T\nshort"),
    ("<div class=content>x</div><div>" + "long text " * 20 + "</div>", "x\n" + ("long text " * 20).strip()),
    ("<p hidden>no</p><div style='display: none'>no</div><div aria-hidden=true>no</div><p>yes", "yes"),
])
def test_cases(page, text):
    assert S.main_text(page) == text


def test_stretches():
    assert S.stretches([0, 5, 0, 0, 7, 0, 0, 0, 2], 3) == [(1, 5, 7), (8, 9, 2)]
    assert S.stretches([], 3) == [] and S.stretches([0, 0], 3) == []


def test_long_and_broken_markup_is_read_in_one_pass():
    assert S.main_text("<article>" + "<p>x</p>" * 50_000) == "\n".join(["x"] * 50_000)
    assert S.main_text("<div>" * 20_000 + "deep") == "deep"
    assert S.main_text('<a href="' * 2_000 + "x") is not None
    assert len(S.main_text("<p>" + "word " * 200_000)) == 999_999


def test_whole_table(spark):
    pages = table(spark, SF_ORACLE, "pages")
    got = {r.page_id: r for r in S.extract(pages).collect()}
    for p in pages.collect():
        body = p.html[p.html.index("<article>"):p.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?p>|</?h1>", body))
        text = "\n".join(b for b in blocks if b)
        r = got[p.page_id]
        assert (r.text, r.n_chars, r.url) == (text, len(text), p.url)


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (1, "u", "<p>😀", "t"), (None, "u", "", "t")],
                                  "page_id long, url string, html string, text string").withColumnRenamed("text", "text")
    out = S.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("", 0), ("", 0), ("😀", 1)]
    assert S.extract(pages.filter("false")).count() == 0


BODY = "<h1>Title</h1>" + "<p>A paragraph of the article that is long enough to be its text.</p>" * 4
KEPT = "\n".join(["Title"] + ["A paragraph of the article that is long enough to be its text."] * 4)


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'>BODY<div class=sidebar>Side</div></div>",
    "<div id='page' class='no-sidebar'>BODY</div>", "<div id=page class='sidebar-right'>BODY</div><p class=ad>x</p>",
    "<article class='post comments-open category-social'>BODY</article>",
    "<div class='banner wrap'><div class='social'>BODY</div></div>",
    "<article class='post social'>BODY</article><p>Home",
    "<div class=content>BODY</div><div class=comments>" + "<p>A reader says a lot about it, too.</p>" * 99 + "</div>",
    "<article>BODY</article><div class='cookie-notice'>" + "We use cookies. " * 99 + "</div>",
    "<div class=content>BODY</div><div class=menu>" + "<a>One more link</a> " * 99 + "</div>",
])
def test_labels_around_the_text_are_no_furniture(page):
    assert S.main_text(page.replace("BODY", BODY)) == KEPT


def test_nested_labels_are_read_in_one_pass():
    assert S.main_text("<div class=banner>" * 20_000 + "<p>deep</p>" * 20_000) == "\n".join(["deep"] * 20_000)


@pytest.mark.parametrize("page, text", [
    ("<article><p>A teaser card.</p></article><main>BODY</main>", KEPT),
    ("<main>BODY</main><article><p>A teaser card.</p></article>", KEPT),
    ("<div><article><p>A teaser card.</p></article></div><div>BODY</div>", "A teaser card.\n" + KEPT),
    ("<div class=content>BODY<article>A teaser card.</article></div>", KEPT + "\nA teaser card."),
    ("<main><article>BODY</article><p>Short</p></main>", KEPT),
    ("<div><h1>Head</h1><div class=menu><p>a<p>b<p>c</div>BODY<div class=ad><p>a<p>b<p>c</div><p>The end.</div><div><p>Out",
     "Head\n" + KEPT + "\nThe end."),
    ("<div>BODY<div class=ad><p>a<p>b<p>c</div><p>See <a>this page, too</a>.<p><a>More</a></div>", KEPT + "\nSee this page, too."),
])
def test_small_marks_and_parted_lines(page, text):
    assert S.main_text(page.replace("BODY", BODY)) == text


def _blocks(page):
    body = page[page.index("<article>"):page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
              for b in re.split("</?p>|</?h1>", body))
    return "\n".join(b for b in blocks if b)


def test_pages_without_marks_are_read_by_the_distribution(spark):
    pages = [(r.page_id, r.html) for r in table(spark, SF_ORACLE, "pages").collect()]
    furniture = ("<div class='cookie-banner'>We use cookies on all of these pages, please accept them now.</div>"
                 "<ul class='menu'>" + "<li><a href=x>Link to some page</a></li>" * 8 + "</ul>")
    wrong = 0
    for page_id, page in pages:
        plain = page.replace("<article>", "<div>").replace("</article>", "</div>")
        if page_id % 2:
            plain = plain.replace("<body>", "<body>" + furniture)
        wrong += S.main_text(plain) != _blocks(page)
    assert wrong == 0


def test_window_and_peak_decide():
    part = "<div class=content><p>" + "first part of the text " * 9 + "</p></div>"
    page = part + "<h2>Between</h2>" + part.replace("first", "second")
    assert "Between" in S.main_text(page) and "Between" not in S.main_text(page, window=1)
    page = "<p>" + "long text here " * 20 + "</p>" + "<nav>n</nav>" * 5 + "<div><p>Some forty letters of other text</p></div>"
    assert "forty" not in S.main_text(page) and "forty" in S.main_text(page, peak=10)
