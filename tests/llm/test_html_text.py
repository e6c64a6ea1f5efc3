import html
import re

import pytest

from tallywell.llm.html_text import extract_pages, main_text
from tallywell.session import table

SF_DIR = "/root/testdata/sf0.001"

WORDS = "some words of the article that are long enough to count " * 8


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>one<p>two", "one two"),
    ("<article><h1>T</h1><p>a <b>b</b>c<br>d</p></article>", "T a bc d"),
    ("<article><p>abc <b>def</b", "abc def"), ("<body><article><p title='a > b'>x</p></article>", "x"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ("<article><p>1 &lt; 2 &#233;&nbsp;x</p><script>p('</p>')</script><style>a{}</style></article>", "1 < 2 é x"),
    ("<!-- <p>no</p> --><article><p>yes</p><!-- no --></article>", "yes"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("part", [
    "<nav><a href=/>Home</a></nav>", "<header><h2>Site name</h2><p>Slogan of the site</p></header>", "<footer>&copy; us</footer>",
    "<aside><p>See also this and that</p></aside>", '<div class="sidebar"><p>Popular</p></div>', '<div class="ad">Buy now</div>',
    '<div id="cookie-notice"><p>We use cookies</p></div>', '<form><label>Mail</label><input><button>Go</button></form>',
    '<section class="comments"><h2>2 comments</h2><p>Nice</p></section>', '<div id="comments"><article><p>first!</p></article></div>',
    '<div role="navigation">Home</div>', "<div hidden>secret</div>", '<div style="display: none">secret</div>',
    '<ul class="main-menu"><li><a href=a>A</a></ul>', "<noscript>turn it on</noscript>", '<div class="x"><a href=a>a</a> <a href=b>b</a></div>',
])
@pytest.mark.parametrize("frame", [
    "<html><body>{p}<article><h1>Title</h1><p>{w}</p><p>{w}</p></article></body></html>",
    "<html><body><article><h1>Title</h1><p>{w}</p><p>{w}</p></article>{p}",
    '<body><div class="page-wrapper with-sidebar"><div><h1>Title</h1><p>{w}</p><p>{w}</p></div>{p}</div></body>',
])
def test_parts_of_a_page_are_left_out(part, frame):
    want = " ".join(f"Title {WORDS} {WORDS}".split())
    assert main_text(frame.format(p=part, w=WORDS)) == want


@pytest.mark.parametrize("form", ["form id=aspnetForm", "div role=form"])
@pytest.mark.parametrize("body", [
    "<article><h1>Title</h1><p>{w}</p><p>{w}</p></article>", "<main><h1>Title</h1><p>{w}</p><p>{w}</p></main>",
    "<div><h1>Title</h1><p>{w}</p><p>{w}</p></div>",
])
def test_one_form_around_the_article(form, body):
    controls = "<nav><a href=/>Home</a></nav><label>Mail</label><input><select><option>one</select><button>Go</button>"
    search = "<form><label>Search</label><input></form>" if form.startswith("div") else ""
    page = f"<html><body><{form}>{controls}{body.format(w=WORDS)}{search}<footer>us</footer></{form.split()[0]}></body></html>"
    assert main_text(page) == " ".join(f"Title {WORDS} {WORDS}".split())


def test_two_sections_both_stay():
    page = f"<body><main><div><h1>T</h1></div><div><p>{WORDS}</p><p>{WORDS}</p></div><div><p>{WORDS}</p></div></main></body>"
    assert main_text(page) == " ".join(f"T {WORDS * 3}".split())


def test_driver_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    got = {r.page_id: (r.text, r.n_chars) for r in extract_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r.page_id] == (want, len(want))


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, c0 int, _page string"
    rows = [(None, None, None, "old", "x", 1, "y"), (1, "u", "<p>a</p>", None, None, None, None)] * 2 + [(2, "u", "<p>" + "w " * 200_000, "", "", 0, "")]
    out = extract_pages(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "c0", "_page", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.n_chars, r.text[:3]) for r in out.collect())
    assert got == [(0, 0, ""), (0, 0, ""), (1, 1, "a"), (1, 1, "a"), (2, 399_999, "w w")]
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0
