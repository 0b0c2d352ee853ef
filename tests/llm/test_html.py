import html as H
import re

from conftest import SF01

from tessera.llm import html
from llm_fixtures import *  # noqa: F401,F403


def expected(page):
    """The article of the given pages, by pattern."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    body = re.sub(r"</?(p|h1|div)\b[^>]*>", "\1", body)
    body = H.unescape(re.sub(r"<[^>]+>", " ", body.replace("<b>", "").replace("</b>", "")))
    return "\n\n".join(x for x in (" ".join(b.split()) for b in body.split("\1")) if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in html.extract_pages(pages).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
<nav>Menu <a href=x>one</a></nav><main><header><h1>Head &amp; line</h1></header>
<p>First   para<br>graph <b>bold</b> with words and some more words here.
<p>Second one, left open; it goes on for a while to be long.<ul><li>a item<li>b item</ul>
<aside>related</aside><form>sign up <input></form><div class="cookie-notice">We use</div>
<section id="comments"><p>Reader says hello to everybody in this long comment.</p></section>
<script>var x = "</p>";</script><div>Last &lt;block&gt;</div></main><footer>&copy;</footer>"""


def test_blocks_and_furniture():
    assert html.extract(PAGE).split("\n\n") == [
        "Head & line", "First para graph bold with words and some more words here.",
        "Second one, left open; it goes on for a while to be long.", "a item", "b item", "Last <block>"]


def test_without_an_article_element():
    text = "word " * 60
    page = f"<body><nav><a>a</a><a>b</a></nav><div>{text}</div><div>{text}x</div><div><a>c</a> <a>d</a></div>"
    assert html.extract(page) == f"{text.strip()}\n\n{text}x"


def test_all_articles_with_content_stay_and_unmarked_menus_go():
    text = "Words that tell a story and go on for a good while, line after line. " * 4
    links = "".join(f"<li><a href=x{i}>Link {i}</a></li>" for i in range(5))
    page = (f"<body><article><p>{text}</p><ul>{links}</ul><p>{text}A</p></article>"
            f"<article><h2>Other</h2><p>{text}B</p><p>See <a href=y>this</a> now.</p></article></body>")
    assert html.extract(page).split("\n\n") == [
        text.strip(), text + "A", "Other", text + "B", "See this now."]
    two = f"<article><p>{text}</p><p><a>one</a></p><p><a>two</a></p><p>{text}</p></article>"
    assert html.extract(two).split("\n\n") == [text.strip(), "one", "two", text.strip()]
    only = f"<article><ul>{links}</ul></article>"
    assert html.extract(only).split("\n\n") == [f"Link {i}" for i in range(5)]


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE)] * 3 + [(2, "v", "<p>b</p>")] * 2,
                               "page_id long, url string, html string")
    got = [(r.page_id, r.text) for r in html.extract_pages(df).collect()]
    assert sorted(got) == [(1, html.extract(PAGE))] * 3 + [(2, "b")] * 2


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article></article>"), (4, None, "plain &amp text"),
            (None, "u", "<p>unclosed <b"), (5, "u", "<article><p>" + "x " * 100000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract_pages(df).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == ["", "", "", "plain & text"]
    assert got[5].n_chars == 199999
    assert html.extract_pages(df.limit(0)).collect() == []
