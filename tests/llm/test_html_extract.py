"""Main text of pages: planted boilerplate of every kind, browser-style tag closing, odd rows, and the tables' pages."""

import html as htmllib
import os
import re

import pytest

from pressmill.llm import html_extract
from test_operators import prose

ARTICLE = "<article><h1>Head &amp; line</h1><p>{0}</p><p><b>{1}</b> and <a href='/x'>a link</a> inside.<p>{2}</p></article>"


def page(body, head="<title>T</title><style>p{x}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def main(*parts):
    return ["Head & line", parts[0], f"{parts[1]} and a link inside.", parts[2]]


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>",
        "<header><a href=/>Site name</a> Welcome to the site of all news</header>",
        "<footer>&copy; example &middot; all rights reserved to the owners of it</footer>",
        "<aside><h3>Popular</h3><p>Some other story that people read a lot today</p></aside>",
        "<div class='cookie-notice'>We use cookies to give you the best experience, accept them now</div>",
        "<!-- ad --><div class='ad'>Buy one now and save money on every single thing</div>",
        "<form><label>Name</label><input name=n><textarea>say something long here</textarea><button>Send</button></form>",
        "<section id='comments'><h3>Comments</h3><p>Great article, thanks a lot for writing it!</p><p>I disagree with everything.</p></section>",
        "<div role='navigation'><a href=/1>One</a> <a href=/2>Two</a></div>",
        "<div style='display: none'>hidden text of some length that nobody sees at all</div>",
    ],
)
def test_each_kind_of_boilerplate_goes(noise):
    parts = [prose(60, 1), prose(12, 2), prose(40, 3)]
    want = "\n".join(main(*parts))
    inside = ARTICLE.format(*parts).replace("</article>", noise + "</article>")
    for body in (noise + ARTICLE.format(*parts), ARTICLE.format(*parts) + noise, *([inside] if "<header>" not in noise else [])):
        assert html_extract.extract(page(body)) == want


def test_a_header_inside_the_article_is_its_title():
    body = f"<header><a href=/>Site</a></header><article><header><h1>The title</h1></header><p>{prose(40, 1)}</p></article>"
    assert html_extract.extract(page(body)) == "The title\n" + prose(40, 1)


def test_blocks_spaces_references_and_unclosed_tags():
    text = page("<div><p>a&nbsp;&nbsp;b\n\t c &#233;&#x41;<p>second<ul><li>one<li>two</ul><p>  </p><h2>end &lt;x&gt;</h2></div>")
    assert html_extract.extract(text) == "a b c éA\nsecond\none\ntwo\nend <x>"
    assert html_extract.extract("plain text, no tags at all") == "plain text, no tags at all"
    assert html_extract.extract("") == html_extract.extract(None) == html_extract.extract("<html><body><nav>x</nav></body></html>") == ""


def test_link_lists_inside_the_main_text_go_and_short_paragraphs_stay():
    links = "<ul>" + "".join(f"<li><a href=/{k}>Related story number {k}</a>" for k in range(8)) + "</ul>"
    body = f"<article><p>{prose(80, 4)}</p><p>Short one.</p>{links}<p>{prose(50, 5)}</p></article>"
    assert html_extract.extract(page(body)) == "\n".join([prose(80, 4), "Short one.", prose(50, 5)])


def test_long_pages_and_odd_rows(spark):
    long_par = prose(600_000, 6)  # about 3 MB in one paragraph
    many = "".join(f"<p>{prose(20, k)}</p>" for k in range(20_000))
    deep = "<div>" * 5000 + "deep text here" + "</div>" * 5000
    rows = [(1, "u1", page(f"<article><p>{long_par}</p></article>")), (2, "u2", page(f"<main>{many}</main>")), (3, None, None), (4, "u4", ""),
            (5, "u5", page(deep)), (5, "u5", page(deep)), (None, "u6", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1)})
    got = sorted((tuple(r) for r in html_extract.extract_pages(df).collect()), key=repr)
    want = sorted(((i, u, t, len(t)) for i, u, h in rows for t in [html_extract.extract(h)]), key=repr)
    assert got == want
    by = {r[0]: r for r in got}
    assert by[1][2] == long_par and by[2][2].count("\n") == 19_999 and by[5][2] == "deep text here" and by[3][2] == "" and by[4][3] == 0
    assert html_extract.extract_pages(df.limit(0)).count() == 0


FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
def test_pages_of_the_tables_equal_their_articles(spark):
    """The tables' pages hold one article; its heading and paragraphs, cut out by a plain rule, are the main text."""
    from pressmill.llm.queries import QUERIES

    def plain(h):
        inner = re.search(r"<article>(.*)</article>", h or "", re.S)
        if not inner:
            return ""
        blocks = re.split(r"<(?:h1|p)>", inner.group(1))
        texts = (" ".join(htmllib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op12_html_extract"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].url == r.url and got[r.page_id].n_chars == len(plain(r.html))
