import html
import re
import unicodedata
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import items
from pressmill.functions import text as X
from pressmill.operators.normalize import normalize_items


def cleaned(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.t for r in X.clean_text(df, ["t"]).orderBy("i").collect()]


def stripped(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.t for r in X.strip_html(df, ["t"]).orderBy("i").collect()]


CLEAN = [
    ("<b>Big</b> day", "Big day"),
    ("a<b>b</b>c", "a b c"),
    ("Ben &amp; <i>Co</i>", "Ben & Co"),
    ("&lt;b&gt; stays", "<b> stays"),
    ("a < b and c > d", "a < b and c > d"),
    ("x <!-- <script> --> y", "x y"),
    ('one<script>var t="</p>";</script>two', "one two"),
    ("keep <style>p{}</style> <template>no</template> this", "keep this"),
    ('<a title="1>0">link</a>', "link"),
    ("<p don't>odd</p>", "odd"),
    ("unclosed <script> all gone", "unclosed"),
    ("ruby <ruby>kan<rt>ji</rt></ruby> end", "ruby kan end"),
    ("nb sp &nbsp;  wide\x1cgap", "nb sp wide gap"),
    ("ﬁne ½ Ａ", "fine 1⁄2 A"),
    ("été", "été"),
    ("&apos;q&apos; &#233; &#x41; &amp;apos;", "'q' é A &apos;"),
    ("<?xml version='1.0'?><!DOCTYPE html>t", "t"),
    ("  \n\t ", None),
    ("<br/>", None),
    ("", None),
    (None, None),
]


def test_clean_text_cases(spark):
    assert cleaned(spark, *[c[0] for c in CLEAN]) == [c[1] for c in CLEAN]


def test_strip_keeps_space_inside_a_node(spark):
    assert stripped(spark, "a  b <i> c  d </i>&nbsp;", " <b>x</b>\n<b>y</b> ", "<p></p>") == ["a  b c  d", "x y", None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_characters="<&\ufdd0", exclude_categories=["Cs"])), min_size=1, max_size=30))
def test_clean_plain_text_is_nfkc_and_split_join(spark, texts):
    want = [" ".join(unicodedata.normalize("NFKC", t).split()) or None for t in texts]
    assert cleaned(spark, *texts) == want


class _Nodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.nodes = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.nodes.append(data.strip())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(["<b>", "</b>", "<p class='x'>", "<br>", "word", " ", "two words", "&amp;", "<!-- c -->",
                             "<script>x<y</script>", "&eacute;", "\n", "<a href=\"u?a=1&b=2\">"]),
            max_size=15,
        ),
        min_size=1,
        max_size=20,
    )
)
def test_markup_matches_an_html_parser(spark, pieces):
    docs = ["".join(p) for p in pieces]
    want = []
    for doc in docs:
        parser = _Nodes()
        parser.feed(doc)
        parser.close()
        want.append(" ".join(" ".join(n for n in parser.nodes if n).split()) or None)
    assert cleaned(spark, *docs) == want


def test_stable_range_is_unchanged_by_nfkc():
    stable = re.compile(f"[{X.NFKC_STABLE}]")
    inside = [chr(c) for c in range(0x10000) if stable.match(chr(c))]
    assert len(inside) == 0x80 + 0x72
    assert all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in inside)


def test_long_runs_of_space_stay_linear(spark):
    text = "a" + " " * 300_000 + "b" + "<b>" + " " * 300_000 + "</b>c"
    assert cleaned(spark, text) == ["a b c"]
    assert len(stripped(spark, text)[0]) == 300_004


def test_deeply_marked_text_does_not_overflow(spark):
    text = "<a href='x' b=c>" * 50_000 + "t" + "<" + "x" * 200_000
    assert cleaned(spark, text)[0].startswith("t<x")


def test_normalize_golden(spark):
    df = items(
        spark,
        {"title": "<b>Hi</b>", "content": "Ben &amp; <i>Co</i>", "url": " https://x.test/a \n", "tags": ["A", "a", "b"]},
        {"title": " ", "summary": "", "content": "<p></p>"},
        {"url": "u2", "summary": "only summary", "author": "<i>Ann</i>"},
    )
    got = {r.url: r for r in normalize_items(df).collect()}
    assert set(got) == {"https://x.test/a", "u2"}
    first = got["https://x.test/a"]
    assert (first.title, first.content, first.tags, first.summary) == ("Hi", "Ben & Co", ["a", "b"], None)
    assert got["u2"].author == "Ann"


def test_normalize_runs_python_once(spark):
    plan = normalize_items(items(spark, {"title": "t"}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("entity", ["copy", "middot", "eacute", "mdash", "euro", "nbsp"])
def test_named_entities(spark, entity):
    want = " ".join(unicodedata.normalize("NFKC", html.unescape(f"&{entity};")).split()) or None
    assert cleaned(spark, f"&{entity};") == [want]
