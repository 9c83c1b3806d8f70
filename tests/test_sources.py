import pytest
from pyspark.sql import functions as F

from pressmill.operators.normalize import normalize_items
from pressmill.schemas import FEED_PAYLOAD
from pressmill.sources.feeds import epoch_seconds, feed_rejects, parse_feeds
from pressmill.sources.pages import extract_pages, page_items
from pressmill.sources.records import read_records
from pressmill.sources.registry import read_sources, source_registry

RSS = '<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel>{}</channel></rss>'


@pytest.fixture
def registry(spark):
    return source_registry(spark, [{"id": "s", "type": "rss", "url": "https://s.test/feed", "tags": ["finance"]}])


def feed(spark, *payloads, source="s"):
    return spark.createDataFrame([(source, p) for p in payloads], FEED_PAYLOAD)


def parsed(spark, registry, payload):
    return sorted(parse_feeds(feed(spark, payload), registry, fetched_at=7).collect(), key=lambda r: r.url)


def test_full_rss_entry(spark, registry):
    (got,) = parsed(
        spark,
        registry,
        RSS.format(
            "<title>Channel</title><link>https://s.test</link>"
            "<item><title>Rates <b>up</b></title><link> https://s.test/1 </link><description>Short</description>"
            "<author>Jo <b>Ho</b></author><pubDate>Tue, 02 Apr 2024 08:30:00 GMT</pubDate>"
            '<content:encoded xmlns:content="c">\n<![CDATA[<p>Long &amp; full</p>&nbsp;R&D]]>\n</content:encoded></item>'
        ),
    )
    assert (got.source_id, got.url, got.title, got.summary) == ("s", "https://s.test/1", "Rates up", "Short")
    assert (got.content, got.published_at, got.fetched_at) == ("Long & full R&D", 1712046600, 7)
    assert (got.language, got.tags, got.author) == ("en", ["finance"], "Jo <b>Ho</b>")


def test_empty_channel_gives_nothing(spark, registry):
    assert parsed(spark, registry, RSS.format("")) == []


CONTENT = [
    ("<description>Wheat <em>rose</em> again</description>", "Wheat rose again"),
    ("<description>Short</description><content:encoded><![CDATA[All <p>of</p> it]]></content:encoded>", "All of it"),
    ("<description>A &amp; B &lt;tags C&nbsp;D E&F</description>", "A & B <tags C\u00a0D E&F"),
    ("<content:encoded><![CDATA[text with stray <mark>]]></content:encoded>", "text with stray"),
    ("<title>t</title>", None),
]


@pytest.mark.parametrize("inner,want", CONTENT)
def test_content_of_an_entry(spark, registry, inner, want):
    (got,) = parsed(spark, registry, RSS.format(f"<item><link>https://s.test/x</link>{inner}</item>"))
    assert got.content == want


def test_entries_without_link_are_skipped_and_guid_stands_in(spark, registry):
    got = parsed(
        spark,
        registry,
        RSS.format(
            "<item><title>none</title></item><item><link></link><title>empty</title></item>"
            "<item><link>https://s.test/b</link></item><item><guid>https://s.test/g</guid></item>"
            '<item><guid isPermaLink="false">tag:1</guid></item>'
        ),
    )
    assert [r.url for r in got] == ["https://s.test/b", "https://s.test/g"]


def test_atom_and_rdf(spark, registry):
    atom = (
        '<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>'
        "<entry><title>By id</title><id>https://s.test/1</id><content>Hello</content></entry>"
        '<entry><title type="html">A &lt;i&gt;b&lt;/i&gt;</title><link rel="enclosure" href="https://s.test/no"/>'
        '<link rel="alternate" href="https://s.test/2"/><id>urn:2</id><updated>2024-01-01T00:00:00+01:00</updated>'
        "<author><name>Ann</name></author><summary>Sum</summary></entry></feed>"
    )
    one, two = parsed(spark, registry, atom)
    assert (one.url, one.title, one.content, one.published_at) == ("https://s.test/1", "By id", "Hello", None)
    assert (two.url, two.title, two.content, two.author) == ("https://s.test/2", "A b", "Sum", "Ann")
    assert two.published_at == 1704063600
    rdf = '<rdf:RDF><channel/><item rdf:about="x"><title>r</title><link>https://s.test/r</link></item></rdf:RDF>'
    assert [r.title for r in parsed(spark, registry, rdf)] == ["r"]


DATES = [
    ("Mon, 01 Apr 2024 10:00:00 GMT", 1711965600),
    ("1 Apr 2024 10:00:00 +0200", 1711958400),
    ("Mon, 01 Apr 24 10:00 EST", 1711983600),
    ("01 Apr 2024 10:00:00 XYZ", None),
    ("01 Apr 2024 10:00:00", 1711965600),
    ("2024-04-01T10:00:00Z", 1711965600),
    ("2024-04-01T10:00:00.250-05:00", 1711983600),
    ("2024-04-01T10:00:00", 1711965600),
    ("2024-04-01", 1711929600),
    ("yesterday", None),
    ("2024-13-45", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DATES)], "i int, d string")
        got = df.orderBy("i").select(epoch_seconds(F.col("d")).alias("e")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(DATES[i][0], r.e) for i, r in enumerate(got)] == DATES


def test_dc_date_and_missing_date(spark, registry):
    got = parsed(
        spark,
        registry,
        RSS.format(
            "<item><link>https://s.test/1</link><dc:date>2024-01-01T00:00:00Z</dc:date></item>"
            "<item><link>https://s.test/2</link></item>"
        ),
    )
    assert [r.published_at for r in got] == [1704067200, None]


def test_broken_payloads_are_refused(spark, registry):
    df = feed(spark, "no xml", "<rss><channel><item><link>x</link>", None, RSS.format(""))
    assert sorted(r.reason for r in feed_rejects(df).collect()) == ["invalid_feed", "invalid_feed", "null_value"]
    assert parse_feeds(df, registry, 0).count() == 0


def test_registry(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown source type: ftp"):
        source_registry(spark, [{"id": "x", "type": "ftp", "url": "u"}])
    row = source_registry(spark, [{"id": "x", "type": "rss", "url": "u"}]).first()
    assert (row.language, row.tags, row.extra) == ("en", [], {})
    pytest.importorskip("yaml")
    path = tmp_path / "sources.yaml"
    path.write_text("sources:\n  - {id: a, type: rss, url: u, language: de, tags: [x]}\n")
    row = read_sources(spark, str(path)).first()
    assert (row.id, row.language, row.tags) == ("a", "de", ["x"])


PAGES = [
    ("<title>Harbour log</title><p>skip me</p><article><h2>no</h2><p>Two ships left.</p> <p>One came.</p></article>",
     "Harbour log", "Two ships left. One came."),
    ("<head><title>Tides</title></head><p>High at noon</p>", "Tides", "High at noon"),
    ("<body><section><p>Calm sea</p></section></body>", None, "Calm sea"),
    ("<html></html>", None, None),
    ("", None, None),
    ("<p>a <i>slow</i> boat <a href='u'>home</a></p>", None, "a slow boat home"),
    ("<p>open<p>next</p>", None, "open next"),
    ("<p>open<div>block</div><p>next", None, "open next"),
    ('<article><p>a<script>"</p>x"</script>b</p></article>', None, "a b"),
    ("<title>R&amp;D</title><!-- <p>hidden</p> --><P CLASS=x>Caps</P>", "R&D", "Caps"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _, _) in enumerate(PAGES)], "i int, html string")
    got = extract_pages(df).orderBy("i").collect()
    assert [(PAGES[r.i][0], r.title, r.content) for r in got] == PAGES


def test_page_items_flow_into_normalize(spark):
    df = spark.createDataFrame([("s", " u ", PAGES[0][0], "en", ["B", "a"])],
                               "source_id string, url string, html string, language string, tags array<string>")
    (got,) = normalize_items(page_items(df, fetched_at=3)).collect()
    assert (got.url, got.title, got.tags, got.fetched_at) == ("u", "Harbour log", ["a", "b"], 3)


def test_read_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a":1}\nbad\n')
    assert sorted(r.value for r in read_records(spark, str(tmp_path)).collect()) == ["bad", '{"a":1}']
