import pytest
from pyspark.sql import functions as F

from recordloom.functions import canonical, text, urls


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_strict_url(spark):
    got = one(spark, urls.normalize_url, " https://User@EXAMPLE.test:443/Request/1/#top", "http://a.test", "http://a.test//", "ftp://a.test/x", "nonsense", None, "https://a.test/x?q=1&b")
    assert got == ["https://example.test:443/Request/1", "http://a.test/", "http://a.test", None, None, None, "https://a.test/x?q=1&b"]


def test_strict_url_aborts(spark):
    with pytest.raises(Exception, match="invalid public URL"):
        one(spark, urls.require_urls, "mailto:x")


def test_discovery_url(spark):
    got = one(spark, lambda c: urls.discovery_url(c, exact=True), "HTTPS://u@A.test/x/;p?fbclid=1&b=a%20b&utm_source=f&c#z", "http://a.test", "x", None)
    assert got == ["https://u@a.test/x?b=a+b&utm_source=f&c=", "http://a.test/", "", None] or got[:3] == ["https://u@a.test/x?b=a+b&utm_source=f&c=", "http://a.test/", ""]


def test_request_pages(spark):
    assert one(spark, urls.is_request_page, "https://a/request/one", "https://a/request/one.json", "https://a/request/one/two", "https://a/body/x") == [True, False, False, False]
    assert one(spark, urls.request_slug, "https://a/request/one", "https://a/request/one.json", "https://a/request/one/two", "https://a/x") == ["one", "one", "", ""]


def test_scope(spark):
    df = spark.createDataFrame([("a/b", "a/*"), ("a/b", "a/b"), ("a/b", "a")], "u string, s string")
    assert [r[0] for r in df.select(urls.in_scope(F.col("u"), F.col("s"))).collect()] == [True, True, False]


def test_state(spark):
    got = one(spark, text.normalize_state, "Partially successful", "It was  partially successful!", "They refused", "response is long overdue", "waiting clarification", "?", None)
    assert got == ["partially_successful", "partially_successful", "rejected", "waiting_response", "waiting_clarification", "", ""]


def test_clean_and_tags(spark):
    assert one(spark, text.clean_text, " a&amp;b \n c ", None) == ["a&b c", ""]
    assert one(spark, text.clean_text, "a  b&nbsp;", "\u2003x\u00a0\u3000y\x1f") == ["a b", "x y"]
    assert one(spark, text.normalize_state, "Partially&nbsp;successful", "not\u00a0held") == ["partially_successful", "not_held"]
    assert one(spark, text.body_tag, "NSW_State--Body ") == ["nsw state body"]
    assert one(spark, lambda c: text.safe_relative_path(c), "a/b", "/a", "a/../b", "a//b", "a\\b", "") == [True, False, False, False, False, False]
    assert one(spark, text.language_of, "en_NZ", "fr") == ["en", "fr"]


def test_page_fields():
    page = """<html><head><title>t</title><meta name="datePublished" content="2020-01-01"></head><body><nav><a href="/body/list">All</a></nav>
    <h1>Ask <b>this</b></h1><div class="request-header"><p class="subtitle">X made this Freedom of Information request to <a class="public-body" href="/body/min%20x">Min</a></p></div>
    <script>hidden()</script><p class="request-status">Currently waiting for a response</p><time class="updated" datetime="2021-02-03">x</time></body></html>"""
    title, name, slug, subtitle, state, first, last, visible = text.page_fields(page)
    assert (title, name, slug, state, first, last) == ("Ask this", "Min", "min x", "Currently waiting for a response", "2020-01-01", "2021-02-03")
    assert subtitle.startswith("X made this Freedom") and "hidden" not in visible
    assert text.page_fields(None)[0] == "" and text.page_fields("status: rejected <p")[4] == "rejected"


def test_canonical():
    assert canonical.content_digest({"b": 1, "a": "é"}, "package") == canonical.content_digest({"a": "é", "b": 1}, "diff")
    assert canonical.canonical_bytes({"a": "é"}, "manifest") == b'{"a":"\\u00e9"}'
    with pytest.raises(ValueError):
        canonical.canonical_bytes(float("nan"))
    for bad in ('{"a":1,"a":2}', '{"a":NaN}', "[1e999]"):
        with pytest.raises(ValueError):
            canonical.strict_json(bad)
    state = {"next_id": 5, "batches": []}
    import json

    assert canonical.decode_state(json.dumps(canonical.encode_state(state))) == state == canonical.decode_state(json.dumps(state))
    with pytest.raises(ValueError):
        canonical.decode_state("[]")


# Each page with its title, authority, slug, state and visible text.
PAGES = [
    (None, ("", "", "", "", "")),
    ("", ("", "", "", "", "")),
    ("   \n ", ("", "", "", "", "")),
    ("plain words", ("", "", "", "", "plain words")),
    ("<h1></h1><title>t</title>", ("t", "", "", "", "t")),
    ("<h1> </h1><h1>Second</h1><title>t</title>", ("Second", "", "", "", "Second t")),
    ("<h1>Open <b>bold<i>er</h1> after", ("Open bold er", "", "", "", "Open bold er after")),
    ("<h1>Never closed <p>para", ("Never closed para", "", "", "", "Never closed para")),
    ("<meta property='og:title' content=' Shared  title '><title>t</title>", ("Shared title", "", "", "", "t")),
    ("<title>a &amp; b &lt;c&gt;</title>", ("a & b <c>", "", "", "", "a & b <c>")),
    ("<a href='/body/list'>All</a><a href='/body/all'>x</a><a href='/body/one'>One</a>", ("", "One", "one", "", "All x One")),
    ("<a href='/body/one'>One</a><a class='public-body' href='/body/two'>Two</a>", ("", "Two", "two", "", "One Two")),
    ("<a href='/body/a%20b?x#y'>A</a>", ("", "A", "a b", "", "A")),
    ("<a href='/body/one'></a><span class='request-authority'>Named</span>", ("", "Named", "", "", "Named")),
    ("<div class='status'>closed</div><div class='request-status'>waiting</div>", ("", "", "", "waiting", "closed waiting")),
    ("<p>Status: Partially successful, since May</p>", ("", "", "", "Partially successful", "Status: Partially successful, since May")),
    ("<script>if (a < b) status: open</script><style>p{}</style>seen", ("", "", "", "", "seen")),
    ("<noscript>state: gone</noscript><template>x</template>a", ("", "", "", "", "a")),
    ("<ul><li>one<li>two<li>three</ul>", ("", "", "", "", "one two three")),
    ("a<br>b<hr/>c<img src=x>d", ("", "", "", "", "a b c d")),
    ("</h1></div>stray ends", ("", "", "", "", "stray ends")),
    ("<h1 class='status'>Both</h1>", ("Both", "", "", "Both", "Both")),
    ("<!-- <h1>no</h1> --><h1>yes</h1><![CDATA[x]]>", ("yes", "", "", "", "yes")),
    ("<H1>Upper</H1><P CLASS='Status'>x", ("Upper", "", "", "", "Upper x")),
    ("<h1>" + "<b>" * 3000 + "deep", ("deep", "", "", "", "deep")),
]


@pytest.mark.parametrize("case", range(len(PAGES)))
def test_page_fields_of_odd_markup(case):
    markup, want = PAGES[case]
    title, name, slug, _, state, _, _, visible = text.page_fields(markup)
    assert (title, name, slug, state, visible) == want
    assert text.shown_text(markup) == visible


def test_page_columns_agree(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(PAGES)], "i int, html string")
    rows = df.select("i", text.html_fields("html").alias("f"), text.visible_text("html").alias("v")).collect()
    assert all(r.f.visible_text == r.v == PAGES[r.i][1][4] for r in rows)
