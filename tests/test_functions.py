import base64
import dataclasses
import unicodedata
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.functions import html, text, url

URLS = ["http://WWW.Example.com:8080/a/b/?x=1#f", "https://user:pw@shop.example/go/Ab3dE?pid=a%20b", "//cdn.example/x.css", "nonsense", "", "http://example.org?u=https://x.example", "https://пример.example/путь", "http://a b.example/?q=[1]", "http://[", "#top", "https://example.net./2024/05/a-b-c-d-e/"]


def col(spark, values, expr, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr(F.col("v"))).collect()]


def test_hosts(spark):
    assert col(spark, URLS, url.url_host) == ["example.com", "shop.example", "cdn.example", "", "", "example.org", "пример.example", "a b.example", "[", "", "example.net."]
    assert col(spark, URLS[:2], url.loc_host) == ["example.com:8080", "user:pw@shop.example"]
    assert col(spark, ["WWW.A.example..", "a"], url.base_host) == ["a.example", "a"]
    for u, h in zip(URLS[:4], col(spark, URLS[:4], url.url_host), strict=True):
        assert (urlsplit(u).hostname or "").removeprefix("www.") == h


def test_same_site(spark):
    pairs = [("a.example", "a.example", True), ("b.a.example", "a.example", True), ("a.example", "b.a.example", True), ("xa.example", "a.example", False), ("", "a", False), ("", "", False)]
    got = spark.createDataFrame(pairs, "a string, b string, e boolean").select("e", url.same_site(F.col("a"), F.col("b"))).collect()
    assert all(e == g for e, g in got)


def test_keys_and_params(spark):
    assert col(spark, URLS[:2], url.ref_key) == ["www.example.com/a/b", "shop.example/go/Ab3dE"]
    assert col(spark, ["http://a.example", "http://a.example//"], url.ref_key) == ["a.example/", "a.example/"]
    assert col(spark, URLS[:2], url.partner_id) == ["", "a b"]
    assert col(spark, URLS[:2], url.has_affiliate_params) == [False, True]
    assert col(spark, ["http://x.example/Ab3dE", "http://x.example/Title", "http://x.example/abcde", "http://x.example/aB"], url.tracker_shaped) == [True, False, False, False]
    assert col(spark, ["http://in.example/x", "http://o.example/Ab3dE?x=1", "http://o.example/p?x=1#f"], lambda u: url.cache_key(u, F.lit("in.example"))) == ["", "o.example/Ab3dE", "http://o.example/p?x=1"]
    assert col(spark, ["https://redirect.example/?url=http%3A%2F%2Fa.example%2F", "http://b.example/?url=x"], lambda u: url.unwrap(u, r"^redirect\.")) == ["http://a.example/", "http://b.example/?url=x"]
    assert col(spark, ["x1y.example", "bcdfg.example", "banana.example", "example", "localhost9", "bcdfg", "go.acme.com"], url.random_host) == [True, True, False, False, True, True, True]
    assert col(spark, ["a.kz", "b.example"], url.tld_country) == ["KZ", None]


def test_shapes_and_refs(spark):
    got = [r[0].asDict() for r in spark.createDataFrame([(u,) for u in URLS], "v string").select(url.path_shapes(F.col("v"))).collect()]
    assert got[1]["gate"] and got[2]["static"] and got[5]["url_param"] and got[10]["dated"] and got[10]["slug"] and not got[0]["gate"]
    refs = ["http://acme.example/x?pid=1", "http://known.example/", "http://x7q.example/Ab3d", "http://site.example/?aff=1", "http://o.example/page", "ftp://known.example/", "http://x7q.example/News", "http://go.acme.com/Ab3d/0/x"]
    known = dataclasses.replace(DEFAULT, ref_hosts=("known.example",))
    assert col(spark, refs, lambda u: url.classify_ref(u, F.lit("site.example"), known)) == ["brand_host", "known_ref_host", "ref", None, None, None, None, "ref"]


def test_python_functions(spark):
    df = spark.createDataFrame([("http://a.example/x/y", "../z"), ("http://a.example/", None), ("http://[", "x")], "b string, h string")
    assert [r[0] for r in df.select(url.url_join("b", "h")).collect()] == ["http://a.example/z", None, None]
    got = [tuple(r[0]) for r in spark.createDataFrame([("WWW.Пример.example.",), ("",), ("a" * 70 + ".example",)], "v string").select(url.idna_host("v")).collect()]
    assert got[0] == ("пример.example".encode("idna").decode(), "ok") and got[1] == (None, "empty") and got[2][1] == "error"


def test_chains(spark):
    rows = [("http://a.example/?aff=1", "http://b.example/", []), ("http://a.example/", "http://a.example/x", []), ("http://a.example/", "http://c.example/", ["http://t.example/"]), ("http://a.example/?x=1", "http://b.example/", ["http://a.example/?x=1"]), ("http://a.example/", "http://b.example/", None)]
    df = spark.createDataFrame(rows, "u string, f string, h array<string>")
    assert [r[0] for r in df.select(url.tracked(F.col("u"), F.col("f"), F.col("h"))).collect()] == [True, False, True, True, False]
    assert [r[0] for r in df.select(url.via_tracker(F.col("u"), F.col("f"), F.col("h"))).collect()] == [False, False, True, False, False]


def test_text(spark):
    mixed = "Ａcmе ácmé"
    assert col(spark, [mixed], text.fold)[0].lower() == "acme acme"
    assert "".join(c for c in unicodedata.normalize("NFKD", "é") if not unicodedata.combining(c)) == col(spark, ["é"], text.fold)[0]
    assert col(spark, [mixed, None], lambda c: text.disguised_count(c, "(?i)acme")) == [2, 0]
    assert col(spark, ["МоСт мост", None], lambda c: text.count_matches(c, "(?iU)мост")) == [2, 0]
    names = (("One", "(?i)uno|one"), ("Two", "(?i)two"), ("Three", "(?i)three"))
    assert col(spark, ["two one", "x"], lambda c: text.first_in_dictionary(c, names)) == ["One", ""]
    assert col(spark, ["three two one", "three"], lambda c: text.all_in_dictionary(c, names, {"Three": "Tres"}, {"Tres": "Two"})) == [["One", "Two"], ["Tres"]]
    assert col(spark, ["  a \n b  "], text.collapse) == ["a b"]
    hidden = base64.b64encode(b"https://x.example/p").decode().rstrip("=")
    assert col(spark, [f"a='{hidden}'", "aHR0cnonsense!"], text.base64_urls) == [["https://x.example/p"], []]
    assert col(spark, [base64.b64encode(b"/go/1").decode(), "plain-text"], text.base64_path) == ["/go/1", ""]
    assert col(spark, ["a /* b */ c // d\nhttp://x"], text.without_comments) == ["a   c  \nhttp://x"]
    assert col(spark, ["a%20b+c%zz", "a%2Bb"], text.percent_decoded) == ["a%20b+c%zz", "a+b"]
    assert col(spark, ["abc END def STOP", "abc"], lambda c: text.cut_at_first(c, ["STOP", "END"])) == ["abc ", "abc"]
    assert col(spark, ["1.5", "", None, "x"], text.number) == [1.5, 0.0, 0.0, 0.0]
    assert col(spark, [1234567, 12], text.grouped_number, "v long") == ["1 234 567", "12"]
    assert col(spark, ["dns:x", "other"], lambda c: text.explain(c, [("^dns:(.*)$", "no address for $1")])) == ["no address for x", "other"]
    assert col(spark, ["Timeout 30000ms exceeded", "", None, "zzz"], text.error_code) == ["timeout", "", "", "nav_error"]
    for kind in text.DELIMITERS:
        assert col(spark, [["a", "b"], []], lambda c, kind=kind: text.unpack(text.pack(c, kind), kind), "v array<string>") == [["a", "b"], []]


def test_query_language_and_geo(spark):
    lang = lambda c: text.query_language(c, noise=["2024"], brand="acme", scripts=[("cyrillic", "[а-я]")], words=[("es", ["como"]), ("en", ["how", "to"])])
    assert col(spark, ["acme 2024", "acme вход", "como acme", "how to acme", "acme xyz"], lang) == ["none", "cyrillic", "es", "en", "other"]
    geo = lambda c: text.geo_code(c, F.lit("KZ"), [("KZ", "kaz"), ("UZ", "uzb"), ("AZ", "aze")])
    assert col(spark, ["kaz", "kaz uzb", "uzb aze", ""], geo) == ["own", "own+UZ", "AZ+UZ", "none"]


def test_contexts(spark):
    df = spark.createDataFrame([("aa bad X good bad",), (None,)], "v string").withColumn("p", text.match_positions(F.col("v"), "x"))
    got = df.select("p", text.contexts(F.col("v"), F.col("p"), 4, 5), text.near_count(F.col("v"), F.col("p"), "bad", 5)).collect()
    assert got[0][0] == [7] and got[0][1] == ["bad X goo"] and got[0][2] == 1 and got[1][0] == []


PAGE = """<!DOCTYPE html><html lang="en"><head><title> A &amp; B </title><link rel="canonical" href="/c"><link rel="icon" href="/acme.ico"><meta property="og:site_name" content="Acme">
<meta http-equiv="refresh" content="0; url='/next'"><script>var t="</p>";</script><script src="/s.js"></script></head><body><h1>Head</h1><h2>One</h2><h2>Two</h2>
<p>Seen <b>text<p>more<div style="display: none"><a href="/hid">no</a></div><article><a href="http:\\/\\/x.example\\/p">in</a></article><a href="#f">f</a><a href="mailto:a@b">m</a>
<form action="/f"><button formaction="/g">Go</button></form><span data-href="/d"></span><noscript>off</noscript></body></html>"""


def test_html(spark):
    row = html.parse_one(PAGE)
    assert row["title"] == "A & B" and row["h1"] == "Head" and row["h2"] == ["One", "Two"] and row["lang"] == "en" and row["canonical"] == "/c"
    assert "Seen text more" in row["text"] and "off" not in row["text"] and "var t" not in row["text"]
    links = {x["url"]: x for x in row["links"]}
    assert set(links) == {"/next", "/hid", "http://x.example/p", "/f", "/g", "/d"}
    assert links["/hid"]["hidden"] and not links["/f"]["hidden"] and links["http://x.example/p"]["in_post"]
    assert row["names"] == ["/acme.ico", "Acme"] and row["script_urls"] == ["/s.js"] and (row["n_buttons"], row["n_cta"]) == (1, 0)
    got = html.parse_pages(spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>a<b>c")], "page_id long, html string")).orderBy("page_id").collect()
    assert [r.n_links for r in got] == [6, 0, 0] and got[2].text == "a c" and got[1].text == ""
    head = spark.createDataFrame([(PAGE,)], "h string").select(*html.head_fields(F.col("h"))).first()
    assert head.n_h2 == 2 and head.has_h1 and head.lang == "en"


@pytest.mark.parametrize("depth", [11, 12])
def test_hidden_ancestors(depth):
    inner = "<div hidden>" + "<div>" * (depth - 1) + "<a href='/x'>x</a>"
    assert html.parse_one(inner)["links"][0]["hidden"] == (depth <= 11)


def test_captured_markup(spark):
    page = '<link rel="alternate" hreflang="EN" href="http://a.example/"><script>window.location.href = "https://b.example/x";</script>'
    got = spark.createDataFrame([(page, "short")], "h string, t string").select(html.hreflangs(F.col("h")), html.script_redirect(F.col("h"), F.col("t"))).first()
    assert [tuple(x) for x in got[0]] == [("en", "http://a.example/")] and got[1] == "https://b.example/x"
    maps = col(spark, ["<loc> http://a.example/m.xml </loc><loc>http://a.example/p%20q</loc>"], html.sitemap_locations)
    assert [tuple(x) for x in maps[0]] == [("http://a.example/m.xml", True), ("http://a.example/p q", False)]


def test_scripted_links():
    hidden = base64.b64encode(b"https://h.example/p").decode().rstrip("=")
    page = f"""<a onclick="window.open('/o')">x</a><i data-x="https://d.example/" data-y="{hidden}" data-z="plain"></i><script>location.href = "/s"; var q = "{hidden}";</script>"""
    assert [(x["url"], x["source"]) for x in html.parse_one(page)["links"]] == [("/o", "onclick"), ("https://d.example/", "data-x"), ("https://h.example/p", "data-y:b64"), ("/s", "script_nav")]
    page = "<i onclick='window.open (`/b`)'></i><i data-target-url='/t'></i><script>location . href</script>"
    assert [(x["url"], x["source"]) for x in html.parse_one(page, "https://s.example/x")["links"]] == [("https://s.example/b", "onclick"), ("https://s.example/t", "data-target-url")]


@pytest.mark.parametrize("style", ["display : none", "visibility:hidden", "opacity:0", "opacity: 0.0", "text-indent:-999px", "left: -200px", "top:-9999em", "font-size:1px", "font-size: 0", "height:2px; overflow:hidden", "overflow:hidden;width:0px", "clip: rect(0 0 0 0)", "DISPLAY:NONE !important"])
def test_hiding_styles(style):
    assert html.style_hides(style)
    assert html.parse_one(f'<div style="{style}"><a href="/x">x</a></div>')["links"][0]["hidden"]


@pytest.mark.parametrize("style", ["", "display:block", "opacity:0.5", "left:-20px", "font-size:12px", "height:2px", "overflow:hidden", "margin-left:-1px", "colour"])
def test_styles_that_hide_nothing(style):
    assert not html.style_hides(style)


@pytest.mark.parametrize(("block", "inside"), [('<div class="post">', True), ('<li class="big-News">', True), ("<article>", True), ('<section class="story x">', True), ('<span class="post">', False), ('<div class="menu">', False), ("<div>" * 9, False)])
def test_posts(block, inside):
    assert html.parse_one(f'{block}<a href="/x">x</a>')["links"][0]["in_post"] is inside


def test_repeated_links_are_counted_and_listed_once(spark):
    page = '<a href="https://trail.example/Zx9k">a</a><a href="https://trail.example/Zx9k">b</a><a href="https://o.example/Zx9k">c</a>'
    df = spark.createDataFrame([("https://s.example/", page)], "url string, html string")
    got = html.page_features(html.parse_pages(df, "html", "url")).select("n_links", "links_ext", "ext_hosts", "trackers", html.distinct_links(F.col("links")).alias("d")).first()
    assert (got.n_links, got.links_ext, got.ext_hosts, got.trackers) == (2, 3, 2, ["https://trail.example/Zx9k"]) and len(got.d) == 2


def test_folded_letters_count(spark):
    df = spark.createDataFrame([("https://s.example/", "<p>асmе and Ácme, Асmе</p>")], "url string, html string")
    assert html.page_features(html.parse_pages(df)).first().mentions == 2
    assert col(spark, ["вот Асmе", None, "ΑCΜΕ"], lambda c: text.fold(c, wide=True)) == ["bot Acme", None, "ACME"]
    assert col(spark, ["вот", "ѐ"], text.fold) == ["вoт", "e"]


def test_plain_markup_is_read_as_the_library_reads_it(monkeypatch):
    import random

    bits = (
        '<div class="post">', "</div>", "<p style='display:none'>", '<a href="/q?a=1&amp;b=2">x', "</a>", "<a href=/u>", "<a  href = '/y' >", "<br/>", "<script>if (a<b) location.href='/n'", "</script >", "<style>a<b", "</STYLE>", "<!-- a -- >", "<!--", "<!doctype html>",
        "<![CDATA[x]]>", "&lt", " & ", "<", "</", "text ", "<title>", "</title>", "<nav>", "</nav>", "<li><td><tr>", "<h1>x", "<button disabled>Join", "<x-y z>", "<a:b>", "<svg/>", "\x00", '<i data-href="/d" hidden>', "<time datetime='2020'>", '<meta name="date" content="&quot;">',
    )
    r = random.Random(4)
    for _ in range(1500):
        markup = "".join(r.choice(bits) for _ in range(r.randrange(1, 10)))
        page = html.Page("https://s.example/")
        try:
            page.feed(markup)
            page.close()
        except (AssertionError, ValueError):
            pass
        assert html.parse_one(markup, "https://s.example/") == page.row(), markup
    plain = '<!DOCTYPE html><html lang="en"><title>T &amp; t</title><script>var a = 1 < 2;</script><p class=\'x\'>one<br/><a href="/x">l</a></p><!-- c --></html>'
    monkeypatch.setattr(html.Page, "feed", lambda *_: pytest.fail("plain markup needs no second parser"))
    assert html.parse_one(plain)["text"] == "one l"


def test_parts_of_links_are_those_of_the_columns(spark):
    import random

    r = random.Random(3)
    pieces = ["https://", "HTTP:", "//", "www.", "WWW.", "a.example", "Ünï.Example", "İ.example", ".", "..", ":80", ":", ":8\n", "u@", "@", "/", "/go/", "/GO/x", "/2021/05/p", "/a-b-c-d-e", "/Ab3d", "?", "q=1&b", "#", "#f", "\n", "\r\n", " ", "\u0085", " ", "К", "K", "x", "9", "/Я-б-в-г"]
    urls = sorted({"".join(r.choice(pieces) for _ in range(r.randrange(7))) for _ in range(6000)})
    u = F.col("v")
    p, h = url.path(u), url.hostname(u)
    shape = [p.rlike(url.SHAPES[name]) for name in ("gate", "dated", "slug")]
    coded = p.rlike(url.TOKEN_PATH) & p.rlike(url.TOKEN_MARK)
    found = spark.createDataFrame([(x,) for x in urls], "v string").select("v", h, url.base_host(h), p, url.query(u), u.rlike(r"(?i)^(https?:)?//|^/|^[^:]*$"), *shape, coded).collect()
    assert [(x[0], *x[1:]) for x in found] == [(x[0], *url.link_parts(x[0]).values()) for x in found]


def test_known_tags_give_what_the_parser_of_the_library_gives():
    import random

    memo, base = {}, "https://s.example/"
    pieces = ["<p>", "</p>", "<a href='/x'>", "<a href='/x?a>b'>", "</a>", "<div hidden>", "<div class='post'>", "</div>", "<!-- <script> -->", "<!-- a > b -->", "<script>var u='<p>';</script>", "<SCRIPT src='x>y'></script>", "<style>a<b</style>", "<br/>", "w", "&amp;", "<button>Play", "</button>", "<title>t", "</title>", "<h1>", "</h1>", "< b", "<![x]>"]
    r = random.Random(4)
    for _ in range(3000):
        markup = "".join(r.choice(pieces) for _ in range(r.randrange(1, 15)))
        page = html.Page(base)
        try:
            page.feed(markup)
            page.close()
        except (AssertionError, ValueError):
            continue
        assert html.parse_one(markup, base, memo) == page.row(), markup


def test_attributes_of_a_tag_are_read_once_for_all_pages(monkeypatch):
    class Counting:
        def __init__(self, pattern):
            self.pattern, self.calls = pattern, 0

        def findall(self, text):
            self.calls += 1
            return self.pattern.findall(text)

    counted, memo = Counting(html.ATTRIBUTE), {}
    monkeypatch.setattr(html, "ATTRIBUTE", counted)
    for k in range(50):
        row = html.parse_one(f'<p class="a">{k}</p><a href="/x">l{k}</a><a href="/x">m</a>', "https://s.example/", memo)
        assert [(x["url"], x["text"], x["times"], x["path"]) for x in row["links"]] == [("https://s.example/x", f"l{k}", 2, "/x"), ("https://s.example/x", "m", 0, "/x")]
    assert counted.calls == 2
