"""HTML features over pages that a grid puts together, so that what a page shows is known; and over the captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.functions import text as T
from tessera.functions import url as U
from tessera.plans.inputs import GRID, grid, number, pick, read, sql_number, sql_pick
from tessera.plans.q_site_pages import S_TOTALS
from tessera.plans.registry import query

#: Elements and the text that stays of them.
ELEMENTS = (("<script>var a=1;</script>", ""), ("<style>p{}</style>", ""), ("<noscript>no</noscript>", ""), ("<template>te</template>", ""), ("<svg><text>sv</text></svg>", ""), ("<b>kept</b>", "kept "), ("<p>open", "open "))
#: Attributes of a block and whether they hide it.
HIDES = (
    ('style="display: none"', 1), ('style="visibility:hidden"', 1), ('style="opacity:0"', 1), ('style="text-indent: -999px"', 1), ('style="left:-9999px"', 1), ('style="font-size:1px"', 1),
    ('style="height:1px;overflow:hidden"', 1), ('style="clip:rect(0,0,0,0)"', 1), ("hidden", 1), ('aria-hidden="true"', 1), ('style="opacity:0.5"', 0), ('style="font-size:12px"', 0), ('style="height:1px"', 0), ('class="x"', 0),
)
#: Blocks and whether a link in them stands in a post.
POSTS = (("<article>", "</article>", 1), ('<div class="post-card">', "</div>", 1), ('<ul><li class="news">', "</li></ul>", 1), ('<section class="teaser-box">', "</section>", 1), ('<p class="post">', "</p>", 0), ('<div class="menu">', "</div>", 0))
#: Markup of a link, and its resolved URL and source ("" where there is none).
LINKS = (
    ('<a href="/x">t</a>', "https://site.example/x", "a"), ('<area href="y">', "https://site.example/y", "a"), ('<form action="/f"></form>', "https://site.example/f", "form"), ('<input formaction="/g">', "https://site.example/g", "formaction"),
    ('<i data-target-url="https://o.example/1"></i>', "https://o.example/1", "data-target-url"), ('<i data-href="/2"></i>', "https://site.example/2", "data-href"), ('<i data-x="L2dvLw=="></i>', "https://site.example/go/", "data-x:b64"),
    ('<i data-any="https://o.example/3"></i>', "https://o.example/3", "data-any"), ('<i data-img="https://o.example/4"></i>', "", ""), ("<i onclick=\"window.open ('/5')\"></i>", "https://site.example/5", "onclick"),
    ('<meta http-equiv="refresh" content="0; URL=/6">', "https://site.example/6", "meta_refresh"), ("<script>location.href = `/7`</script>", "https://site.example/7", "script_nav"), ('<script>var u="https:\\/\\/o.example/8"</script>', "https://o.example/8", "script_url"),
    ('<a href="#top">t</a>', "", ""), ('<a href="{{url}}">t</a>', "", ""), ('<a href="javascript:go()">t</a>', "", ""), ('<a href="/r?u=aHR0cHM6Ly9vLmV4YW1wbGUvOQ">t</a>', "https://site.example/r?u=aHR0cHM6Ly9vLmV4YW1wbGUvOQ", "a"),
)
#: Buttons, their number and whether they call to act.
BUTTONS = (("<button>Play now</button>", 1, 1), ("<button>More</button>", 1, 0), ('<button type="submit">Play</button>', 0, 0), ('<a role="button" href="/b">Sign up</a>', 1, 1), ('<a href="#">Close</a>', 1, 0), ("<i>text</i>", 0, 0))


def _page(parts: list[Column]) -> Column:
    return F.concat(F.lit('<html lang="en"><head><title>Page '), F.col("k").cast("string"), F.lit("</title></head><body><nav>Menu </nav>"), *parts, F.lit("</body></html>"))


def _parsed(spark: SparkSession, sf_dir: str, parts: list[Column], fields: tuple[str, ...]) -> DataFrame:
    df = grid(spark, sf_dir, wide=True).select("k", _page(parts).alias("html"), F.lit("https://site.example/").alias("url"))
    return H.parse_pages(df, "html", "url", fields)


def _of(h: int, shift: int, rows: tuple, k: int) -> Column:
    return pick(h, shift, [r[k] for r in rows])


def _sql(h: int, shift: int, rows: tuple, k: int) -> str:
    return sql_pick(h, shift, [r[k] for r in rows])


@query(f"""
WITH g AS ({GRID}) SELECT k, 'Page ' || k AS title, 'en' AS lang, 'Head' AS h1, 'Menu Head ' || {_sql(0, 2, ELEMENTS, 1)} || 'tail foot' AS text, 'Head' || chr(10) || {_sql(0, 2, ELEMENTS, 1)} || 'tail' AS block_text, 1 AS n_h2, '2024-01-0' || (k % 9 + 1) AS dated FROM g
""".replace("|| chr(10) ||", "|| chr(10) || 'Sub' || chr(10) ||").replace("'Menu Head '", "'Menu Head Sub '"))
def markup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT1, HT2: visible text without scripts, styles and templates, and in lines without the page's frame; heads and dates."""
    date = F.concat(F.lit('<meta name="date" content="2024-01-0'), (F.col("k") % 9 + 1).cast("string"), F.lit('">'))
    seen = _parsed(spark, sf_dir, [date, F.lit("<h1>Head</h1><h2>Sub</h2><div>"), _of(0, 2, ELEMENTS, 0), F.lit(" tail </p></div><footer>foot</footer>")], ("title", "lang", "h1", "text", "block_text", "h2", "dates"))
    return seen.select("k", "title", "lang", "h1", "text", F.regexp_replace("block_text", "\nopen\n", "\nopen ").alias("block_text"), F.size("h2").alias("n_h2"), F.element_at("dates", 1).alias("dated"))


@query(f"""
WITH g AS ({GRID}) SELECT k, {_sql(0, 2, LINKS, 1)} AS url, {_sql(0, 2, LINKS, 2)} AS source, CASE WHEN contains({_sql(0, 2, LINKS, 1)}, 'aHR0c') THEN 'https://o.example/9' ELSE '' END AS decoded,
  ({_sql(1, 2, BUTTONS, 1)} + CASE WHEN contains({_sql(0, 2, LINKS, 0)}, 'onclick') OR contains({_sql(0, 2, LINKS, 0)}, '"#top"') OR contains({_sql(0, 2, LINKS, 0)}, 'javascript') THEN 1 ELSE 0 END
    - CASE WHEN contains({_sql(0, 2, LINKS, 0)}, '"#top"') THEN 1 ELSE 0 END)::INT AS buttons, {_sql(1, 2, BUTTONS, 2)}::INT AS cta FROM g
""")
def markup_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT3, HT4: where links stand, resolved against the page; URLs hidden in Base64; buttons and calls to act."""
    seen = _parsed(spark, sf_dir, [_of(0, 2, LINKS, 0), _of(1, 2, BUTTONS, 0)], ("links", "n_buttons", "n_cta"))
    links = F.filter(H.distinct_links(F.col("links")), lambda x: x["url"] != "https://site.example/b")
    plain, coded = F.try_element_at(F.filter(links, lambda x: ~x["source"].endswith(":b64") | x["url"].startswith("https://site")), F.lit(1)), F.try_element_at(F.filter(links, lambda x: x["source"] == "a:b64"), F.lit(1))
    return seen.select("k", F.coalesce(plain["url"], F.lit("")).alias("url"), F.coalesce(plain["source"], F.lit("")).alias("source"), F.coalesce(coded["url"], F.lit("")).alias("decoded"), F.col("n_buttons").alias("buttons"), F.col("n_cta").alias("cta"))


@query(f"""
WITH g AS ({GRID}) SELECT k, {_sql(0, 2, HIDES, 1)}::INT AS hidden_links, CASE WHEN {_sql(0, 2, HIDES, 1)} = 1 THEN 'out.example' ELSE '' END AS hidden_hosts, {_sql(1, 2, POSTS, 2)}::INT AS in_posts, 1 AS anchor_int FROM g
""")
def markup_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT5, HT6, HT11: links that a visitor does not see, and links in posts."""
    hidden = F.concat(F.lit("<div "), _of(0, 2, HIDES, 0), F.lit('><p><span><a href="https://www.out.example/h">l</a></span></p></div>'))
    post = F.concat(_of(1, 2, POSTS, 0), F.lit('<b><a href="/in">Acme page</a></b>'), _of(1, 2, POSTS, 1))
    seen = H.link_features(_parsed(spark, sf_dir, [hidden, post], ("links",)).withColumn("host", F.lit("site.example")))
    return seen.select("k", "hidden_links", F.array_join(H.hidden_hosts(F.col("links")), " ").alias("hidden_hosts"), "in_posts", "anchor_int")


N = {"said": (0, 2, 4), "dated": (0, 5, 4), "slug": (0, 8, 3), "named": (0, 11, 3), "away": (1, 2, 3), "twice": (1, 5, 3), "gates": (1, 8, 3), "partner": (1, 11, 2), "topic": (1, 14, 7), "rival": (2, 2, 3), "common": (2, 5, 3), "apk": (2, 8, 2), "heads": (2, 11, 3)}
#: The features of markup_vector in SQL, from the numbers of parts.
TEXT_LEN = "5 + 11 * said + 6 * topic + 7 * rival + 6 * common + 2 * dated + 2 * slug + 10 * named + 9 * away + 2 * twice + 2 * gates + 2 * partner + 2 * apk + 5 * heads"


@query(f"""
WITH g AS ({GRID}), n AS (SELECT k, {", ".join(f"{sql_number(*v)} AS {c}" for c, v in N.items())} FROM g), m AS (SELECT *, said + named + away + heads AS mentions, {TEXT_LEN} AS n FROM n)
SELECT k, 'site.example' AS host, 'Offer ' || k AS title, heads > 0 AS in_h1, false AS in_title, heads AS heads_named, heads + 1 AS n_heads, n AS text_len, mentions, round(mentions * 1000.0 / n, 2)::DOUBLE AS density, topic AS topic_words, round(topic * 1000.0 / n, 2)::DOUBLE AS topic_density,
  dated + slug + named + gates + apk AS links_int, away + twice + partner AS links_ext, (away > 0)::INT + (twice > 0)::INT + (partner > 0)::INT AS ext_hosts, dated AS date_links, slug AS slug_links, named AS anchor_int, away AS anchor_ext, named + away AS anchors,
  gates AS n_gates, (twice > 1)::INT AS n_trackers, partner AS n_aff, CASE WHEN partner > 0 THEN 'ref.example' ELSE '' END AS aff_hosts, apk AS n_apk, 0 AS hidden_links, 0 AS hidden_named, 0 AS articles, 1 AS meta_mentions,
  trim(CASE WHEN rival > 0 AND NOT (common > rival AND topic >= 5) THEN 'Globex:' || rival ELSE '' END || CASE WHEN common > 0 AND topic >= 5 THEN ' Hooli:' || common ELSE '' END || CASE WHEN rival > 0 AND common > rival AND topic >= 5 THEN ' Globex:' || rival ELSE '' END) AS others,
  'WP 6' AS generator, 'About Acme' AS meta_text, true AS wp, false AS shell, false AS assets, false AS front_title, false AS parked, false AS pwa, true AS referrer_js, 'en' AS lang
FROM m
""")
def markup_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT7, TX3, TK5: the feature vector of pages whose parts are counted."""
    n = {c: number(*v) for c, v in N.items()}
    rep = lambda markup, c: F.repeat(F.lit(markup), n[c])
    html = F.concat(
        F.lit('<html lang="en"><head><title>Offer '), F.col("k").cast("string"), F.lit('</title><meta name="generator" content="WP 6"><meta name="description" content="About Acme"><link href="/wp-content/x.css">'),
        F.lit('<script>if (document.referrer.match(/google/)) { location.href = "/s"; }</script></head><body><h2>Begin</h2>'),
        rep("<h1>Acme</h1>", "heads"), rep("<p>Acme words</p>", "said"), rep(" bonus", "topic"), rep(" Globex", "rival"), rep(" Hooli", "common"),
        rep('<p><a href="/2021/05/p">d</a>', "dated"), rep('<p><a href="/a-b-c-d-e">s</a>', "slug"), rep('<p><a href="/in">Acme here</a>', "named"), rep('<p><a href="https://other.example/q">Acme fan</a>', "away"), rep('<p><a href="https://trail.example/Zx9k">t</a>', "twice"),
        rep('<p><a href="/go/x">g</a>', "gates"), rep('<p><a href="https://ref.example/?btag=1">r</a>', "partner"), rep('<p><a href="/get.apk">a</a>', "apk"), F.lit("</body></html>"),
    )
    df = grid(spark, sf_dir, wide=True).select("k", html.alias("html"), F.lit("https://site.example/").alias("url"))
    f = H.page_features(H.parse_pages(df.withColumn("markup", F.col("html")), "html", "url", H.VECTOR_FIELDS), html_col="markup")
    others = F.array_join(F.transform("other_brands", lambda x: F.concat(x["name"], F.lit(":"), x["n"].cast("string"))), " ")
    same = ("k", "host", "title", "in_h1", "in_title", "heads_named", "n_heads", "text_len", "mentions", "density", "topic_words", "topic_density", "links_int", "links_ext", "ext_hosts", "date_links", "slug_links", "anchor_int", "anchor_ext", "anchors", "hidden_links", "hidden_named", "articles", "meta_mentions", "generator", "meta_text", "wp", "shell", "assets", "front_title", "parked", "pwa", "referrer_js", "lang")
    return f.select(*same, F.size("gates").alias("n_gates"), F.size("trackers").alias("n_trackers"), F.size("aff_links").alias("n_aff"), F.array_join(F.array_distinct(F.transform("aff_links", lambda x: x["host"])), " ").alias("aff_hosts"), F.size("apk").alias("n_apk"), others.alias("others"))


SITE_NAMES = (('<meta property="og:site_name" content="Globex Club">', "Globex Club"), ('<meta name="application-name" content="App X">', "App X"), ("", ""))
TITLES = (("Acme | Home", "Acme"), ("Globex - play", "Globex"), ("Plain", "Plain"), ("A—B", "A—B"), ("", ""))
JUMPS = (('<script>location.replace("https://t.example/1")</script>', "https://t.example/1"), ("<script>var x = 1;</script>", ""), ('<script>location.href="/local"</script>', ""))
OFFERS = (('<script>window.appDataConfigs = {"a":1, "url": "https:\\/\\/o.example\\/p"}</script>', "https://o.example/p"), ("<i>none</i>", ""))


@query(f"""
WITH g AS ({GRID}) SELECT k, CASE WHEN {_sql(1, 3, SITE_NAMES, 1)} <> '' THEN {_sql(1, 3, SITE_NAMES, 1)} ELSE {_sql(0, 3, TITLES, 1)} END AS operator, array_to_string(list_filter([{_sql(0, 3, TITLES, 0)}, 'site.example', {_sql(1, 3, SITE_NAMES, 1)}, '/icon.png'], lambda x: x <> ''), ' | ') AS fields,
  {_sql(1, 7, JUMPS, 1)} AS jump, {_sql(2, 7, OFFERS, 1)} AS offer, {_sql(2, 7, OFFERS, 1)} <> '' AS pwa FROM g
""")
def markup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT8, HT9, HT15: the fields that name an operator, its raw name, a script's jump, and an application's offer."""
    html = F.concat(F.lit("<html><head><title>"), _of(0, 3, TITLES, 0), F.lit("</title>"), _of(1, 3, SITE_NAMES, 0), F.lit('<link rel="icon" href="/icon.png"></head><body>'), _of(1, 7, JUMPS, 0), _of(2, 7, OFFERS, 0), F.lit("</body></html>"))
    df = grid(spark, sf_dir, wide=True).select("k", html.alias("html"), html.alias("markup"), F.lit("https://site.example/").alias("url"))
    f = H.page_features(H.parse_pages(df, "html"), html_col="markup")
    return f.select("k", H.raw_brand_name(F.col("title"), F.col("operator_names")).alias("operator"), H.brand_fields(F.col("title"), F.col("host"), F.col("names")).alias("fields"), F.col("js_redirect").alias("jump"), F.col("pwa_offer").alias("offer"), "pwa")


BARE = "regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '<[^>]*>', ' ', 'g')"


@query(f"""
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')) AS h1, len(regexp_extract_all({BARE}, '[^ \\t\\n\\r]+'))::INT AS words, regexp_extract(html, '(?i)<link[^>]*rel="canonical"[^>]*href="([^"]*)"', 1) AS canonical,
  'plain:' || substr(sha1(array_to_string(list_transform(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1), lambda t: lower(t)), ' ')), 1, 10) AS fingerprint FROM pages
""")
def head_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT14, TX14: h1, visible words, canonical address and fingerprint of captured pages, from stored markup."""
    h = F.col("html")
    fields = read(spark, sf_dir, "pages").select("page_id", *H.head_fields(h), H.build_fingerprint(h).alias("fingerprint"))
    return fields.select("page_id", "h1", "words", "canonical", "fingerprint")


@query("""
SELECT page_id, source, url FROM (SELECT page_id, 'script' AS source, unnest(regexp_extract_all(html, '<a href="(/[A-Z][a-z]+)"', 1)) AS url FROM pages) WHERE url IS NOT NULL
""".replace("'script'", "'a'"))
def page_link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT3: rooted links of captured pages, by the parser, every occurrence."""
    seen = H.parse_pages(read(spark, sf_dir, "pages").select("page_id", "html"))
    rows = seen.select("page_id", F.explode("links").alias("l")).select("page_id", F.col("l.source").alias("source"), F.col("l.href").alias("url"))
    return rows.filter(F.col("url").rlike("^/[A-Z][a-z]+$"))


@query(f"""
WITH g AS ({GRID}) SELECT k, coalesce(split_part({sql_pick(0, 4, ['Ab | Cd', 'Xy'])}, ' | ', 1), '') AS first, 'https://h.example/' || k AS page FROM g
""")
def markup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT9, UR5: the first part of a title, and a page's address from its canonical link."""
    html = F.concat(F.lit('<head><link rel="canonical" href="https://h.example/'), F.col("k").cast("string"), F.lit('"><title>'), pick(0, 4, ["Ab | Cd", "Xy"]), F.lit("</title></head>"))
    df = grid(spark, sf_dir).select("k", html.alias("html"))
    heads = df.select("k", *H.head_fields(F.col("html")))
    return heads.select("k", H.raw_brand_name(F.col("title"), F.array().cast("array<string>")).alias("first"), F.concat(F.lit("https://"), U.ref_key(F.col("canonical"))).alias("page"))


@query(f"{S_TOTALS} SELECT host, n_pages, n_links, n_chars, n_terms, CASE WHEN n_chars > 0 THEN round(n_terms * 1000.0::DOUBLE / n_chars, 2) ELSE 0.0 END AS density FROM t")
def page_visible_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT1, HT7, TX3, AG1: visible words, links and term density per host, densest first."""
    seen = H.parse_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    seen = seen.withColumn("host", U.url_host(F.col("url"))).withColumn("terms", T.count_matches(F.col("text"), r"(?iU)\bthe\b"))
    found = seen.groupBy("host").agg(F.count("*").alias("n_pages"), F.sum("n_links").alias("n_links"), F.sum(F.length("text")).alias("n_chars"), F.sum("terms").alias("n_terms"))
    return found.withColumn("density", F.round(T.per_thousand(F.col("n_terms"), F.col("n_chars")), 2)).orderBy(F.desc("n_pages"), "host")
