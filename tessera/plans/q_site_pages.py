"""From captured pages to site classes: text, links and places by the parser, the feature vector, the type and the status of
each site. The SQL reads the same pages by regular expressions and says the rules again.

The target and its competitors are parts of words that the pages hold, so that mentions, heads and hosts differ by page.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.functions import html as H
from tessera.functions import url as U
from tessera.operators import sites
from tessera.plans.inputs import read
from tessera.plans.q_sites import SITE_RULE, STATUSES, TYPES
from tessera.plans.registry import query

BRAND, LOOKALIKE, TOPIC, GAMES, EXTRA = "ther", "therst", "tion", "enach", "orta"
RIVALS = (("Wh", "wh"), ("Sch", "sch"), ("Que", "que"), ("Ou", "ou"))
COMMON = ("Ou",)
CONFIG = dataclasses.replace(
    DEFAULT,
    brand_name="Ther",
    brand=f"(?i){BRAND}",
    brand_folded=f"(?i){BRAND}",
    not_brand=f"(?i){LOOKALIKE}",
    competitors=tuple((name, f"(?i){text}") for name, text in RIVALS),
    common=COMMON,
    topic=f"(?i){TOPIC}",
    games=f"(?i){GAMES}",
    extra=f"(?i){EXTRA}",
    parked=r"(?i)cheap-pills",
    placeholder=r"(?i)^nicht ",
)


def count_in(text: str, part: str) -> str:
    """How often a part occurs in a text, in any case."""
    return f"len(regexp_extract_all({text}, '(?i){part}'))::INT"


def named_in(text: str, part: str = BRAND) -> str:
    return f"regexp_matches({text}, '(?i){part}')"


def plain(markup: str) -> str:
    """Character references, which may lack their semicolon where a text was cut, and white space of a text."""
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        markup = f"regexp_replace({markup}, '&{name};?', '{sign}', 'g')"
    return f"trim(regexp_replace({markup}, '\\s+', ' ', 'g'))"


LEFT_OUT = r"(?is)<(script|style|noscript|template|svg)[^>]*>.*?</(script|style|noscript|template|svg)>|<title[^>]*>.*?</title>|<!--.*?-->"
#: Pages by regular expressions: text, lines, title, h1 and the anchors of a page (target and text).
S_SEEN = f"""
bare AS (SELECT page_id, url, html, regexp_replace(html, '{LEFT_OUT}', '<x>', 'g') AS b, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) AS hostname FROM pages),
seen AS (SELECT page_id, url, html, hostname, regexp_replace(hostname, '^www\\.', '') AS host, {plain("regexp_replace(b, '<[^>]*>', ' ', 'g')")} AS text,
  {plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, {plain("regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')")} AS h1,
  len(regexp_extract_all(html, '<h[123][ >]'))::INT AS n_heads, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '<article[ >]'))::INT AS articles,
  regexp_replace(regexp_replace(b, '(?s)<(nav|header|footer)>.*?(</(nav|header|footer)>|$)', '', 'g'), '<(p|div|li|h1|h2|h3|h4|br|tr|td|th|section|article)( [^>]*)?>', chr(10), 'g') AS lines,
  regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs, regexp_extract_all(html, '<a href="[^"]*">(.*?)</a>', 1) AS said FROM bare),
anchors AS (SELECT page_id, host, {plain("unnest(hrefs)")} AS path, {plain("unnest(said)")} AS said, unnest(range(len(hrefs))) AS place FROM seen)
"""


def parsed(spark: SparkSession, sf_dir: str, html: Column | None = None) -> DataFrame:
    own = read(spark, sf_dir, "pages").withColumn("html", html) if html is not None else read(spark, sf_dir, "pages")
    return H.parse_pages(own.select("page_id", "url", "html"), "html", "url")


@query(f"""
WITH {S_SEEN} SELECT page_id, title, h1, lang, text, array_to_string(list_filter([{plain("regexp_replace(x, '<[^>]*>', '', 'g')")} FOR x IN string_split(lines, chr(10))], lambda x: x <> ''), chr(10)) AS block_text FROM seen
""")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT1, HT2: visible text of captured pages, and in lines without the page's frame, with title, first heading and
    language."""
    return parsed(spark, sf_dir).select("page_id", "title", "h1", "lang", "text", "block_text")


@query(f"""
WITH {S_SEEN} SELECT DISTINCT page_id, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*', 0) || path AS url, 'a' AS source FROM seen JOIN anchors USING (page_id)
UNION ALL SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '&go=1' WHEN 1 THEN 'https://' || host || '/out' WHEN 2 THEN url ELSE regexp_extract(url, '^[a-zA-Z]+://[^/?#]*', 0) || '/form' END,
  CASE page_id % 4 WHEN 0 THEN 'script_nav' WHEN 1 THEN 'data-go' WHEN 2 THEN 'script_url' ELSE 'form' END FROM seen
UNION ALL SELECT page_id, url || '&go=1', 'script_url' FROM seen WHERE page_id % 4 = 0
""")
def page_link_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT3, HT4: every link of captured pages, once for each source, resolved against the page. A script, a form or a data
    attribute with the page's own address is put into each page, as these pages hold anchors alone."""
    k, own = F.col("page_id"), F.replace("url", F.lit("&"), F.lit("&amp;"))
    code = lambda *parts: F.concat(F.lit("<script>"), *parts, F.lit("</script></head>"))
    more = (
        F.when(k % 4 == 0, code(F.lit('location.href = "'), "url", F.lit('&go=1"')))
        .when(k % 4 == 1, F.concat(F.lit('</head><i data-go="https://'), U.url_host(F.col("url")), F.lit('/out"></i>')))
        .when(k % 4 == 2, code(F.lit("var u='"), "url", F.lit("'")))
        .otherwise(F.concat(F.lit('</head><form action="/form" title="'), own, F.lit('"></form>')))
    )
    found = parsed(spark, sf_dir, F.replace("html", F.lit("</head>"), more))
    return found.select("page_id", F.explode(H.distinct_links(F.col("links"))).alias("l")).select("page_id", "l.url", "l.source")


#: Ways to hide the navigation of a page, and whether they do; by page_id.
WAYS = (("", 0), ('style="display:none"', 1), ('style="opacity: 0"', 1), ("hidden", 1), ('style="left:-5000px"', 1), ('style="opacity: 0.5"', 0), ('aria-hidden="true"', 1))


@query(f"""
WITH {S_SEEN}, n AS (SELECT page_id, count(*) AS n, count(*) FILTER (WHERE {named_in("said")} OR {named_in("host")} OR {named_in("path")}) AS named FROM anchors GROUP BY page_id)
SELECT page_id, (n * hides)::INT AS hidden_links, (named * hides)::INT AS hidden_named, CASE WHEN hides = 1 AND n > 0 THEN host ELSE '' END AS hidden_hosts, CASE WHEN page_id % 3 = 0 THEN named ELSE 0 END::INT AS in_posts, named::INT AS anchor_int
FROM (SELECT page_id, host, [{", ".join(str(w[1]) for w in WAYS)}][page_id % {len(WAYS)} + 1] AS hides FROM seen) JOIN n USING (page_id)
""")
def page_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT5, HT6, HT11: links of captured pages that a visitor does not see, and links in posts. The pages' navigations are
    put into blocks that hide them or not, and into cards."""
    k = F.col("page_id")
    ways = F.element_at(F.array(*[F.lit(w[0]) for w in WAYS]), (k % len(WAYS) + 1).cast("int"))
    begin = F.concat(F.lit("<div "), ways, F.lit(">"), F.when(k % 3 == 0, '<section class="news-card">').otherwise("<section>"), F.lit("<ul>"))
    html = F.replace(F.replace("html", F.lit("<nav><ul>"), begin), F.lit("</ul></nav>"), F.lit("</ul></section></div>"))
    found = H.link_features(parsed(spark, sf_dir, html).withColumn("host", U.hostname(F.col("url"))), config=CONFIG)
    return found.select("page_id", "hidden_links", "hidden_named", F.array_join(H.hidden_hosts(F.col("links")), " ").alias("hidden_hosts"), "in_posts", "anchor_int")


@query(f"""
WITH {S_SEEN}, m AS (SELECT *, CASE WHEN page_id % 2 = 0 THEN upper(lang) || ' ' || replace(host, '.', ' ') ELSE '' END AS site_name FROM seen)
SELECT page_id, CASE WHEN site_name <> '' THEN site_name ELSE substr(trim(regexp_replace(title, '\\s[|\\-–—:]\\s.*$', '')), 1, 60) END AS operator,
  array_to_string(list_filter([title, hostname, site_name, '/icon-' || lang || '.png'], lambda x: x <> ''), ' | ') AS fields,
  CASE WHEN page_id % 3 = 0 AND length(text) < 200 THEN 'https://' || host || '/next' ELSE '' END AS jump, page_id % 5 = 0 AS pwa FROM m
""")
def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT8, HT9, HT15: the fields of captured pages that name an operator, its raw name, a script's jump and an offer; names,
    icons and scripts with the page's own host are put into the pages."""
    k, host, lang = F.col("page_id"), U.url_host(F.col("url")), F.regexp_extract("html", '<html[^>]* lang="([^"]*)"', 1)
    name = F.when(k % 2 == 0, F.concat(F.lit('<meta property="og:site_name" content="'), F.upper(lang), F.lit(" "), F.replace(host, F.lit("."), F.lit(" ")), F.lit('">'))).otherwise("")
    jump = F.when(k % 3 == 0, F.concat(F.lit('<script>location.replace("https://'), host, F.lit('/next")</script>'))).otherwise("")
    offer = F.when(k % 5 == 0, "<script>addEventListener('beforeinstallprompt', f)</script>").otherwise("")
    head = F.concat(name, F.lit('<link rel="icon" href="/icon-'), lang, F.lit('.png">'), jump, offer, F.lit("</head>"))
    found = H.page_features(parsed(spark, sf_dir, F.replace("html", F.lit("</head>"), head)), config=CONFIG)
    return found.select("page_id", H.raw_brand_name(F.col("title"), F.col("operator_names")).alias("operator"), H.brand_fields(F.col("title"), F.col("host"), F.col("names")).alias("fields"), F.col("js_redirect").alias("jump"), "pwa")


#: The features of pages in SQL.
S_COUNTS = ", ".join(f"{count_in('text', text)} AS n_{name.lower()}" for name, text in RIVALS)
S_OTHERS = "list_sort(list_filter([" + ", ".join(f"(-n_{name.lower()}, {k}, '{name}')" for k, (name, _) in enumerate(RIVALS)) + f"], lambda x: x[1] < 0 AND (x[3] NOT IN ('{COMMON[0]}') OR topic_words >= 5)))"
S_FEATURES = f"""{S_SEEN},
linked AS (SELECT page_id, count(*)::INT AS links_int, coalesce(sum(CASE WHEN named THEN greatest({count_in("said", BRAND)}, 1) END), 0)::INT AS anchors, count(*) FILTER (WHERE named)::INT AS anchor_int
  FROM (SELECT *, {named_in("said")} OR {named_in("host")} OR {named_in("path")} AS named FROM anchors) GROUP BY page_id),
counted AS (SELECT page_id, url, host, hostname, text, substr(title, 1, 200) AS title, substr(h1, 1, 120) AS h1, lang, n_heads, articles, length(text)::INT AS text_len, {count_in("strip_accents(text)", BRAND)} AS mentions, {count_in("text", TOPIC)} AS topic_words, {S_COUNTS},
  coalesce(links_int, 0) AS links_int, coalesce(anchors, 0) AS anchors, coalesce(anchor_int, 0) AS anchor_int, substr(text, 1, 400) AS sample FROM seen LEFT JOIN linked USING (page_id)),
features AS (SELECT *, round(mentions * 1000.0::DOUBLE / greatest(text_len, 1), 2) AS density, round(topic_words * 1000.0::DOUBLE / greatest(text_len, 1), 2) AS topic_density, {named_in("title")} AS in_title, {named_in("h1")} AS in_h1, CASE WHEN {named_in("h1")} THEN 1 ELSE 0 END AS heads_named, {S_OTHERS} AS others FROM counted)
"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.page_features(parsed(spark, sf_dir), config=CONFIG)


VECTOR = ("host", "title", "h1", "lang", "text_len", "mentions", "density", "topic_words", "topic_density", "in_title", "in_h1", "heads_named", "n_heads", "links_int", "anchors", "anchor_int", "articles")


@query(f"""
WITH {S_FEATURES} SELECT page_id, hostname AS host, {", ".join(VECTOR[1:])}, array_to_string(list_transform(others, lambda x: x[3] || ':' || -x[1]), ' ') AS others, 0 AS links_ext, 0 AS hidden_links FROM features
""")
def page_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT7, TX3, TK5: the feature vector of captured pages: mentions and their density, headings, links, the names of
    competitors by how often they occur."""
    others = F.array_join(F.transform("other_brands", lambda x: F.concat(x["name"], F.lit(":"), x["n"].cast("string"))), " ")
    return features(spark, sf_dir).select("page_id", *VECTOR, others.alias("others"), "links_ext", "hidden_links")


#: One page of each site, the one with the longest text, and the flags of the rules.
S_SITES = f"""{S_FEATURES},
site AS (SELECT * EXCLUDE (r), others[1][3] AS other_name, coalesce(-others[1][1], 0) AS other_n, least(len(others), 12) AS brands FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY text_len DESC, page_id) AS r FROM features) WHERE r = 1),
d AS (SELECT *, host AS domain, {named_in("host")} AND NOT ({named_in("host", LOOKALIKE)} AND mentions = 0) AS id, in_title OR in_h1 AS ih, {named_in("title || ' ' || h1", TOPIC)} OR {named_in("title || ' ' || h1", GAMES)} OR {" OR ".join(named_in("title || ' ' || h1", t) for _, t in RIVALS)} AS th,
  {count_in("title || ' ' || h1 || ' ' || sample", EXTRA)} AS ex, false AS from_meta, false AS ad, false AS moved, false AS other_ads, false AS plain, false AS meta, 0 AS hidden, 0 AS ext, 0 AS in_posts, 0 AS date_links, 0 AS slug_links, anchor_int AS internal, heads_named AS named, n_heads AS heads FROM site),
c AS (SELECT *, id AS bd, topic_density >= 2.0 OR topic_words >= 15 OR th OR {count_in("sample", GAMES)} >= 2 OR ex >= 2 AS content FROM d),
e AS (SELECT *, content AS trade, false AS dated, articles > 0 AS posts, articles >= 3 AND slug_links >= 15 AS feed, heads > 0 AND named >= greatest(3, heads // 2) AS main, mentions >= 2.0 * greatest(other_n, 1) OR (mentions > 0 AND other_n = 0) AS dom,
  other_n >= 2.0 * greatest(mentions, 1) AND other_n >= 5 AS odom, th OR topic_density >= 5.0 OR brands > 5 AS topic, ih AND density >= 1.0 AS subj, other_n > 0 AS foreign_, id AS stays, mentions = 0 AND internal = 0 AND NOT id AND NOT ih AS nowhere, NOT id AND NOT ih AS quiet, {named_in("title")} AS tn FROM c)
"""
S_RULE = SITE_RULE.replace("title = 'Acme'", "tn")


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of each site with the columns that its rules read; nothing was scanned and nothing followed."""
    own = features(spark, sf_dir).withColumn("domain", U.url_host(F.col("url")))
    longest = own.groupBy("domain").agg(F.max_by(F.struct(*[c for c in own.columns if c not in ("domain", "links")]), F.struct("text_len", -F.col("page_id"))).alias("p")).select("domain", "p.*")
    none = F.array().cast("array<string>")
    return longest.withColumns({"host": F.lit(""), "moved": F.lit(False), "from_meta": F.lit(False), "target": F.lit(False), "other_names": none, "plain_names": none})


@query(f"WITH {S_SITES} SELECT domain, page_id, {TYPES}[rule + 1] AS site_type, rule AS site_type_rule, mentions, coalesce(other_name, '') AS top_name, other_n::INT AS top_n, main FROM (SELECT *, {S_RULE} AS rule FROM e)")
def page_site_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC15, HP4, HP5: the type of each site by the features of its longest page, with the rule that decided and the
    competitor named most often."""
    typed = sites.site_type(site_pages(spark, sf_dir), CONFIG)
    top = sites.top_other(F.col("other_brands"))
    return typed.select("domain", "page_id", "site_type", "site_type_rule", "mentions", top["name"].alias("top_name"), top["n"].alias("top_n"), sites.dominant_site(F.col("n_heads"), F.col("heads_named")).alias("main"))


@query(f"""
WITH {S_SITES}, q AS (SELECT *, {S_RULE} AS rule, CASE page_id % 5 WHEN 0 THEN '404' ELSE '200' END AS code,
  regexp_matches(title || ' ' || sample || ' ' || url, '(?i)cheap-pills') AS parking, regexp_matches(title || ' ' || substr(sample, 1, 300) || ' ' || url, '(?i)^nicht ') AS filler, text_len < 300 AND mentions = 0 AS bare FROM e),
s AS (SELECT *, CASE WHEN parking AND text_len < 3000 THEN 12 WHEN filler AND text_len < 1500 THEN 14 WHEN bare AND code = '404' THEN 15 WHEN bare THEN 16 ELSE 0 END AS st FROM q)
SELECT domain, st AS status_rule, CASE WHEN st > 0 THEN {STATUSES}[st + 1] ELSE {TYPES}[rule + 1] END AS category, text_len FROM s
""")
def page_site_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC18, DC15: the class of each site: its status, or, where it is open, its type, from captured pages to the verdict."""
    code = F.when(F.col("page_id") % 5 == 0, "404").otherwise("200")
    nothing = {c: F.lit(None).cast("string") for c in ("redirect", "redirect_why", "group", "group_history", "reason", "scan_title", "scan_text", "home_group")}
    own = site_pages(spark, sf_dir).withColumns({**nothing, "http_status": code, "final_url": F.col("url"), "has_page": F.lit(True), "has_features": F.lit(True), "from_scan": F.lit(False)})
    judged = sites.site_type(sites.site_status(own, CONFIG), CONFIG)
    return judged.select("domain", "status_rule", F.when(F.col("status") == "open", F.col("site_type")).otherwise(F.col("status")).alias("category"), "text_len")


#: Pages, links, characters and mentions of a term by site.
S_TOTALS = f"""WITH {S_SEEN}, l AS (SELECT page_id, count(DISTINCT path) AS links FROM anchors GROUP BY page_id),
w AS (SELECT host, text, coalesce(links, 0) AS links, len(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda x: x = 'the')) AS terms FROM seen LEFT JOIN l USING (page_id)),
t AS (SELECT host, count(*) AS n_pages, sum(links)::BIGINT AS n_links, sum(length(text))::BIGINT AS n_chars, sum(terms)::BIGINT AS n_terms FROM w GROUP BY host)
"""
