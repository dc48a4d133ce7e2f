"""Site classes over grids of page features and scan results; the SQL says each rule again, in the published order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import groups, scores, sites
from tessera.plans.inputs import GRID, flag, grid, nothing, number, pick, sql_flag, sql_number, sql_pick
from tessera.plans.registry import query



def _list(c: Column, *names: str) -> Column:
    return F.when(c, F.array(*[F.lit(n) for n in names])).otherwise(nothing())


DOMAINS = ("acme-play.example", "shop.example", "acmetal.example")
HOSTS = ("acme-play.example", "new.example", "")
TITLES = ("Acme", "Bonus", "Garden", "Globex", "Garden", "Garden", "Garden")
SAMPLES = ("raffle and lottery", "plants", "plants", "plants", "free spins, lucky draw", "plants", "plants")
FEATURES = {"moved": (0, 5, 3), "in_title": (0, 9, 3), "in_h1": (0, 13, 3), "from_meta": (1, 5, 6), "meta": (1, 9, 3), "ad": (2, 5, 4), "other_ads": (2, 9, 4), "plain": (2, 13, 5), "loud": (0, 29, 2), "rival": (3, 25, 3)}
COUNTS = {"mentions": (1, 13, 12), "date_links": (1, 17, 9), "articles": (2, 17, 5), "slug_links": (3, 5, 22), "ext": (3, 9, 5), "internal": (3, 13, 3), "hidden": (3, 17, 5), "in_posts": (0, 17, 3), "heads": (2, 1, 6), "named": (3, 1, 5), "topic": (1, 1, 4), "other_n": (2, 21, 9), "words": (0, 21, 16), "text_len": (1, 21, 9)}
#: Counts that are 0 where a site is not loud, and without a rival.
QUIET = {"mentions": "loud", "ext": "loud", "internal": "loud", "hidden": "loud", "in_posts": "loud", "date_links": "loud", "other_n": "rival"}
DENSITIES = (0.0, 0.4, 0.7, 1.5, 3.0)

SITE_FLAGS = f"""
g AS ({GRID}), a AS (SELECT k, {sql_pick(0, 2, DOMAINS)} AS domain, {sql_pick(1, 2, HOSTS)} AS host, {sql_pick(2, 2, TITLES)} AS title, {sql_pick(3, 2, SAMPLES)} AS sample, {sql_pick(0, 25, DENSITIES)} AS density, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in FEATURES.items())}, {", ".join(f"{sql_number(*v)}" + (f" * {sql_flag(*FEATURES[QUIET[c]])}::INT" if c in QUIET else "") + f" AS {c}" for c, v in COUNTS.items())} FROM g),
b AS (SELECT * EXCLUDE (text_len, topic), text_len * 400 AS text_len, topic / 1.0 AS topic_density, CASE WHEN other_n > 0 THEN 'Globex' ELSE '' END AS other_name, (other_n > 0)::INT AS brands FROM a),
c AS (SELECT *, contains(domain, 'acme') AND NOT (domain = 'acmetal.example' AND mentions = 0) AS bd, (CASE WHEN moved THEN contains(coalesce(nullif(host, ''), domain), 'acme') ELSE contains(domain, 'acme') END) AND NOT (domain = 'acmetal.example' AND mentions = 0) AS id, in_title OR in_h1 AS ih,
  title IN ('Bonus', 'Globex') AS th FROM b),
d AS (SELECT *, topic_density >= 2.0 OR words >= 15 OR th OR sample IN ('raffle and lottery', 'free spins, lucky draw') AS content FROM c),
e AS (SELECT *, content OR other_ads OR plain AS trade, date_links >= 5 AS dated, articles > 0 OR date_links >= 5 AS posts, date_links >= 5 OR (articles >= 3 AND slug_links >= 15) AS feed, heads > 0 AND named >= greatest(3, heads // 2) AS main,
  mentions >= 2.0 * greatest(other_n, 1) OR (mentions > 0 AND other_n = 0) AS dom, other_n >= 2.0 * greatest(mentions, 1) AND other_n >= 5 AS odom, th OR topic_density >= 5.0 OR brands > 5 AS topic, (ih OR meta) AND density >= 1.0 AS subj, other_n > 0 OR other_ads OR plain AS foreign_, id AND NOT moved AS stays,
  mentions = 0 AND ext = 0 AND internal = 0 AND NOT id AND NOT ih AND NOT ad AS nowhere, NOT id AND NOT ih AS quiet FROM d)
"""
SITE_RULE = """CASE
  WHEN id AND from_meta AND NOT ad THEN 1
  WHEN bd AND moved AND mentions = 0 AND NOT ad AND (trade OR other_ads) THEN 2
  WHEN nowhere AND (content OR other_ads) THEN 3
  WHEN nowhere THEN 4
  WHEN dated AND quiet AND hidden = 0 AND NOT subj AND NOT ad THEN 5
  WHEN hidden >= 3 AND NOT th AND NOT id AND NOT subj THEN 6
  WHEN NOT topic AND NOT id AND NOT subj AND (hidden > 0 OR (ext > 0 AND mentions <= greatest(ext, 3) + 2)) THEN 7
  WHEN ih AND NOT id AND NOT content AND NOT subj AND text_len >= 1000 AND NOT ad AND NOT (in_title AND in_h1) THEN 8
  WHEN NOT topic AND NOT id AND NOT ad AND NOT subj AND (in_posts > 0 OR (internal > 0 AND posts)) THEN 9
  WHEN (id OR (title = 'Acme' AND brands < 3 AND content)) AND foreign_ AND (odom OR (content AND mentions = 0 AND NOT ad)) THEN 10
  WHEN (id OR ih) AND dom AND (density >= 0.5 OR (ih AND ad)) THEN 11
  WHEN quiet AND feed AND NOT main AND NOT ad AND NOT subj THEN 12
  WHEN dom AND density >= 1.0 AND trade AND named >= 2 AND ext <= mentions / 2.0 THEN 13
  WHEN quiet AND feed AND NOT main AND NOT (meta AND density >= 1.0) THEN 14
  WHEN stays AND content AND foreign_ THEN 15
  WHEN stays AND NOT ad AND (from_meta OR (content AND mentions = 0)) THEN 16
  WHEN stays AND (content OR ad OR (trade AND mentions > 0)) THEN 17
  WHEN stays AND other_ads AND mentions = 0 THEN 18
  WHEN stays AND NOT content AND text_len >= 1500 THEN 19
  WHEN trade AND mentions = 0 AND ext = 0 AND internal = 0 AND NOT ad AND NOT ih THEN 20
  WHEN ad AND quiet AND NOT trade AND NOT subj THEN 21
  WHEN trade AND other_n = 0 AND mentions <= 1 AND ext = 0 AND internal = 0 AND NOT ih THEN 22
  WHEN trade THEN 23
  WHEN NOT id AND (internal > 0 OR posts) THEN 24
  WHEN id AND mentions = 0 AND text_len >= 1500 THEN 25
  WHEN id AND mentions = 0 THEN 26 ELSE 0 END"""
TYPES = "['unclear','bait','bait','other_topic','unrelated','article','hacked','hacked','hacked','article','bait','mono','article','mono','article','bait','bait','mono','bait','discredit','other_topic','article','other_topic','multibrand','article','discredit','stub']"


def site_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites whose features are drawn from a grid."""
    on = {c: flag(*v) for c, v in FEATURES.items()}
    n = {c: number(*v) * on[QUIET[c]].cast("int") if c in QUIET else number(*v) for c, v in COUNTS.items()}
    brands = F.when(n["other_n"] > 0, F.array(F.struct(F.lit("Globex").alias("name"), n["other_n"].alias("n")))).otherwise(F.array().cast("array<struct<name:string,n:int>>"))
    return grid(spark, sf_dir).select(
        "k",
        pick(0, 2, DOMAINS).alias("domain"),
        pick(1, 2, HOSTS).alias("host"),
        on["moved"].alias("moved"),
        pick(2, 2, TITLES).alias("title"),
        F.lit("").alias("h1"),
        pick(3, 2, SAMPLES).alias("text_sample"),
        F.lit("").alias("meta_text"),
        (n["text_len"] * 400).alias("text_len"),
        n["mentions"].alias("mentions"),
        pick(0, 25, DENSITIES).alias("density"),
        on["in_title"].alias("in_title"),
        on["in_h1"].alias("in_h1"),
        on["meta"].cast("int").alias("meta_mentions"),
        n["heads"].alias("n_heads"),
        n["named"].alias("heads_named"),
        brands.alias("other_brands"),
        n["topic"].cast("double").alias("topic_density"),
        n["words"].alias("topic_words"),
        n["articles"].alias("articles"),
        n["date_links"].alias("date_links"),
        n["slug_links"].alias("slug_links"),
        n["ext"].alias("anchor_ext"),
        n["internal"].alias("anchor_int"),
        n["hidden"].alias("hidden_named"),
        n["in_posts"].alias("in_posts"),
        on["from_meta"].alias("from_meta"),
        on["ad"].alias("target"),
        _list(on["other_ads"], "Globex").alias("other_names"),
        _list(on["plain"], "p.example").alias("plain_names"),
    )


@query(f"WITH {SITE_FLAGS}, f AS (SELECT *, {SITE_RULE} AS rule FROM e) SELECT k, {TYPES}[rule + 1] AS site_type, rule AS site_type_rule, CASE WHEN rule IN (10, 15, 18, 23) THEN 'content=' || coalesce(nullif(other_name, ''), 'other') || ':' || other_n || ' target=' || mentions ELSE '' END AS why FROM f")
def site_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC15: all 26 rules over a grid of flags, with the rule that decided."""
    typed = sites.site_type(site_rows(spark, sf_dir))
    why = F.when(F.col("site_type_rule").isin(10, 15, 18, 23), F.col("site_type_why")).otherwise("")
    return typed.select("k", "site_type", "site_type_rule", why.alias("why"))


@query(f"WITH {SITE_FLAGS} SELECT k, other_name AS top_name, other_n AS top_n, main, CASE WHEN other_n > 0 THEN 'Globex:' || other_n ELSE '' END AS listed FROM e")
def site_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HP4, HP5, TK5: the competitor named most often, whether the headings are the target's, and the list of a report."""
    top = sites.top_other(F.col("other_brands"))
    return site_rows(spark, sf_dir).select("k", top["name"].alias("top_name"), top["n"].alias("top_n"), sites.dominant_site(F.col("n_heads"), F.col("heads_named")).alias("main"), sites.brand_counts(F.col("other_brands")).alias("listed"))


STATUS_FLAGS = {"redirect": (0, 2, 9), "has_page": (0, 6, 4), "has_features": (0, 10, 5), "from_scan": (0, 14, 3), "parked": (1, 2, 7), "shell": (1, 6, 5), "assets": (1, 10, 4), "target": (1, 14, 4), "other": (1, 18, 4), "no_answer": (2, 2, 3)}
SCAN_GROUPS = ("5_dead", "5_not_shown", "6_check", "2_no_ads", "1_target_only", "")
HISTORIES = ("5_dead", "2_no_ads > 5_dead", "")
REASONS = ("parked", "empty_page", "timeout", "")
CODES = ("200", "404", "503", "")
PAGE_TITLES = ("Just a moment", "acme.example - club", "coming soon", "Garden", "this domain is parked")
SCAN_TITLES = ("welcome to nginx", "Shop")


def s_status() -> str:
    return """CASE
  WHEN redirect THEN 1
  WHEN grp = '5_dead' AND reason <> 'parked' AND regexp_matches(history, '5_not_shown|6_check|_only|no_ads|mixed|no_mention|unresolved') THEN 2
  WHEN grp = '5_dead' AND reason = 'empty_page' AND code = '200' THEN 3
  WHEN grp = '5_dead' AND NOT real_ AND reason = 'parked' THEN 4
  WHEN grp = '5_dead' AND NOT real_ THEN 5
  WHEN hid AND st = 'welcome to nginx' THEN 6
  WHEN hid THEN 7
  WHEN has_page AND title = 'Just a moment' AND n < 3000 THEN 8
  WHEN NOT has_features AND no_answer THEN 9
  WHEN NOT has_page AND no_answer THEN 10
  WHEN NOT has_page THEN 11
  WHEN (parked OR title = 'this domain is parked') AND NOT other AND n < 3000 THEN 12
  WHEN (shell OR (assets AND title = 'acme.example - club')) AND (mentions <= 5 OR n < 6000) THEN 13
  WHEN title = 'coming soon' AND n < 1500 AND NOT target AND NOT other THEN 14
  WHEN n < 300 AND mentions = 0 AND NOT target AND NOT other AND code IN ('404', '503') THEN 15
  WHEN n < 300 AND mentions = 0 AND NOT target AND NOT other THEN 16 ELSE 0 END"""


STATUSES = "['open','redirect','not_shown','stub','parked','dead','stub','not_shown','not_shown','dead','dead','stub','parked','mirror','stub','not_shown','stub']"
STATUS_GRID = f"""
g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in STATUS_FLAGS.items())}, {sql_pick(2, 5, SCAN_GROUPS)} AS grp, {sql_pick(2, 9, HISTORIES)} AS history, {sql_pick(2, 13, REASONS)} AS reason, {sql_pick(2, 17, CODES)} AS code, {sql_pick(3, 2, PAGE_TITLES)} AS title, {sql_pick(3, 7, SCAN_TITLES)} AS st, {sql_number(3, 9, 14)} * 250 AS n, {sql_number(3, 14, 8)} AS mentions FROM g),
b AS (SELECT * EXCLUDE (has_page, has_features), NOT has_page AS has_page, NOT has_features AS has_features, NOT has_page AND n >= 50 AND NOT from_scan AS real_, grp IN ('5_not_shown', '6_check') AS hid FROM a)
"""


@query(f"WITH {STATUS_GRID}, c AS (SELECT *, {s_status()} AS rule FROM b) SELECT k, rule AS status_rule, {STATUSES}[rule + 1] AS status, CASE rule WHEN 1 THEN 'redirect: x' WHEN 2 THEN 'answered earlier: ' || history WHEN 15 THEN 'http_' || code WHEN 16 THEN 'text_len=' || n ELSE '' END AS why FROM c")
def site_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC18: all rules of a site's status over a grid."""
    on = {c: flag(*v) for c, v in STATUS_FLAGS.items()}
    df = grid(spark, sf_dir).select(
        "k",
        F.when(on["redirect"], "redirect_other").alias("redirect"),
        F.when(on["redirect"], "redirect: x").alias("redirect_why"),
        F.nullif(pick(2, 5, SCAN_GROUPS), F.lit("")).alias("group"),
        pick(2, 9, HISTORIES).alias("group_history"),
        pick(2, 13, REASONS).alias("reason"),
        pick(2, 17, CODES).alias("http_status"),
        pick(3, 7, SCAN_TITLES).alias("scan_title"),
        F.lit("").alias("scan_text"),
        F.when(on["no_answer"], "no_answer").alias("home_group"),
        (~on["has_page"]).alias("has_page"),
        (~on["has_features"]).alias("has_features"),
        on["from_scan"].alias("from_scan"),
        pick(3, 2, PAGE_TITLES).alias("title"),
        (number(3, 9, 14) * 250).alias("text_len"),
        F.lit("").alias("text_sample"),
        F.lit("").alias("final_url"),
        on["parked"].alias("parked"),
        on["shell"].alias("shell"),
        on["assets"].alias("assets"),
        number(3, 14, 8).alias("mentions"),
        on["target"].alias("target"),
        _list(on["other"], "Globex").alias("other_names"),
    )
    why = F.when(F.col("status_rule").isin(1, 2, 15, 16), F.col("status_why")).otherwise("")
    return sites.site_status(df).select("k", "status_rule", "status", why.alias("why"))


SUB = {"target": (0, 2, 2), "other": (0, 4, 3), "plain": (0, 8, 2), "gates": (0, 11, 3), "trackers": (0, 15, 4), "incomplete": (1, 2, 3), "hidden": (1, 6, 2), "evidence": (1, 9, 3)}
MODES = ("browser", "http", "browser+rest")
CLASSES = ("mono", "bait", "dead", "article", "mirror")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in SUB.items())}, {sql_pick(2, 2, MODES)} AS mode, {sql_pick(2, 6, ("2_no_ads", "8_no_mention", "1_target_only"))} AS grp, {sql_number(2, 10, 2)} AS unv, {sql_pick(3, 2, CLASSES)} AS cls FROM g),
b AS (SELECT *, CASE WHEN other THEN CASE WHEN target THEN 'mono_mixed' ELSE 'mono_other' END WHEN mode <> 'http' AND grp <> '1_target_only' AND NOT incomplete AND NOT target AND NOT plain THEN 'mono_no_ads' WHEN NOT target AND (gates OR trackers OR unv > 0) THEN 'mono_unresolved' WHEN plain THEN 'mono_xlink' WHEN target THEN 'mono_target' ELSE 'mono_no_ads' END AS sub FROM a),
c AS (SELECT *, CASE WHEN cls = 'mono' THEN sub ELSE cls END AS c1 FROM b), d AS (SELECT *, c1 LIKE 'mono_%' AND NOT other AND plain AND hidden AS hit FROM c)
SELECT k, sub, CASE WHEN hit THEN 'mono_hidden' ELSE c1 END AS hidden, CASE WHEN hit THEN 'w | hidden links to p.example' ELSE 'w' END AS why,
  CASE WHEN evidence AND c1 NOT IN ('mono_other', 'mono_mixed', 'bait') AND c1 LIKE 'mono_%' THEN CASE WHEN target THEN 'mono_mixed' ELSE 'mono_other' END WHEN evidence AND c1 = 'article' THEN 'page_other' ELSE c1 END AS final FROM d
""")
def mono_subtypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC16, and of DC18 hidden links and evidence of inner pages, ST4."""
    on = {c: flag(*v) for c, v in SUB.items()}
    plain, hidden = _list(on["plain"], "p.example"), _list(on["hidden"], "q.example", "p.example")
    sub = sites.mono_subtype(on["target"], _list(on["other"], "Globex"), plain, number(2, 10, 2), _list(on["gates"], "g"), _list(on["trackers"], "t"), pick(2, 2, MODES), pick(2, 6, ("2_no_ads", "8_no_mention", "1_target_only")), _list(on["incomplete"], "x"))
    cls = pick(3, 2, CLASSES)
    df = grid(spark, sf_dir).withColumn("sub", sub).withColumn("c1", F.when(cls == "mono", F.col("sub")).otherwise(cls))
    category, why = sites.hidden_override(F.col("c1"), F.lit("w"), plain, hidden, _list(on["other"], "Globex"))
    return df.select("k", "sub", category.alias("hidden"), why.alias("why"), sites.evidence_override(F.col("c1"), _list(on["evidence"], "Umbra"), on["target"]).alias("final"))


TAGS = {"pwa": (0, 2, 3), "platform": (0, 6, 3), "differ": (0, 10, 3), "referrer": (0, 14, 3), "apk": (1, 2, 3), "ours": (1, 6, 3), "named": (1, 10, 2), "moved": (1, 12, 2), "open": (2, 2, 3), "page": (2, 6, 3), "mobile": (2, 10, 3), "search": (2, 14, 3), "cloaked": (3, 2, 3)}


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in TAGS.items())} FROM g)
SELECT k, array_to_string(list_filter([CASE WHEN mobile THEN 'ads_mobile_only' END, CASE WHEN search THEN 'ads_search_only' END, CASE WHEN cloaked THEN 'cloaked:bot' END, CASE WHEN pwa THEN 'pwa' END, CASE WHEN platform THEN 'platform' END, CASE WHEN differ THEN 'rotating_ads' END, CASE WHEN referrer THEN 'search_referrer_js' END, CASE WHEN apk THEN 'apk' END,
  CASE WHEN ours THEN 'our_ref' END, CASE WHEN named THEN 'brand_in_domain' END, CASE WHEN moved THEN 'moved' END, CASE WHEN open THEN 'ads_unverified' END, CASE WHEN NOT page THEN 'no_html' END], lambda x: x IS NOT NULL), ' ') AS tags FROM a
""")
def site_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC19, TX21: all tags in order, also of what only one visitor is shown."""
    on = {c: flag(*v) for c, v in TAGS.items()}
    base = F.array(F.lit("Globex"))
    seen = {"mobile": F.when(on["mobile"], F.array(F.lit("Globex"), F.lit("Umbra"))).otherwise(base), "search_mobile": F.when(on["search"], F.array(F.lit("Umbra"))).otherwise(nothing())}
    domain = F.when(on["named"], "acme.example").otherwise("d.example")
    df = grid(spark, sf_dir).withColumns(
        {
            "domain": domain,
            "visitor_tags": sites.visitor_tags(base, seen),
            "cloaked": F.when(on["cloaked"], "bot").otherwise(""),
            "pwa": on["pwa"],
            "platform": on["platform"],
            "ads_differ": on["differ"],
            "referrer_js": on["referrer"],
            "apk": _list(on["apk"], "a.apk"),
            "ours": on["ours"],
            "host": F.when(on["moved"], "new.example").otherwise(F.concat(F.lit("www."), domain)),
            "final_url": F.lit(""),
            "unverified": on["open"].cast("int"),
            "has_page": on["page"],
        }
    )
    return df.select("k", F.array_join(sites.site_tags(), " ").alias("tags"))


CAPTURE = "struct<error:string,text_len:int,title:string,text:string,aff_links:array<struct<url:string,brand:string>>,gates:array<string>,trackers:array<string>,apk:array<string>,shell:boolean,pwa:boolean,pwa_offer:string,referrer_js:boolean,assets:boolean,front_title:boolean,parked:boolean,mentions:int,density:double,in_title:boolean,in_h1:boolean,topic_density:double,topic_words:int,slug_links:int,date_links:int,other_brands:array<struct<name:string,n:int>>,meta_text:string,meta_mentions:int,from_scan:boolean,from_meta:boolean>"


def _capture(name: str, here: Column, broken: Column, n: Column, on: dict[str, Column]) -> Column:
    links = F.array(F.struct(F.lit("https://one.example/").alias("url"), F.lit(name).alias("brand")), F.struct(F.lit(f"https://{name}.example/").alias("url"), F.lit(name).alias("brand")))
    values = {
        "error": F.when(broken, "timeout"), "text_len": n, "title": F.when(on["wall"], "Just a moment").otherwise(F.lit(name)), "text": F.lit(name), "aff_links": links, "gates": F.array(F.lit(f"/{name}"), F.lit("/go")), "trackers": F.array().cast("array<string>"), "apk": F.array(F.lit(f"{name}.apk")),
        "shell": on[f"{name}_shell"], "pwa": F.lit(False), "pwa_offer": F.when(on[f"{name}_shell"], "").otherwise(F.lit(name)), "referrer_js": F.lit(name == "browser"), "assets": F.lit(False), "front_title": F.lit(False), "parked": on["parked"], "mentions": F.lit(1), "density": F.lit(0.5), "in_title": F.lit(False), "in_h1": F.lit(True),
        "topic_density": F.lit(1.0), "topic_words": F.lit(4), "slug_links": F.lit(5), "date_links": F.lit(6), "other_brands": F.array(F.struct(F.lit("Umbra").alias("name"), F.lit(3).alias("n"))), "meta_text": F.when(on["meta"], "Acme app").otherwise(""), "meta_mentions": F.lit(4), "from_scan": F.lit(False), "from_meta": F.lit(False),
    }
    return F.when(here, F.struct(*[v.alias(c) for c, v in values.items()]).cast(CAPTURE))


PAIR = {"browser": (0, 2, 5), "plain": (0, 6, 5), "browser_bad": (0, 10, 4), "plain_bad": (0, 14, 4), "browser_shell": (1, 2, 2), "plain_shell": (1, 4, 2), "parked": (1, 6, 2), "wall": (1, 8, 4), "meta": (1, 12, 2), "scan": (1, 15, 3), "names": (2, 2, 2), "blank": (2, 4, 3)}


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in PAIR.items())}, {sql_number(2, 8, 5)} * 900 AS bn, {sql_number(2, 12, 5)} * 700 AS hn, {sql_number(3, 2, 4)} * 40 AS sn, {sql_number(3, 6, 3)} AS sm FROM g),
b AS (SELECT *, NOT browser AND NOT browser_bad AS b, NOT plain AND NOT plain_bad AS h FROM a), c AS (SELECT *, b OR h AS had, CASE WHEN b AND (NOT h OR bn >= hn) THEN 'browser' WHEN h THEN 'plain' END AS base, CASE WHEN b AND (NOT h OR bn >= hn) THEN bn WHEN h THEN hn END AS n FROM b),
d AS (SELECT *, CASE WHEN b AND h THEN 'one browser plain' WHEN b THEN 'one browser' WHEN h THEN 'one plain' END AS links, CASE WHEN b AND h THEN '/browser /go /plain' WHEN b THEN '/browser /go' WHEN h THEN '/plain /go' END AS gates, (b AND browser_shell) OR (h AND plain_shell) AS shell,
  coalesce(CASE WHEN b AND NOT browser_shell THEN 'browser' END, CASE WHEN h AND NOT plain_shell THEN 'plain' END, '') AS offer, parked AND NOT (b AND bn > 2000) AS park,
  NOT scan OR (had AND NOT wall AND n >= greatest(sn, 1) * 0.5) AS stays, scan AND sn = 0 AND sm = 0 AND blank AS nothing FROM c),
e AS (SELECT *, had OR (NOT stays AND NOT nothing) AS page, NOT stays AND NOT nothing AS taken, had AND wall AND NOT stays AS bared FROM d),
f AS (SELECT *, CASE WHEN taken THEN sn ELSE n END AS n2, CASE WHEN taken THEN sm ELSE 1 END AS m2, CASE WHEN taken AND NOT blank THEN 'Acme scan' WHEN had AND wall THEN 'Just a moment' WHEN had THEN base WHEN taken THEN '' END AS t2 FROM e), h AS (SELECT *, page AND had AND coalesce(n2, 0) < 100 AND meta AS metad FROM f)
SELECT k, CASE WHEN had THEN CASE WHEN bared THEN '' ELSE links END ELSE '' END AS links, CASE WHEN had THEN gates ELSE '' END AS gates, CASE WHEN had THEN shell END AS shell, CASE WHEN had THEN offer END AS offer, CASE WHEN had THEN park END AS parked, CASE WHEN page THEN n2 END AS text_len,
  CASE WHEN page THEN CASE WHEN metad THEN greatest(m2, 4) ELSE m2 END END AS mentions, CASE WHEN page THEN CASE WHEN metad AND coalesce(t2, '') = '' THEN 'Acme app' ELSE t2 END END AS title, CASE WHEN page THEN (taken AND NOT blank) OR metad END AS in_title,
  CASE WHEN page THEN CASE WHEN taken AND names THEN 'Globex:2' WHEN had THEN 'Umbra:3' ELSE '' END ELSE '' END AS brands, CASE WHEN page THEN taken END AS from_scan, CASE WHEN page AND (had OR metad) THEN metad END AS from_meta, CASE WHEN had AND NOT bared THEN 5 END AS slug_links FROM h
""")
def merged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC12, DC13: one page out of two captures, a scan and meta fields."""
    on = {c: flag(*v) for c, v in PAIR.items()}
    scan = F.when(on["scan"], F.struct((number(3, 2, 4) * 40).alias("text_len"), number(3, 6, 3).alias("mentions"), F.when(on["blank"], "").otherwise("Acme scan").alias("title"), _list(on["names"], "Globex").alias("other_names")))
    df = grid(spark, sf_dir).withColumns({"browser": _capture("browser", ~on["browser"], on["browser_bad"], number(2, 8, 5) * 900, on), "plain": _capture("plain", ~on["plain"], on["plain_bad"], number(2, 12, 5) * 700, on), "scan": scan})
    df = sites.with_meta(sites.from_scan(sites.merged_page(df)))
    p = lambda c: F.col(f"page.{c}")
    names = F.array_join(F.transform(p("aff_links"), lambda x: F.regexp_extract(x["url"], r"https://(\w+)", 1)), " ")
    brands = F.array_join(F.transform(p("other_brands"), lambda x: F.concat(x["name"], F.lit(":"), x["n"].cast("string"))), " ")
    return df.select("k", F.coalesce(names, F.lit("")).alias("links"), F.coalesce(F.array_join(p("gates"), " "), F.lit("")).alias("gates"), p("shell").alias("shell"), p("pwa_offer").alias("offer"), p("parked").alias("parked"), *[p(c).alias(c) for c in ("text_len", "mentions", "title", "in_title", "from_scan", "from_meta", "slug_links")], F.coalesce(brands, F.lit("")).alias("brands"))


VISITORS = ("plain", "search_mobile", "bot")
OPEN = ("4_mixed", "1_target_only", "5_dead", "2_no_ads")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k % 4000 AS d, k, {sql_pick(0, 2, OPEN)} AS grp, {sql_pick(0, 6, ("Just a moment", "Shop"))} AS t FROM g), b AS (SELECT d, k, (row_number() OVER (PARTITION BY d ORDER BY k) - 1) AS v, CASE WHEN t = 'Just a moment' THEN 0 ELSE CASE grp WHEN '4_mixed' THEN 6 WHEN '1_target_only' THEN 4 WHEN '2_no_ads' THEN 2 ELSE 0 END END AS r, grp FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY r DESC, v) AS best FROM b WHERE r > 0) SELECT 'd' || d AS domain, grp AS "group", v AS visitor_no FROM c WHERE best = 1
""")
def best_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN11: the visitor whose capture counts for a hidden site."""
    from pyspark.sql import Window

    d = F.pmod("k", F.lit(4000))
    no = F.row_number().over(Window.partitionBy("domain").orderBy("k")).cast("long") - 1
    df = grid(spark, sf_dir).select("k", F.concat(F.lit("d"), d.cast("string")).alias("domain"), pick(0, 2, OPEN).alias("group"), pick(0, 6, ("Just a moment", "Shop")).alias("title"), F.lit(5).alias("text_len")).withColumn("visitor_no", no)
    return sites.best_visitor(df).select("domain", "group", "visitor_no")


WHYS = ("dominant density=0.7", "name_in_title", "name_in_domain", "moves to x", "content=Globex:9 target=1", "content=Globex:2 target=1", "content=other:0 target=3", "shell", "hidden links=4", "links without topic", "head only", "timeout", "http_403", "http_500", "answered earlier: x", "text_len=20", "placeholder text", "parked", "redirect: pid 7", "never names the target", "geo_block", "meta only")
CATEGORIES = ("mono_other", "mono_mixed", "page_other", "bait", "redirect_ref", "redirect_other", "discredit", "mono_target", "mono_unresolved", "mono_no_ads", "mono_xlink", "mono_hidden", "mirror", "multibrand", "article", "hacked", "other_topic", "unclear", "stub", "parked", "dead", "not_shown", "new_class")
OTHERS = ("", "Globex", "via tr.example", "Globex|Umbra")
SCORED = {"coded": (1, 2, 2), "shared": (1, 5, 9), "template": (1, 9, 9), "block": (1, 13, 9), "target": (1, 17, 2), "links": (2, 2, 2), "t_open": (2, 5, 4), "t_dom": (2, 9, 2), "t_html": (2, 12, 5), "t_cloak": (2, 16, 5), "t_seen": (2, 20, 5)}


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_pick(0, 2, CATEGORIES)} AS c, {sql_pick(0, 8, WHYS)} AS w, {sql_pick(0, 14, OTHERS)} AS o, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in SCORED.items())}, {sql_pick(3, 2, (0.5, 2.0))} AS dens, {sql_number(3, 5, 8)} * 1000 AS n, {sql_number(3, 9, 40)} AS feed, {sql_pick(3, 15, (0.0, 3.0))} AS td FROM g),
b AS (SELECT *, c IN ('mono_other', 'mono_mixed') AS mixed, regexp_matches(w, '^content=') AS held, coalesce(try_cast(regexp_extract(w, ':(\\d+)', 1) AS DOUBLE), 0) / (coalesce(try_cast(regexp_extract(w, 'target=(\\d+)', 1) AS DOUBLE), 0) + 1) AS ratio, o IN ('Globex', 'Globex|Umbra') AS named FROM a),
s AS (SELECT *, CASE WHEN mixed THEN CASE WHEN named AND coded THEN 0.92 WHEN named THEN 0.85 WHEN o <> '' THEN 0.68 ELSE 0.78 END
  WHEN c = 'page_other' THEN CASE WHEN named THEN 0.8 ELSE 0.68 END
  WHEN c = 'bait' THEN CASE WHEN w = 'moves to x' THEN 0.85 WHEN w LIKE 'never%' THEN 0.8 WHEN w = 'meta only' THEN 0.7 WHEN held AND ratio >= 3 THEN 0.88 WHEN held THEN 0.72 ELSE 0.7 END
  WHEN c = 'redirect_ref' THEN CASE WHEN contains(w, 'pid') THEN 0.95 ELSE 0.85 END WHEN c = 'redirect_other' THEN 0.85
  WHEN c = 'discredit' THEN 0.78 WHEN c = 'mono_target' THEN 0.86 WHEN c = 'mono_unresolved' THEN 0.75 WHEN c = 'mono_no_ads' THEN 0.72 WHEN c = 'mono_xlink' THEN 0.65 WHEN c = 'mono_hidden' THEN 0.85 WHEN c = 'mirror' THEN CASE WHEN w = 'shell' THEN 0.95 ELSE 0.8 END
  WHEN c = 'multibrand' THEN CASE WHEN NOT held OR w LIKE 'content=other%' THEN 0.6 WHEN ratio >= 3 THEN 0.85 WHEN ratio >= 1.5 THEN 0.75 ELSE 0.6 END
  WHEN c = 'article' THEN CASE WHEN feed >= 30 THEN 0.85 WHEN feed >= 15 THEN 0.75 ELSE 0.62 END WHEN c = 'hacked' THEN CASE WHEN w = 'hidden links=4' THEN 0.85 WHEN w = 'head only' THEN 0.55 ELSE 0.65 END
  WHEN c = 'other_topic' THEN 0.88 WHEN c = 'unclear' THEN 0.3 WHEN c = 'stub' THEN CASE WHEN w = 'placeholder text' THEN 0.85 WHEN w LIKE 'text_len%' THEN 0.7 ELSE 0.6 END WHEN c = 'parked' THEN CASE WHEN w = 'parked' THEN 0.9 ELSE 0.85 END
  WHEN c = 'dead' THEN CASE WHEN w = 'timeout' THEN 0.75 ELSE 0.7 END WHEN c = 'not_shown' THEN CASE WHEN w = 'http_403' THEN 0.8 WHEN w = 'http_500' THEN 0.72 WHEN w LIKE 'answered%' THEN 0.55 WHEN w = 'geo_block' THEN 0.9 ELSE 0.62 END ELSE 0.7 END::DOUBLE AS base FROM b),
x AS (SELECT *, CASE WHEN mixed AND o = 'Globex|Umbra' THEN 0.03 ELSE 0 END + CASE WHEN mixed AND w = 'name_in_title' THEN -0.03 WHEN mixed AND w LIKE 'dominant%' THEN -0.08 ELSE 0 END + CASE WHEN mixed AND dens < 1 THEN -0.08 ELSE 0 END + CASE WHEN c = 'mono_mixed' AND NOT links AND NOT target THEN -0.1 ELSE 0 END + CASE WHEN mixed AND t_seen THEN -0.05 ELSE 0 END
  + CASE WHEN c = 'bait' AND held AND NOT t_dom THEN -0.1 ELSE 0 END + CASE WHEN c = 'discredit' AND n >= 5000 THEN 0.05 ELSE 0 END + CASE WHEN c = 'discredit' AND td > 1 THEN -0.15 ELSE 0 END + CASE WHEN c = 'mono_target' AND NOT links THEN -0.08 ELSE 0 END + CASE WHEN c = 'mono_target' AND t_open THEN -0.12 ELSE 0 END
  + CASE WHEN c IN ('mono_unresolved', 'mono_no_ads') AND n < 1500 THEN -0.15 ELSE 0 END + CASE WHEN c = 'mono_no_ads' AND t_open THEN -0.1 ELSE 0 END + CASE WHEN c = 'multibrand' AND t_dom THEN -0.3 ELSE 0 END + CASE WHEN c = 'article' AND dens >= 1 THEN -0.1 ELSE 0 END + CASE WHEN mixed AND shared THEN -0.35 ELSE 0 END + CASE WHEN mixed AND template THEN -0.35 ELSE 0 END
  + CASE WHEN c NOT IN ('not_shown', 'dead', 'parked') AND block THEN -0.4 ELSE 0 END + CASE WHEN c NOT IN ('not_shown', 'stub', 'parked', 'dead', 'redirect_ref', 'redirect_other') AND t_html THEN -0.2 ELSE 0 END + CASE WHEN t_cloak THEN -0.04 ELSE 0 END + CASE WHEN (mixed OR c = 'mono_xlink') AND t_open THEN -0.03 ELSE 0 END AS d FROM s)
SELECT k, round(greatest(0.05, least(0.98, base + d)), 6) AS raw, (mixed AND dens < 1) AS few, (c NOT IN ('not_shown', 'dead', 'parked') AND block) AS blocked FROM x
""")
def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC23: the evidence score of every class and what lowers it."""
    on = {c: flag(*v) for c, v in SCORED.items()}
    other = F.filter(F.split(pick(0, 14, OTHERS), r"\|"), lambda x: x != "")
    links = F.transform(other, lambda x: F.struct(x.alias("name"), F.lit("https://l.example/").alias("url"), F.when(on["coded"], "https://f.example/").otherwise("").alias("final")))
    tags = F.concat(_list(on["t_open"], "ads_unverified"), _list(on["t_dom"], "brand_in_domain"), _list(on["t_html"], "no_html"), _list(on["t_cloak"], "cloaked:bot"), _list(on["t_seen"], "ads_search_only"))
    df = grid(spark, sf_dir).select(
        "k", pick(0, 2, CATEGORIES).alias("category"), pick(0, 8, WHYS).alias("why"), tags.alias("tags"), F.when(on["block"], "Access denied").otherwise("Shop").alias("title"), other.alias("other"), links.alias("other_links"), on["links"].cast("int").alias("target_links"), on["target"].alias("target"),
        pick(3, 2, (0.5, 2.0)).alias("density"), (number(3, 5, 8) * 1000).alias("text_len"), pick(3, 15, (0.0, 3.0)).alias("topic_density"), number(3, 9, 40).alias("feed_links"), on["shared"].alias("shared_tracker"), on["template"].alias("single_template"),
    )
    scored = scores.raw_score(df)
    return scored.select("k", F.round("raw", 6).alias("raw"), F.array_contains("minus", "few mentions").alias("few"), F.array_contains("minus", "a block page").alias("blocked"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_pick(0, 2, ("5_dead", "2_no_ads", "6_check"))} AS grp, {sql_number(0, 6, 5)} AS m, {sql_number(0, 10, 3)} * 500 AS n, {sql_pick(1, 2, ("Acme", "Shop"))} AS t FROM g)
SELECT k, grp AS "group", CASE WHEN n > 0 THEN round(m * 1000.0 / n, 2)::DOUBLE::VARCHAR ELSE '' END AS density, CASE WHEN n > 0 THEN n::VARCHAR ELSE '' END AS text_len, CASE WHEN grp <> '2_no_ads' THEN repeat('s', 200) ELSE '' END AS text_sample, 'Globex | Umbra' AS other_brands, 'a b' AS pids, t = 'Acme' AS brand_in_title, '' AS method, 40 AS n_columns,
  CASE WHEN t = 'Shop' THEN 'Shop' ELSE 'Acme' END AS title, 'a b' AS first, repeat('s', 250) AS sample, 22 AS n_kept FROM a
""")
def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1 to PRJ4: the table of groups, chains of titles and review records."""
    df = grid(spark, sf_dir).select(
        "k", F.concat(F.lit("d"), F.col("k").cast("string")).alias("domain"), pick(0, 2, ("5_dead", "2_no_ads", "6_check")).alias("group"), number(0, 6, 5).alias("mentions"), (number(0, 10, 3) * 500).alias("text_len"), pick(1, 2, ("Acme", "Shop")).alias("title"),
        F.array(F.lit("Globex"), F.lit("Umbra")).alias("other_brands"), F.array(F.lit("a"), F.lit("b")).alias("pids"), F.repeat(F.lit("s"), F.lit(250)).alias("text_sample"), F.lit("").alias("page_title"), F.lit(None).cast("string").alias("scan_title"),
    )
    flat = groups.group_rows(df)
    kept = sites.review_records(df).select("domain", F.col("text_sample").alias("sample"))
    title = df.select(F.col("domain").alias("_d"), "k", sites.first_text("page_title", "scan_title", "title").alias("chain"), F.array_join("pids", " ").alias("first"))
    j = flat.join(title, F.col("domain") == F.col("_d")).join(kept, "domain")
    return j.select("k", "group", "density", "text_len", "text_sample", "other_brands", "pids", "brand_in_title", "method", F.lit(len(flat.columns)).alias("n_columns"), F.col("chain").alias("title"), "first", "sample", F.lit(len(sites.KEPT)).alias("n_kept"))


@query(f"""
WITH g AS ({GRID}) SELECT k, {sql_pick(0, 2, ("bait", "stub", "article"))} AS shown_category, coalesce(nullif({sql_pick(1, 2, ("mono_other", "", None))}, ''), {sql_pick(0, 2, ("bait", "stub", "article"))}) AS category FROM g
""")
def rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HP6: the rules' own class beside the one that is shown."""
    df = grid(spark, sf_dir).select("k", pick(0, 2, ("bait", "stub", "article")).alias("category"), pick(1, 2, ("mono_other", "", None)).alias("rule_category"))
    return scores.rule_rows(df).select("k", "shown_category", "category")
