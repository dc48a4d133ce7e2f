"""Sites: one page out of two captures and a scan, its type, its status, its tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.functions import url as U
from tessera.operators.cascade import Rule, first_match, tags

_STRINGS = "array<string>"


def _has(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _number(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _union(a: Column, b: Column) -> Column:
    return F.array_union(F.coalesce(a, F.array().cast(_STRINGS)), F.coalesce(b, F.array().cast(_STRINGS)))


def merged_page(df: DataFrame, browser: str = "browser", plain: str = "plain", out: str = "page") -> DataFrame:
    """DC12: adds one page out of two captures (structs of one type, or null).

    A capture with an error is none. The one with the longer text wins, the browser's on a tie. Links are united by URL, the
    browser's first; gates, trackers and applications are united; flags are joined by or. The page is parked if the
    capture that stands says so and the browser's text is short.
    """
    b, h = (F.when(F.coalesce(F.col(c)["error"], F.lit("")) == "", F.col(c)) for c in (browser, plain))
    df = df.withColumns({"_b": b, "_h": h})
    b, h = F.col("_b"), F.col("_h")
    base = F.when(b.isNotNull() & (_number(b["text_len"]) >= _number(h["text_len"])), b).otherwise(F.coalesce(h, b))
    typed = dict(df.schema[browser].dataType.fieldNames() and [(f.name, f.dataType.simpleString()) for f in df.schema[browser].dataType.fields])
    links = F.concat(*[F.coalesce(x["aff_links"], F.array().cast(typed["aff_links"])) for x in (b, h)])
    urls = F.transform(links, lambda x: x["url"])
    first = F.filter(links, lambda x, i: F.array_position(urls, x["url"]) == i + 1)
    either = lambda name: _has(b[name]) | _has(h[name])
    page = base.withField("aff_links", first)
    for name in ("gates", "trackers"):
        page = page.withField(name, _union(b[name], h[name]))
    for name in ("shell", "pwa", "referrer_js", "assets", "front_title"):
        page = page.withField(name, either(name))
    offer = F.coalesce(F.nullif(b["pwa_offer"], F.lit("")), F.nullif(h["pwa_offer"], F.lit("")), F.lit(""))
    parked = _has(F.coalesce(b, h)["parked"]) & ~(_number(b["text_len"]) > 2000)
    page = page.withField("pwa_offer", offer).withField("apk", F.array_sort(_union(b["apk"], h["apk"]))).withField("parked", parked)
    return df.withColumn(out, F.when(base.isNotNull(), page)).drop("_b", "_h")


def from_scan(df: DataFrame, page: str = "page", scan: str = "scan", config: Config = DEFAULT) -> DataFrame:
    """DC13: a page whose saved text is less than half of what the scan saw, or that is a bot check, takes the scan's text
    length, mentions, title and brands (each counting 2); a bot check's own links and words go.

    scan: struct text_len, mentions, title, other_names, or null. The page gets from_scan. A missing page becomes one.
    """
    p, s = F.col(page), F.col(scan)
    n, m = _number(s["text_len"]), _number(s["mentions"])
    wall = p.isNotNull() & F.coalesce(p["title"].rlike(config.wall_title), F.lit(False))
    stays = s.isNull() | (p.isNotNull() & ~wall & (_number(p["text_len"]) >= F.greatest(n, F.lit(1)) * 0.5))
    title = F.coalesce(s["title"], F.lit(""))
    fields = {f.name: f.dataType.simpleString() for f in df.schema[page].dataType.fields}
    bare = p
    for name in ("aff_links", "topic_density", "topic_words", "slug_links", "date_links"):
        bare = bare.withField(name, F.when(~wall, p[name]).otherwise(F.lit(None).cast(fields[name])))
    names = F.transform(F.coalesce(s["other_names"], F.array().cast(_STRINGS)), lambda x: F.struct(x.alias("name"), F.lit(2).alias("n")))
    empty = F.struct(*[F.lit(None).cast(kind).alias(name) for name, kind in fields.items()])
    taken = F.coalesce(bare, empty)
    values = {
        "title": F.coalesce(F.nullif(title, F.lit("")), p["title"], F.lit("")),
        "text_len": n.cast(fields["text_len"]),
        "mentions": m.cast(fields["mentions"]),
        "density": F.when(n > 0, F.round(m * 1000.0 / n, 2)).otherwise(0.0),
        "in_title": title.rlike(config.brand),
        "in_h1": _has(p["in_h1"]),
        "other_brands": F.when(F.size(names) > 0, names.cast(fields["other_brands"])).otherwise(p["other_brands"]),
        "from_scan": F.lit(True),
    }
    for name, value in values.items():
        taken = taken.withField(name, value)
    nothing = (n == 0) & (m == 0) & (title == "")
    return df.withColumn(page, F.when(stays, p).when(nothing, F.when(p.isNotNull(), bare)).otherwise(taken))


def with_meta(df: DataFrame, page: str = "page", config: Config = DEFAULT) -> DataFrame:
    """DC13: a page of hardly any text is read from its meta fields, and marked from_meta."""
    p = F.col(page)
    meta = F.coalesce(p["meta_text"], F.lit(""))
    short = p.isNotNull() & (_number(p["text_len"]) < config.thresholds.meta_text) & (meta != "")
    read = p.withField("mentions", F.greatest(_number(p["mentions"]), _number(p["meta_mentions"]))).withField("in_title", _has(p["in_title"]) | meta.rlike(config.brand))
    read = read.withField("title", F.coalesce(F.nullif(p["title"], F.lit("")), F.substring(meta, 1, 120))).withField("from_meta", F.lit(True))
    return df.withColumn(page, F.when(short, read).otherwise(p))


def top_other(brands: Column) -> Column:
    """HP4: a struct of name and n of the competitor named most often, the first of equals; "" and 0 without one."""
    best = F.aggregate(F.coalesce(brands, F.array().cast("array<struct<name:string,n:int>>")), F.struct(F.lit("").alias("name"), F.lit(0).alias("n")), lambda a, x: F.when(x["n"] > a["n"], F.struct(x["name"].alias("name"), x["n"].cast("int").alias("n"))).otherwise(a))
    return best


def dominant_site(heads: Column, named: Column) -> Column:
    """HP5: most headings name the target: at least 3, and at least half of them."""
    return (_number(heads) > 0) & (_number(named) >= F.greatest(F.lit(3), F.floor(_number(heads) / 2)))


def site_flags(sites: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC15: the flags that its rules are made of, as a struct column f."""
    t, c = config.thresholds, F.col
    n, text, has = (lambda x: _number(c(x))), (lambda x: F.coalesce(c(x), F.lit(""))), (lambda x: _has(c(x)))
    named = lambda x: F.coalesce(x.rlike(config.brand), F.lit(False))
    other = top_other(c("other_brands"))
    head = F.concat_ws(" ", text("title"), text("h1"))
    trade_head = head.rlike(config.topic) | head.rlike(config.games)
    for _, rx in config.competitors:
        trade_head = trade_head | head.rlike(rx)
    extra = F.regexp_count(F.concat_ws(" ", head, text("text_sample"), text("meta_text")), F.lit(config.extra))
    lookalike = c("domain").rlike(config.not_brand) & (n("mentions") == 0)
    brand_domain = named(c("domain")) & ~lookalike
    in_domain = F.when(has("moved"), named(F.coalesce(F.nullif("host", F.lit("")), "domain"))).otherwise(named(c("domain"))) & ~lookalike
    df = sites.withColumns({"_o": other, "_th": trade_head, "_ex": extra, "_bd": brand_domain, "_id": in_domain})
    content = (n("topic_density") >= t.topic_density) | (n("topic_words") >= t.topic_words) | c("_th") | (F.regexp_count(text("text_sample"), F.lit(config.games)) >= t.sample_words) | (c("_ex") >= t.sample_words)
    some = lambda x: F.size(F.coalesce(c(x), F.array().cast(_STRINGS))) > 0
    brands = F.size(F.filter(F.coalesce("other_brands", F.array().cast("array<struct<name:string,n:int>>")), lambda x: x["n"] >= 1))
    in_head = has("in_title") | has("in_h1")
    dated = n("date_links") >= t.feed_dates
    dominant = (n("mentions") >= t.dominance * F.greatest(c("_o.n"), F.lit(1))) | ((n("mentions") > 0) & (c("_o.n") == 0))
    flags = {
        "brand_domain": c("_bd"), "in_domain": c("_id"), "in_head": in_head, "both_heads": has("in_title") & has("in_h1"), "title": named(text("title")),
        "mentions": n("mentions"), "density": F.coalesce("density", F.lit(0.0)), "other": c("_o.name"), "other_n": c("_o.n"), "brands": brands,
        "content": content, "trade": content | some("other_names") | some("plain_names"), "trade_head": c("_th"), "ad": has("target"), "other_ads": some("other_names"),
        "known_ads": F.exists(F.coalesce("other_names", F.array().cast(_STRINGS)), lambda x: ~x.startswith("via ") & ~x.contains(".")), "plain": some("plain_names"),
        "posts": (n("articles") > 0) | dated, "dated": dated, "feed": dated | ((n("articles") >= t.feed_articles) & (n("slug_links") >= t.article_links)),
        "ext": n("anchor_ext"), "internal": n("anchor_int"), "hidden": n("hidden_named"), "in_posts": n("in_posts"), "heads": n("heads_named"), "main": dominant_site(c("n_heads"), c("heads_named")),
        "dominant": dominant, "other_dominant": (c("_o.n") >= t.dominance * F.greatest(n("mentions"), F.lit(1))) & (c("_o.n") >= t.other_dominant),
        "topic": c("_th") | (n("topic_density") >= t.hacked_topic_density) | (brands > t.topic_brands), "meta": n("meta_mentions") > 0,
        "subject": (in_head | (n("meta_mentions") > 0)) & (F.coalesce("density", F.lit(0.0)) >= t.mono_density), "moved": has("moved"), "from_meta": has("from_meta"), "text_len": n("text_len"),
    }
    return df.withColumn("f", F.struct(*[v.alias(k) for k, v in flags.items()])).drop("_o", "_th", "_ex", "_bd", "_id")


def site_type(sites: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC15: adds site_type, site_type_why and site_type_rule: the class of an open site by its page and advertising.

    Columns: domain, host, moved, title, h1, text_sample, meta_text, text_len, mentions, density, in_title, in_h1,
    meta_mentions, n_heads, heads_named, other_brands (array of structs name, n), topic_density, topic_words, articles,
    date_links, slug_links, anchor_ext, anchor_int, hidden_named, in_posts, from_meta; target, other_names, plain_names.
    The typed domain (brand_domain) and the one a site moved to (in_domain) are judged apart. Nulls count as none.
    """
    t, df = config.thresholds, site_flags(sites, config)
    f = lambda name: F.col(f"f.{name}")
    none = f("mentions") == 0
    quiet = ~f("in_domain") & ~f("in_head")
    stays = f("in_domain") & ~f("moved")
    foreign = (f("other_n") > 0) | f("other_ads") | f("plain")
    nowhere = none & (f("ext") == 0) & (f("internal") == 0) & ~f("in_domain") & ~f("in_head") & ~f("ad")
    in_links = (f("ext") > 0) & (f("mentions") <= F.greatest(f("ext"), F.lit(t.hacked_max_text)) + 2)
    content = F.concat(F.lit("content="), F.coalesce(F.nullif(f("other"), F.lit("")), F.lit("other")), F.lit(":"), f("other_n"), F.lit(" target="), f("mentions"))
    density = F.concat(F.lit("dominant density="), f("density"))
    rules = [
        Rule("bait", f("in_domain") & f("from_meta") & ~f("ad"), "meta only"),
        Rule("bait", f("brand_domain") & f("moved") & none & ~f("ad") & (f("trade") | f("other_ads")), F.concat(F.lit("moves to "), F.coalesce("host", F.lit("")))),
        Rule("other_topic", nowhere & (f("content") | f("known_ads")), "no mention"),
        Rule("unrelated", nowhere, "no mention"),
        Rule("article", f("dated") & quiet & (f("hidden") == 0) & ~f("subject") & ~f("ad"), "dated feed"),
        Rule("hacked", (f("hidden") >= t.hidden_links) & ~f("trade_head") & ~f("in_domain") & ~f("subject"), F.concat(F.lit("hidden links="), f("hidden"))),
        Rule("hacked", ~f("topic") & ~f("in_domain") & ~f("subject") & ((f("hidden") > 0) | in_links), "links without topic"),
        Rule("hacked", f("in_head") & ~f("in_domain") & ~f("content") & ~f("subject") & (f("text_len") >= t.head_text) & ~f("ad") & ~f("both_heads"), "head only"),
        Rule("article", ~f("topic") & ~f("in_domain") & ~f("ad") & ~f("subject") & ((f("in_posts") > 0) | ((f("internal") > 0) & f("posts"))), "posts"),
        Rule("bait", (f("in_domain") | (f("title") & (f("brands") < t.title_brands) & f("content"))) & foreign & (f("other_dominant") | (f("content") & none & ~f("ad"))), content),
        Rule("mono", (f("in_domain") | f("in_head")) & f("dominant") & ((f("density") >= t.mono_density / 2) | (f("in_head") & f("ad"))), F.when(f("in_domain"), "name_in_domain").otherwise("name_in_title")),
        Rule("article", quiet & f("feed") & ~f("main") & ~f("ad") & ~f("subject"), "dated feed before density"),
        Rule("mono", f("dominant") & (f("density") >= t.mono_density) & f("trade") & (f("heads") >= t.named_heads) & (f("ext") * 2 <= f("mentions")), density),
        Rule("article", quiet & f("feed") & ~f("main") & ~(f("meta") & (f("density") >= t.mono_density)), "dated feed"),
        Rule("bait", stays & f("content") & foreign, content),
        Rule("bait", stays & ~f("ad") & (f("from_meta") | (f("content") & none)), "never names the target"),
        Rule("mono", stays & (f("content") | f("ad") | (f("trade") & ~none)), "name_in_domain"),
        Rule("bait", stays & f("other_ads") & none, content),
        Rule("discredit", stays & ~f("content") & (f("text_len") >= t.discredit_text), "off the topic"),
        Rule("other_topic", f("trade") & none & (f("ext") == 0) & (f("internal") == 0) & ~f("ad") & ~f("in_head"), "meta alone"),
        Rule("article", f("ad") & quiet & ~f("trade") & ~f("subject"), "own topic"),
        Rule("other_topic", f("trade") & (f("other_n") == 0) & (f("mentions") <= 1) & (f("ext") == 0) & (f("internal") == 0) & ~f("in_head"), "one mention"),
        Rule("multibrand", f("trade"), content),
        Rule("article", ~f("in_domain") & ((f("internal") > 0) | f("posts")), "posts off the topic"),
        Rule("discredit", f("in_domain") & none & (f("text_len") >= t.discredit_text), "domain alone"),
        Rule("stub", f("in_domain") & none, F.concat(F.lit("text_len="), f("text_len"))),
    ]
    return first_match(df, rules, "unclear", "site_type").drop("f")


def mono_subtype(target: Column, other: Column, plain: Column, unverified: Column, gates: Column, trackers: Column, mode: Column, group: Column, incomplete: Column) -> Column:
    """DC16: by whom a site about the target advertises: others (with the target's or without); nobody, if a browser
    clicked everything; unresolved, if buttons lead where nobody followed; plain links; the target; nobody."""
    some = lambda c: F.size(F.coalesce(c, F.array())) > 0
    t = _has(target)
    clicked = _has(mode.isin("browser", "browser+rest") & group.isin("2_no_ads", "8_no_mention")) & ~some(incomplete)
    return (
        F.when(some(other), F.when(t, "mono_mixed").otherwise("mono_other"))
        .when(clicked & ~t & ~some(plain), "mono_no_ads")
        .when(~t & (some(gates) | some(trackers) | (_number(unverified) > 0)), "mono_unresolved")
        .when(some(plain), "mono_xlink")
        .when(t, "mono_target")
        .otherwise("mono_no_ads")
    )


#: DC18, fixed values: groups and words of a scan's history that show a site once opened.
HIDDEN_GROUPS = ("5_not_shown", "6_check")
OPENED_BEFORE = r"5_not_shown|6_check|_only|no_ads|mixed|no_mention|unresolved"
SETTLED = ("dead", "parked", "not_shown", "stub", "mirror")
#: DC18, fixed values: classes that need no evidence of inner pages.
STRIKES = ("mono_other", "mono_mixed", "bait", "redirect_other", "discredit")


def site_status(sites: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC18: adds status, status_why and status_rule; the default open is judged by site_type.

    Columns: redirect, redirect_why (DC17), group, group_history, reason, http_status (text) and scan_title, scan_text of the
    scan; home_group of the home dump; has_page, has_features, from_scan, title, text_len, text_sample, final_url, parked,
    shell, assets, mentions of the page; target, other_names.
    """
    t, c = config.thresholds, F.col
    text = lambda name: F.coalesce(name, F.lit(""))
    group, reason, code = text("group"), text("reason"), text("http_status")
    dead, hidden = group == "5_dead", group.isin(*HIDDEN_GROUPS)
    n, page = _number(c("text_len")), _has(c("has_page"))
    real = page & (n >= t.real_text) & ~_has(c("from_scan"))
    others = F.size(F.coalesce("other_names", F.array().cast(_STRINGS))) > 0
    bare = (n < t.stub_text) & (_number(c("mentions")) == 0) & ~_has(c("target")) & ~others
    no_answer = text("home_group") == "no_answer"
    parking = _has(c("parked")) | F.concat_ws(" ", text("title"), text("text_sample"), text("final_url")).rlike(config.parked)
    front = _has(c("shell")) | (_has(c("assets")) & text("title").rlike(config.mirror_name))
    filler = F.concat_ws(" ", text("title"), F.substring(text("text_sample"), 1, 300), text("final_url")).rlike(config.placeholder)
    rules = [
        Rule("redirect", c("redirect").isNotNull(), c("redirect_why")),
        Rule("not_shown", dead & (reason != "parked") & text("group_history").rlike(OPENED_BEFORE), F.concat(F.lit("answered earlier: "), text("group_history"))),
        Rule("stub", dead & reason.isin("empty_page", "empty_response") & (code == "200"), "empty answer"),
        Rule("parked", dead & ~real & (reason == "parked"), "parked"),
        Rule("dead", dead & ~real, reason),
        Rule("stub", hidden & F.concat_ws(" ", text("scan_title"), text("scan_text")).rlike(config.placeholder), "placeholder of the host"),
        Rule("not_shown", hidden, reason),
        Rule("not_shown", page & text("title").rlike(config.wall_title) & (n < t.parked_text), "bot check"),
        Rule("dead", ~_has(c("has_features")) & no_answer, "no answer"),
        Rule("dead", ~page & no_answer, "no page"),
        Rule("stub", ~page, "no page"),
        Rule("parked", parking & ~others & (n < t.parked_text), "parking markup"),
        Rule("mirror", front & ((_number(c("mentions")) <= t.mirror_mentions) | (n < t.mirror_text)), F.when(_has(c("shell")), "shell").otherwise("assets and title")),
        Rule("stub", filler & (n < t.placeholder_text) & ~_has(c("target")) & ~others, "placeholder text"),
        Rule("not_shown", bare & code.rlike(r"^[45]\d\d$"), F.concat(F.lit("http_"), code)),
        Rule("stub", bare, F.concat(F.lit("text_len="), n)),
    ]
    return first_match(sites, rules, "open", "status")


def hidden_override(category: Column, why: Column, plain_hosts: Column, hidden: Column, other: Column) -> tuple[Column, Column]:
    """DC18: a site about the target whose plain links to the trade are hidden is mono_hidden: category and why."""
    met = F.array_sort(F.array_intersect(F.coalesce(plain_hosts, F.array().cast(_STRINGS)), F.coalesce(hidden, F.array().cast(_STRINGS))))
    hit = category.startswith("mono_") & (F.size(F.coalesce(other, F.array().cast(_STRINGS))) == 0) & (F.size(met) > 0)
    return F.when(hit, "mono_hidden").otherwise(category), F.when(hit, F.concat(why, F.lit(" | hidden links to "), F.array_join(F.slice(met, 1, 3), ", "))).otherwise(why)


def evidence_override(category: Column, brands: Column, target: Column) -> Column:
    """DC18, HT10: advertising found on inner pages; settled violations are left alone."""
    some = (F.size(F.coalesce(brands, F.array().cast(_STRINGS))) > 0) & ~category.isin(*STRIKES)
    return F.when(some & category.startswith("mono_"), F.when(_has(target), "mono_mixed").otherwise("mono_other")).when(some & ~category.isin(*SETTLED), "page_other").otherwise(category)


#: DC19, fixed values: visitors whose advertising others do not see, and their tags.
VISITOR_TAGS = (("mobile", "ads_mobile_only"), ("search_mobile", "ads_search_only"))


def visitor_tags(base: Column, seen: dict[str, Column]) -> Column:
    """DC19: tags of the visitors to whom a site shows advertisers (array) that the plain visitor does not see."""
    none = F.array().cast(_STRINGS)
    return tags([(tag, F.size(F.array_except(F.coalesce(seen[v], none), F.coalesce(base, none))) > 0) for v, tag in VISITOR_TAGS if v in seen])


def site_tags(config: Config = DEFAULT) -> Column:
    """DC19: tags of a site in order, over columns domain, visitor_tags (array), cloaked (the visitor that got a page, or ""),
    pwa, platform, ads_differ, referrer_js, apk (array), ours, host, final_url, unverified, has_page."""
    c = F.col
    final = F.coalesce(F.nullif("host", F.lit("")), U.hostname(F.coalesce("final_url", F.lit(""))))
    moved = (final != "") & ~U.same_site(U.base_host(final), U.base_host(c("domain")))
    own = tags(
        [
            ("pwa", c("pwa")),
            ("platform", c("platform")),
            ("rotating_ads", c("ads_differ")),
            ("search_referrer_js", c("referrer_js")),
            ("apk", F.size(F.coalesce("apk", F.array().cast(_STRINGS))) > 0),
            ("our_ref", c("ours")),
            ("brand_in_domain", c("domain").rlike(config.brand)),
            ("moved", moved),
            ("ads_unverified", _number(c("unverified")) > 0),
            ("no_html", ~_has(c("has_page"))),
        ]
    )
    cloaked = F.when(F.coalesce("cloaked", F.lit("")) != "", F.array(F.concat(F.lit("cloaked:"), c("cloaked")))).otherwise(F.array().cast(_STRINGS))
    return F.concat(F.coalesce("visitor_tags", F.array().cast(_STRINGS)), cloaked, own)


def best_visitor(df: DataFrame, key: str = "domain", config: Config = DEFAULT) -> DataFrame:
    """WN11: of captures by several visitors (domain, visitor, visitor_no, group, title, text_len) the one that got a real
    page: by how open its group is, then the visitor that comes first; bot checks and closed groups are none."""
    rank = {"4_mixed": 6, "3_other_only": 5, "1_target_only": 4, "0_frontend": 3, "2_no_ads": 2, "7_unresolved": 2, "8_no_mention": 2, "needs_browser": 1}
    opened = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in rank.items() for v in kv]), F.col("group")), F.lit(0))
    opened = F.when(F.coalesce("title", F.lit("")).rlike(config.wall_title), 0).otherwise(opened)
    from tessera.operators.keyed import best_variant

    ranked = df.withColumn("_rank", opened).withColumn("_first", -F.col("visitor_no")).filter("_rank > 0")
    return best_variant(ranked, key, ["_rank", "_first", "text_len"]).drop("_rank", "_first")


def first_text(*names: str) -> Column:
    """PRJ1: the first column that holds a text that is not empty, else ""."""
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in names], F.lit(""))


#: PRJ2, fixed values: the columns of a review record, in order.
KEPT = (
    "domain", "category", "tags", "why", "target_ads", "other_ads", "plain_links", "ad_links", "mentions", "density", "anchors", "hidden_named",
    "text_len", "topic_density", "other_brands_text", "feed_links", "title", "h1", "lang", "final_url", "scan_group", "source",
)


def review_records(rows: DataFrame) -> DataFrame:
    """PRJ2: the kept columns ("" where one is missing), a shortened text sample and the first ten links, gates, trackers."""
    have = set(rows.columns)
    kept = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in KEPT]
    lists = [F.slice(F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)), 1, 10).alias(c) for c in ("aff_links", "gates", "trackers") if c in have]
    return rows.select(*kept, F.substring(F.coalesce("text_sample", F.lit("")), 1, 600).alias("text_sample"), *lists)


def brand_counts(brands: Column, k: int = 6) -> Column:
    """PRJ1, TK5: name:n of the competitors named most often, first the largest, ties in their order."""
    order = F.transform(brands, lambda x, i: F.struct((-x["n"]).alias("m"), i.alias("i"), x["name"].alias("name"), x["n"].alias("n")))
    return F.array_join(F.transform(F.slice(F.array_sort(order), 1, k), lambda x: F.concat(x["name"], F.lit(":"), x["n"].cast("string"))), " ")
