"""Evidence of advertising: whom a site's destinations, referral row, follow chains and page links lead to.

Every source becomes rows (domain, source, ordinal) whose verdict is a cascade; one fold per domain joins them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.functions import url as U
from tessera.operators.cascade import Rule, first_match
from tessera.operators.decisions import brand_of_host

TRADE_KINDS = ("other", "topic_site")
OPEN_KINDS = ("unknown", "needs_browser", "dead")
#: A link copied out of JSON, its partner code cut at the escape.
ESCAPED = "\\u0026"
_NONE = "array<string>"


def _text(name: str) -> Column:
    return F.coalesce(name, F.lit(""))


def _hops() -> Column:
    return F.coalesce("hops", F.array().cast(_NONE))


def _marked(u: Column, config: Config) -> Column:
    return F.coalesce(U.has_affiliate_params(u, config) | U.has_tracker_params(u, config), F.lit(False))


def tracker_hosts(dests: DataFrame, scanned: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """AG13: host: hosts of links and hops that lead to the target's referral pages and never to the trade's others, that do
    not name the target and are no sites of the base themselves.

    dests: url, final_url, kind, pid, hops. scanned: domain.
    """
    final = _text("final_url")
    own = ((F.col("kind") == "target") & ((_text("pid") != "") | final.rlike(r"pid=") | U.ref_host(U.url_host(final), config))) | (U.ref_host(U.url_host(final), config) & final.contains("pid="))
    led = F.when(own, F.lit(True)).when(F.col("kind").isin(*TRADE_KINDS), F.lit(False))
    hosts = F.array_distinct(F.transform(F.concat(F.array(_text("url")), _hops()), U.url_host))
    rows = dests.select(led.alias("t"), F.explode(F.array_remove(F.array_remove(hosts, ""), U.url_host(final))).alias("host")).filter("t IS NOT NULL")
    sides = rows.groupBy("host").agg(F.bool_and("t").alias("only")).filter("only").select("host").filter(~F.col("host").rlike(config.brand))
    return sides.join(scanned.select(U.base_host(F.col("domain")).alias("host")).distinct(), "host", "left_anti")


def _with_tracker(df: DataFrame, host: Column, trackers: DataFrame) -> DataFrame:
    known = trackers.select(F.col("host").alias("_t")).distinct()
    return df.withColumn("_h", host).join(known, F.col("_h") == F.col("_t"), "left").withColumn("_tracker", F.col("_t").isNotNull()).drop("_h", "_t")


#: Columns of a URL's parts that several rules ask for: host name, path and query; the host without www; the kind of referral
#: link and whether it is the target's.
_PARTS = ("_parts", "_host", "_ref", "_brand_ref")


def _with_parts(df: DataFrame, url: Column) -> DataFrame:
    """Columns of a URL's parts, each made once: rules that are written over the URL itself repeat its patterns until the code
    of a row is larger than what the JVM compiles."""
    df = df.withColumn("_parts", U.parts(url))
    return df.withColumn("_host", F.regexp_replace(F.col("_parts.host"), r"^www\.", ""))


def _with_ref(df: DataFrame, url: Column, config: Config) -> DataFrame:
    """UR13, UR14 of a URL whose parts are there, as of U.brand_ref."""
    df = df.withColumn("_ref", U.classify_ref(url, F.col("domain"), config, F.col("_parts")))
    return df.withColumn("_brand_ref", F.coalesce(F.col("_ref").isin("known_ref_host", "brand_host") | ((F.col("_ref") == "ref") & U.ref_host(F.col("_host"), config)), F.lit(False)))


def destination_verdicts(dests: DataFrame, trackers: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC14, JN12: adds side (target, other, plain, unverified or none), name and side_why to destinations.

    dests: domain, ordinal, url, final_url, via, kind, brand, evidence, pid, ad_route, hops; live, if there: whether a URL
    found in a script stands outside its comments. trackers: host, any number of them.
    """
    url, final, via, kind, evidence, brand = _text("url"), _text("final_url"), _text("via"), F.col("kind"), _text("evidence"), _text("brand")
    df = _with_tracker(_with_ref(_with_parts(dests, url), url, config), F.col("_host"), trackers)
    df = df.withColumns({"_to": U.url_host(final), "_coded": U.is_coded(F.concat(F.array(url, final), _hops()), config), "_passed": U.via_tracker(url, final, _hops())})
    df = df.withColumn("_by_host", brand_of_host(F.col("_to"), config))
    host, to, coded, passed = F.col("_host"), F.col("_to"), F.col("_coded"), F.col("_passed")
    live = F.coalesce("live", F.lit(True)) if "live" in dests.columns else F.lit(True)
    script, trade, open_ = via.startswith("js:"), kind.isin(*TRADE_KINDS), kind.isin(*OPEN_KINDS)
    known, by_host = ~brand.isin("", "?"), F.col("_by_host")
    operator = ~by_host.isin("", config.brand_name)
    business = ~to.rlike(config.not_trade_hosts)
    end = F.coalesce(F.nullif(to, F.lit("")), host)
    rules = [
        Rule("none", via == "home_redirect", "own move"),
        Rule("none", U.path_shapes(url)["bare_gate"] & script, "bare gate"),
        Rule("none", F.lower(F.regexp_replace(url, r"\?.*$", "")).endswith(".apk") | (kind == "download") | evidence.startswith("download"), "download"),
        Rule("none", kind.isin(*OPEN_KINDS, "off_topic") & host.rlike(config.brand) & (F.col("_parts.query") == ""), "sister site"),
        Rule("none", via.startswith("js:data-modal"), "demo window"),
        Rule("none", url.contains(ESCAPED), "escaped copy"),
        Rule("none", script & trade & ~live, "comment"),
        Rule("target", F.col("_tracker") & ~trade, "tracker"),
        Rule("target", F.col("_brand_ref"), "referral"),
        Rule("target", (kind == "target") & ((_text("pid") != "") | coded | (passed & (evidence != "name_only"))), "landing"),
        Rule("none", kind == "target", "plain landing"),
        Rule("other", trade & (coded | passed), "route"),
        Rule("other", (kind == "other") & known & operator & business, "operator"),
        Rule("none", trade & host.rlike(config.brand), "sister site moves"),
        Rule("plain", (kind == "other") & business, "named elsewhere"),
        Rule("none", kind == "other", "no business"),
        Rule("other", (kind == "topic_site") & operator & business, "named host"),
        Rule("plain", (kind == "topic_site") & business, "no name"),
        Rule("target", open_ & coded & U.ref_host(end, config), "referral host"),
        Rule("other", open_ & coded & ~end.rlike(config.brand), "coded"),
        Rule("unverified", open_ & (passed | F.coalesce("ad_route", F.lit(False))), "open"),
    ]
    out = first_match(df, rules, "none", "side")
    why = F.col("side_why")
    name = (
        F.when(F.col("side") == "target", config.brand_name)
        .when(why == "route", F.when(known, brand).otherwise(F.coalesce(F.nullif(U.hostname(final), F.lit("")), F.lit("?"))))
        .when(why == "operator", brand)
        .when(why == "named host", by_host)
        .when(F.col("side") == "plain", F.when(F.col("kind") == "topic_site", U.hostname(final)).otherwise(to))
        .when(why == "coded", end)
        .otherwise("")
    )
    return out.withColumn("name", name).drop("_tracker", "side_rule", "_to", "_coded", "_passed", "_by_host", *_PARTS)


def referral_verdicts(rows: DataFrame, trackers: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC14: side, name of a site's referral row (domain, ref_url): the owner's registry, the target, or a tracker."""
    ref = _text("ref_url")
    df = _with_tracker(_with_parts(rows, ref), F.col("_host"), trackers)
    own = U.ref_key(ref).isin(list(config.own_refs)) if config.own_refs else F.lit(False)
    df = _with_ref(df, ref, config).withColumn("_sends", U.looks_tracker(ref, config, F.col("_parts")))
    target = F.col("_brand_ref") | F.col("_host").rlike(config.brand)
    df = df.withColumn("side", F.when(own, "ours").when(target, "target").when(F.col("_sends"), F.when(F.col("_tracker"), "target").otherwise("other")).otherwise("none"))
    df = df.withColumn("_named", brand_of_host(F.col("_host"), config))
    name = F.when(F.col("side").isin("ours", "target"), config.brand_name).when(F.col("side") == "other", F.coalesce(F.nullif("_named", F.lit("")), F.concat(F.lit("via "), F.col("_host")))).otherwise("")
    return df.withColumn("name", name).drop("_tracker", "_sends", "_named", *_PARTS)


def chain_verdicts(chains: DataFrame, trackers: DataFrame, titled: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC14: side, name, url and final_url of follow chains (domain, ordinal, found, chain: array of URLs, last_status).

    Chains that found a referral or never left count nothing, nor do those over hosts that are no advertising. titled: host
    of pages whose title names the target.
    """
    left = F.transform(F.slice("chain", 2, F.greatest(F.size("chain"), F.lit(1))), U.url_host)
    hosts = F.filter(left, lambda h: (h != "") & ~U.same_site(h, U.base_host(F.col("domain"))) & ~h.startswith("challenge."))
    df = chains.withColumn("_hosts", hosts).withColumn("_id", F.struct("domain", "ordinal"))
    known = titled.select(F.col("host").alias("_x")).distinct()
    met = df.select("_id", F.explode("_hosts").alias("_x")).join(known, "_x", "left_semi").select(F.col("_id").alias("_m")).distinct()
    df = df.join(met, F.col("_id") == F.col("_m"), "left")
    first = F.coalesce(F.try_element_at("_hosts", F.lit(1)), F.lit(""))
    df = _with_tracker(df, first, trackers)
    names = F.filter(F.transform("_hosts", lambda h: brand_of_host(h, config)), lambda n: n != "")
    named = F.coalesce(F.try_element_at(names, F.lit(1)), F.when(F.col("_m").isNotNull(), config.brand_name).otherwise(""))
    coded = F.exists("chain", lambda u: _marked(u, config))
    step = F.coalesce(F.try_element_at("chain", F.lit(2)), F.lit(""))
    rules = [
        Rule("none", F.col("found").isNotNull() | (F.size("chain") < 2) | (F.size("_hosts") == 0), "no chain"),
        Rule("none", F.exists("_hosts", lambda h: h.rlike(config.not_ad_hosts)), "no advertising"),
        Rule("target", (named == config.brand_name) & (coded | F.exists("_hosts", lambda h: U.ref_host(h, config))), "referral"),
        Rule("none", named == config.brand_name, "doorways"),
        Rule("other", named != "", "named"),
        Rule("other", coded & (F.col("last_status") == 200), "coded"),
        Rule("target", ~U.ref_host(first, config) & ~first.rlike(config.brand) & U.looks_tracker(step, config) & F.col("_tracker"), "tracker"),
        Rule("other", ~U.ref_host(first, config) & ~first.rlike(config.brand) & U.looks_tracker(step, config), "foreign tracker"),
    ]
    out = first_match(df, rules, "unverified", "side")
    why = F.col("side_why")
    name = F.when(F.col("side") == "target", config.brand_name).when(why == "named", named).when(why == "coded", F.try_element_at("_hosts", F.lit(-1))).when(why == "foreign tracker", F.concat(F.lit("via "), first)).otherwise("")
    return out.withColumns({"name": name, "url": step, "final_url": F.coalesce(F.try_element_at("chain", F.lit(-1)), F.lit(""))}).drop("_hosts", "_id", "_m", "_tracker", "side_rule")


def link_verdicts(links: DataFrame, trackers: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC14: side, name of referral-like links of a page (domain, ordinal, url, host, brand, ref_kind, scanned: whether a
    scan followed the site's links; live as for destinations)."""
    url, host, brand, kind = _text("url"), _text("host"), _text("brand"), _text("ref_kind")
    df = _with_ref(_with_parts(links, url), url, config)
    df = _with_tracker(df, F.regexp_replace(F.coalesce(F.nullif(host, F.lit("")), F.col("_host")), r"^www\.", ""), trackers)
    own = U.ref_key(url).isin(list(config.own_refs)) if config.own_refs else F.lit(False)
    live = F.coalesce("live", F.lit(True)) if "live" in links.columns else F.lit(True)
    q = F.col("_parts.query")
    df = df.withColumn("_params", q.rlike(config.affiliate_params) | q.rlike(config.tracker_params) | q.rlike(config.code_params))
    params = F.col("_params")
    rules = [
        Rule("none", url.contains(ESCAPED) | ~live, "copy"),
        Rule("target", F.col("_tracker"), "tracker"),
        Rule("ours", own, "registry"),
        Rule("target", (brand == config.brand_name) | ((kind != "") & F.col("_brand_ref")), "referral"),
        Rule("other", kind != "", "shape"),
        Rule("other", brand != "", "named"),
        Rule("none", params & (host.rlike(config.brand) | U.ref_host(host, config)), "own host"),
        Rule("other", params, "coded"),
        Rule("unverified", ~F.coalesce("scanned", F.lit(False)), "open"),
    ]
    out = first_match(df, rules, "none", "side")
    why = F.col("side_why")
    name = F.when(F.col("side").isin("target", "ours"), config.brand_name).when(why == "shape", F.concat(F.lit("via "), host)).when(why == "named", brand).when(why == "coded", F.coalesce(F.nullif(host, F.lit("")), F.lit("?"))).otherwise("")
    return out.withColumn("name", name).drop("_tracker", "side_rule", "_params", *_PARTS)


def verdict_rows(destinations: DataFrame, referrals: DataFrame | None = None, chains: DataFrame | None = None, links: DataFrame | None = None) -> DataFrame:
    """The verdicts of all sources in order: domain, source, ordinal, side, name, url, final_url."""

    def rows(df: DataFrame, source: int, url: str, final: Column, ordinal: Column) -> DataFrame:
        return df.select("domain", F.lit(source).alias("source"), ordinal.cast("long").alias("ordinal"), "side", "name", _text(url).alias("url"), final.alias("final_url"))

    out = rows(destinations, 1, "url", _text("final_url"), F.col("ordinal"))
    if referrals is not None:
        out = out.union(rows(referrals, 2, "ref_url", F.lit(""), F.lit(0)))
    if chains is not None:
        out = out.union(rows(chains, 3, "url", _text("final_url"), F.col("ordinal")))
    return out if links is None else out.union(rows(links, 4, "url", F.lit(""), F.col("ordinal")))


def ads(verdicts: DataFrame, incomplete: DataFrame | None = None, most: int = 6) -> DataFrame:
    """DC14, DC21: per domain target, other and plain (sorted names), unverified, ours, and links: JSON of [side, name, url,
    final] of the first link of each side and name, other before target before plain, at most six.

    verdicts: as of verdict_rows. incomplete: domain of sites whose scan left links open; each counts one unverified.
    """
    v = verdicts
    if incomplete is not None:
        more = incomplete.select("domain").distinct()
        v = v.unionByName(more.select("domain", F.lit(0).alias("source"), F.lit(0).cast("long").alias("ordinal"), F.lit("unverified").alias("side"), F.lit("").alias("name"), F.lit("").alias("url"), F.lit("").alias("final_url")))
    #: The verdicts are gone through once: rows of a domain with the same side and name fall together before the shuffle.
    side = F.when(F.col("side") == "other", 1).when(F.col("side") == "target", 2).when(F.col("side") == "plain", 3)
    link = F.when(side.isNotNull() & (F.col("url") != ""), F.struct("source", "ordinal", "url", "final_url"))
    kinds = v.groupBy("domain", "side", "name").agg(F.count("*").alias("_n"), F.min(link).alias("f"))
    place = F.when(F.col("f").isNotNull(), F.struct(side.alias("_side"), F.col("f.source").alias("source"), F.col("f.ordinal").alias("ordinal"), "side", "name", F.col("f.url").alias("url"), F.col("f.final_url").alias("final")))
    is_ = lambda s: F.col("side") == s
    names = lambda s: F.array_sort(F.collect_set(F.when(is_(s) & (F.col("name") != ""), F.col("name"))))
    unverified = F.coalesce(F.sum(F.when(is_("unverified"), F.col("_n"))), F.lit(0).cast("long"))
    per = kinds.groupBy("domain").agg((F.count_if(F.col("side").isin("target", "ours")) > 0).alias("target"), names("other").alias("other"), names("plain").alias("plain"), unverified.alias("unverified"), (F.count_if(is_("ours")) > 0).alias("ours"), F.array_sort(F.collect_list(place)).alias("_l"))
    shown = F.transform(F.slice("_l", 1, most), lambda x: F.array(x["side"], x["name"], x["url"], F.when(x["final"] == x["url"], "").otherwise(x["final"])))
    return per.withColumn("links", F.when(F.size("_l") > 0, F.to_json(shown)).otherwise("")).drop("_l")


def page_evidence(resources: DataFrame, dests: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """HT10, JN13: per domain the brands that pages about the target advertise, and the first such page.

    resources: domain, ordinal, page (its URL), title (title and h1 as one text), links (array of structs url, hidden) and
    script_urls (array). A page is about the target if its title names it and no competitor. A link counts by what was found
    behind it (dests: domain, url, final_url, kind, brand, hops) or by an operator's host; links inside the site only by what
    was found, hidden ones never.
    """
    rival = F.lit(False)
    for _, rx in config.competitors:
        rival = rival | F.col("title").rlike(rx)
    about = resources.filter(F.col("title").rlike(config.brand) & ~rival)
    anchors = about.select("domain", "ordinal", "page", F.explode(F.filter("links", lambda x: ~F.coalesce(x["hidden"], F.lit(False)))).alias("l")).select("domain", "ordinal", "page", F.col("l.url").alias("link"), F.lit(False).alias("script"))
    scripts = about.select("domain", "ordinal", "page", F.explode(F.array_distinct("script_urls")).alias("link"), F.lit(True).alias("script"))
    links = anchors.union(scripts).distinct().withColumn("host", U.url_host(F.col("link")))
    own = U.same_site(F.col("host"), U.url_host(F.col("page"))) | U.same_site(F.col("host"), U.base_host(F.col("domain")))
    links = links.withColumn("own", own).filter("host <> '' AND NOT (script AND own)").filter(~F.col("script") | ~F.col("host").rlike(config.not_trade_hosts))
    d = dests.select(F.col("domain").alias("_d"), F.col("url").alias("_u"), _text("final_url").alias("_f"), "kind", _text("brand").alias("brand"), _hops().alias("hops"))
    j = links.join(d, (F.col("domain") == F.col("_d")) & (F.col("link") == F.col("_u")), "left")
    end = U.url_host(F.col("_f"))
    by_end, by_host = brand_of_host(end, config), brand_of_host(F.col("host"), config)
    routed = F.col("kind").isin(*TRADE_KINDS) & (U.is_coded(F.concat(F.array("link", "_f"), F.col("hops")), config) | U.via_tracker(F.col("link"), F.col("_f"), F.col("hops")))
    found = F.when(routed, F.when(F.col("brand").isin("", "?"), end).otherwise(F.col("brand"))).when(~F.col("script") & (F.col("kind") == "other") & ~by_end.isin("", config.brand_name), F.coalesce(F.nullif("brand", F.lit("")), by_end))
    named = F.when(~F.col("own") & ~by_host.isin("", config.brand_name) & ~F.col("host").rlike(config.not_trade_hosts), by_host)
    brands = j.select("domain", "ordinal", "page", F.explode(F.array_compact(F.array(found, named))).alias("b")).filter("b <> ''")
    return brands.groupBy("domain").agg(F.array_sort(F.collect_set("b")).alias("brands"), F.min(F.struct("ordinal", "page"))["page"].alias("page"))
