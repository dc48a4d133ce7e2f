"""Scan logs to site groups and inner pages: latest and history, destinations, queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.functions import text as T
from tessera.functions import url as U
from tessera.operators import decisions, groups, keyed, tables

_STRINGS = "array<string>"


def destinations(records: DataFrame) -> DataFrame:
    """D5: one row per destination of each record, with its place."""
    d = records.select("domain", "ts", "ordinal", F.posexplode("destinations").alias("place", "d"))
    return d.select("domain", "ts", "ordinal", "place", "d.*")


def pending_destinations(records: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """HP8: key, domain and url of destinations that need a browser, once each; the first site (by name) asks."""
    open_ = destinations(records).filter(F.col("kind") == "needs_browser").withColumn("key", U.dest_key(F.col("url"), F.col("domain"), config))
    return open_.groupBy("key").agg(F.min(F.struct("domain", "ordinal", "place", "url")).alias("f")).select("key", "f.domain", "f.url")


def dest_cache(results: DataFrame) -> DataFrame:
    """IN3: key, kind, brand and final_url of the last result per key (key, kind, brand, final_url, ordinal) that was decided:
    what is dead, internal or the owner's is tried again."""
    last = keyed.latest(results, ["key"], ["ordinal"])
    return last.filter(F.col("kind").isNotNull() & ~F.col("kind").isin("dead", "internal", "our_ref_skipped")).select("key", "kind", "brand", "final_url")


def fill_from_cache(dests: DataFrame, cache: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """JN8, IN3: undecided destinations take kind, brand and final URL from the cache of decided ones (one row per key)."""
    c = cache.filter(~F.col("kind").isin("dead", "internal", "our_ref_skipped")).groupBy(F.col("key").alias("_k")).agg(F.min(F.struct("kind", "brand", "final_url")).alias("_c"))
    j = dests.withColumn("_key", U.dest_key(F.col("url"), F.col("domain"), config)).join(c, F.col("_key") == F.col("_k"), "left")
    undecided = F.col("kind").isin("unknown", "needs_browser") & F.col("_k").isNotNull()
    filled = {n: F.when(undecided, F.col(f"_c.{n}")).otherwise(F.col(n)) for n in ("kind", "brand", "final_url")}
    return j.withColumns(filled).drop("_key", "_k", "_c")


def resolved_groups(dests: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """JN8: per domain the group of its filled destinations (domain, url, via, kind, brand): needs_browser while one that is
    shaped like advertising waits for a browser, with what the others say as undecided_group."""
    shaped = (F.col("kind") == "needs_browser") & (groups.ad_shaped(F.col("via")) | U.classify_ref(F.col("url"), F.col("domain"), config).isNotNull() | U.tracker_shaped(F.col("url")))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    live = dests.filter("kind <> 'internal'").groupBy("domain").agg(some(F.col("kind") == "target").alias("t"), some(F.col("kind") == "other").alias("o"), F.count_if(F.col("kind").isin(*groups.UNDECIDED)).alias("unresolved"), some(shaped).alias("pending"))
    own = groups.site_group(F.col("t"), F.col("o"))
    return live.select("domain", F.when(F.col("pending"), "needs_browser").otherwise(own).alias("group"), F.when(F.col("pending"), own).otherwise("").alias("undecided_group"), "unresolved")


def scan_report(records: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """E2: one row per domain: its group now, corrected by its history, with all brands ever seen.

    records: domain, ts, ordinal, mode, home (title, mentions, js_buttons), destinations. Records of equal time count in file
    order. Stored destinations are refined before they are grouped.
    """
    rows = destinations(records).withColumn("start_url", F.col("url")).withColumn("hops", F.transform("hops", lambda h: h["url"]))
    refined = decisions.refine(rows, config).filter("kind <> 'internal'")
    per_record = tables.site_group(refined.withColumn("_id", F.struct("domain", "ordinal")), "_id", "kind", "brand")
    more = refined.groupBy(F.struct("domain", "ordinal").alias("_m")).agg(F.array_sort(F.collect_set(F.when((F.col("kind") == "target") & (F.coalesce("pid", F.lit("")) != ""), F.col("pid")))).alias("pids"), F.count_if(F.col("kind").isin(*groups.UNDECIDED)).alias("unresolved"))
    own = records.select("domain", "ts", "ordinal", "mode", F.col("home.title").alias("title"), F.col("home.mentions").alias("mentions"), F.col("home.js_buttons").alias("js_buttons"), F.struct("domain", "ordinal").alias("_r"))
    per = own.join(per_record, F.col("_r") == F.col("_id"), "left").join(more, F.col("_r") == F.col("_m"), "left").drop("_id", "_m", "_r")
    none = F.array().cast(_STRINGS)
    per = per.withColumns({"group": F.coalesce("group", F.lit("2_no_ads")), "other_brands": F.coalesce("other_brands", none), "pids": F.coalesce("pids", none), "unresolved": F.coalesce("unresolved", F.lit(0))})
    why = groups.incomplete(F.lit(0), F.col("unresolved"), F.col("mode"), F.col("js_buttons"))
    new = groups.post_group(F.col("group"), F.col("title"), F.col("mentions"), why, config)
    per = per.withColumn("incomplete", why).withColumn("group", F.coalesce(new["group"], "group"))
    ever = groups.record_history(per).withColumnRenamed("domain", "_d")
    last = keyed.latest(per.select("domain", "ts", "ordinal", "group", "other_brands", "incomplete"), ["domain"], ["ts", "ordinal"])
    j = last.join(ever, F.col("domain") == F.col("_d"))
    lifted = groups.with_history(F.col("group"), F.col("other_brands"), F.col("ever_target"), F.col("ever_brands"))
    return j.select("domain", "ts", lifted.alias("group"), F.col("group").alias("group_now"), "other_brands", "ever_brands", "ever_pids", "ads_differ", "group_history", "incomplete", F.col("scans").alias("n_records"))


def pick_candidates(links: DataFrame, most: int = 25, config: Config = DEFAULT) -> DataFrame:
    """DC9, TK9: which links of a site to follow: domain, url, reason, refish, kind (0 to 4) and rank.

    links: domain, url, source, ordinal. Scripts' links count only if shaped like advertising, links to other hosts only if
    they are referrals, named, redirecting or random. Referrals come first, then partner parameters and scripts, gates of
    the site, links to named hosts (at most three plain ones), the rest; within a kind in order of appearance.
    """
    u, site = F.col("url"), F.col("domain")
    host, shape = U.hostname(u), U.path_shapes(u)
    inside = U.same_site(U.base_host(host), U.base_host(site))
    redirecty = shape["redirect"] | shape["url_param"]
    anchor = F.col("source").isin("a", "area")
    sound = u.rlike("(?i)^https?://") & ~shape["static"] & (inside | ~host.rlike(config.platform_hosts))
    home = inside & U.path(u).isin("", "/") & (U.query(u) == "")
    reason = F.when(~anchor, F.concat(F.lit("js:"), "source")).when(inside & redirecty, "internal_redirect_like").when(~inside, "external")
    first = F.when(~anchor, 0).when(inside, 1).otherwise(2)
    named = links.withColumn("_p", first).withColumn("reason", reason).filter(sound & reason.isNotNull() & ~home).withColumn("_key", F.regexp_replace("url", "#.*$", ""))
    one = named.groupBy("domain", "_key").agg(F.min(F.struct("_p", "ordinal", "reason")).alias("f")).select("domain", F.col("_key").alias("url"), "f._p", "f.ordinal", "f.reason")
    refish = U.classify_ref(u, site, config).isNotNull() | (~inside & U.tracker_shaped(u))
    branded = ~inside & (decisions.brand_of_host(host, config) != "")
    params = U.has_affiliate_params(u, config)
    script, external = F.col("reason").startswith("js:script"), F.col("reason") == "external"
    dropped = (script & inside & ~redirecty) | (script & ~inside & ~refish & ~branded & ~params) | (external & ~refish & ~branded & ~redirecty & ~U.random_host(host, config) & ~host.rlike(config.keep_hosts))
    kind = F.when(refish, 0).when((params & ~inside) | F.col("reason").startswith("js:"), 1).when(F.col("reason") == "internal_redirect_like", 2).when(branded, 3).otherwise(4)
    found = one.filter(~host.rlike(config.noise_hosts) & ~dropped).withColumn("refish", refish).withColumn("kind", kind)
    order = [F.col("_p"), F.col("ordinal"), F.col("url")]
    within = F.row_number().over(Window.partitionBy("domain", "kind").orderBy(*order))
    capped = found.withColumn("_w", within).filter((F.col("kind") != 3) | (F.col("_w") <= config.thresholds.branded_plain_links))
    return tables.top_per_group(capped, ["domain"], [F.col("kind"), *order], most).select("domain", "url", "reason", "refish", "kind", "rank")


def inner_pages(links: DataFrame, posts: int = 3, total: int = 4, config: Config = DEFAULT) -> DataFrame:
    """HT12: domain, url, post and rank: at most three inner pages that name the target by text or path, and useful ones up to
    four in all, in order of appearance. links: domain, url, text, ordinal."""
    u = F.col("url")
    inside = links.filter((U.base_host(U.hostname(u)) == U.base_host(F.col("domain"))) & ~U.path(u).isin("", "/"))
    post = F.coalesce(F.col("text").rlike(config.brand), F.lit(False)) | U.path(u).rlike(config.brand)
    first = inside.withColumn("post", post).groupBy("domain", "url").agg(F.max("post").alias("post"), F.min("ordinal").alias("ordinal")).filter(F.col("post") | U.path(u).rlike(config.useful_paths))
    place = F.row_number().over(Window.partitionBy("domain", "post").orderBy("ordinal", "url"))
    kept = first.withColumn("_p", place).filter(~F.col("post") | (F.col("_p") <= posts))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("post"), "ordinal", "url"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= total).select("domain", "url", "post", "rank")


def own_scripts(scripts: DataFrame, most: int = 6, config: Config = DEFAULT) -> DataFrame:
    """HT12: domain, url and rank of a site's own scripts that are no libraries. scripts: domain, url, ordinal."""
    own = scripts.filter((U.base_host(U.hostname(F.col("url"))) == U.base_host(F.col("domain"))) & ~F.col("url").rlike(config.script_libraries))
    first = own.groupBy("domain", "url").agg(F.min("ordinal").alias("ordinal"))
    return tables.top_per_group(first, ["domain"], [F.col("ordinal"), F.col("url")], most).select("domain", "url", "rank")


def deep_pages(home: DataFrame, sitemap: DataFrame, most: int = 8, config: Config = DEFAULT) -> DataFrame:
    """HT13: domain, url and rank of pages that name the target: the home page's links first, then the sitemap's, equal but
    for slashes at the end once, the home page itself never, at most eight per site. home, sitemap: domain, url, ordinal."""
    both = home.select("domain", "url", F.lit(0).alias("src"), "ordinal").union(sitemap.select("domain", "url", F.lit(1).alias("src"), "ordinal"))
    named = both.filter(T.percent_decoded(F.col("url")).rlike(config.brand) & ~U.path(F.col("url")).isin("", "/"))
    first = named.withColumn("_u", F.regexp_replace("url", "/+$", "")).groupBy("domain", "_u").agg(F.min(F.struct("src", "ordinal", "url")).alias("f"))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy("f"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= most).select("domain", "f.url", "rank")


def review_queue(sites: DataFrame, forced: Sequence[str], k: int = 500, skipped: Sequence[str] = ()) -> DataFrame:
    """TK8, FLT11: the k riskiest sites and all of the forced classes, each once; skipped classes have nothing to judge."""
    rest = sites.filter(~F.col("category").isin(*forced, *skipped))
    return rest.orderBy(F.desc("risk"), "domain").limit(k).union(sites.filter(F.col("category").isin(*forced)))


def inventory_queue(sites: DataFrame, done: DataFrame, only: Sequence[str] | None = None, redo: DataFrame | None = None, key: str = "domain", most: int | None = None) -> DataFrame:
    """FLT10, IN1, IN2: what is left to do: a list of domains if given, less those that are done, and what is to be done
    again; the first most by key, if given."""
    todo = sites if only is None else sites.filter(F.col(key).isin(*only))
    left = tables.without(todo, done, key)
    out = left if redo is None else left.unionByName(tables.only(tables.only(todo, redo, key), done, key))
    return out if most is None else out.orderBy(key).limit(most)


def without_own(sites: DataFrame, own: DataFrame, key: str = "domain") -> DataFrame:
    """JN3: sites whose domain, in normal form, is not the owner's."""
    left = sites.withColumn("_n", U.base_host(F.col(key)))
    return left.join(own.select(U.base_host(F.col("value")).alias("_n")).distinct(), "_n", "left_anti").drop("_n")
