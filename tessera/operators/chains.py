"""Redirect chains over captured hops: paths by doubling, and what ends them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.functions import url as U
from tessera.space import cut


def jumps(hops: DataFrame, steps: int) -> DataFrame:
    """Where each captured URL leads in at least so many steps: url, path (the URLs after it), open (the last one may lead
    on) and stop (why it does not: error or no_redirect), by doubling: each round puts the path of a path's last URL behind
    it, so that steps take log2(steps) joins. A path ends before the first URL that it holds already.

    hops: url, status, location; the smallest location of several, and none only where no row names one (nulls come last,
    also for the status). A URL that is not captured, or answered with 400 or more, is an error.
    """
    row = F.struct(F.col("location").isNull().alias("_l"), "location", F.col("status").isNull().alias("_s"), "status")
    one = hops.filter("url IS NOT NULL").groupBy("url").agg(F.min(row).alias("s"))
    failed = F.coalesce(F.col("s.status") >= 400, F.lit(False))
    stays = F.col("s.location").isNull() | (F.col("s.location") == F.col("url"))
    nothing = F.array().cast("array<string>")
    first = F.when(failed | stays, nothing).otherwise(F.array("s.location"))
    now = cut(one.select("url", first.alias("path"), (~(failed | stays)).alias("open"), F.when(failed, "error").when(stays, "no_redirect").alias("stop")))
    length = 1
    while length < steps:
        #: A path that has ended meets nothing; its key is its own URL behind a character that no URL holds.
        end = F.when(F.col("open"), F.element_at("path", -1)).otherwise(F.concat(F.lit("\x00"), "url"))
        on = now.select(F.col("url").alias("_u"), F.col("path").alias("_path"), F.col("open").alias("_open"), F.col("stop").alias("_stop"))
        both = now.withColumn("_end", end).join(on, F.col("_end") == F.col("_u"), "left")
        whole = F.concat(F.array("url"), "path", F.coalesce("_path", nothing))
        again = F.array_min(F.transform(whole, lambda x, i: F.when(F.array_position(whole, x) <= i, i)))
        met = both.withColumns({"_whole": whole, "_again": again})
        going = F.col("open")
        now = cut(met.select(
            "url",
            F.when(~going, F.col("path")).when(F.col("_again").isNotNull(), F.slice("_whole", F.lit(2), F.col("_again") - 1)).otherwise(F.slice("_whole", F.lit(2), F.size("_whole"))).alias("path"),
            (going & F.col("_again").isNull() & F.coalesce("_open", F.lit(False))).alias("open"),
            F.when(~going, F.col("stop")).when(F.col("_again").isNotNull(), F.lit("no_redirect")).when(F.col("_u").isNull(), F.lit("error")).otherwise(F.col("_stop")).alias("stop"),
        ))
        length *= 2
    return now


def follow(starts: DataFrame, hops: DataFrame, max_hops: int = 8, config: Config = DEFAULT) -> DataFrame:
    """PT1: start, site, chain (array of URLs), final_url and stop: found, platform_host, error, no_redirect or max_hops.

    starts: url and site. hops: url, status, location, one row per captured URL (the smallest location of several). A
    referral is not asked, nor is a platform: the chain is that of jumps, which knows no site, up to the first URL at which
    its start's site stops it.
    """
    site = F.col("site") if "site" in starts.columns else F.lit("")
    led = jumps(hops, max_hops).select(F.col("url").alias("_u"), "path", F.col("stop").alias("_stop"))
    j = starts.select(F.col("url").alias("start"), site.alias("site")).join(led, F.col("start") == F.col("_u"), "left")
    chain = F.slice(F.concat(F.array("start"), F.coalesce("path", F.array().cast("array<string>"))), 1, max_hops + 1)
    j = j.select("start", "site", chain.alias("chain"), F.when(F.col("_u").isNull(), "error").otherwise(F.col("_stop")).alias("_stop"))
    here = lambda u, i: F.when(U.classify_ref(u, F.col("site"), config).isNotNull(), "found").when(U.hostname(u).rlike(config.platform_hosts) & (i < max_hops), "platform_host")
    j = j.withColumn("_here", F.transform("chain", here))
    at = F.array_min(F.transform("_here", lambda w, i: F.when(w.isNotNull(), i + 1)))
    j = j.withColumn("_at", at)
    stop = F.when(F.col("_at").isNotNull(), F.try_element_at("_here", "_at")).when(F.size("chain") > max_hops, "max_hops").otherwise(F.col("_stop"))
    out = j.select("start", "site", F.slice("chain", F.lit(1), F.coalesce("_at", F.size("chain"))).alias("chain"), stop.alias("stop"))
    return out.select("start", "site", "chain", F.element_at("chain", -1).alias("final_url"), "stop")


#: PT2, fixed values: answers that a browser may pass, and types of downloads.
PASSABLE = (401, 403, 429, 503)
DOWNLOADS = r"(?i)android|octet-stream|x-msdownload|zip"


def landing(status: Column, error: Column, content_type: Column, protected: Column, inside: Column, kind: Column, evidence: Column, text_len: Column, final: Column, looped: Column, config: Config = DEFAULT) -> Column:
    """PT2: what a followed chain ends on, as a struct of kind and evidence: the kind of its page, or needs_browser where a
    plain client cannot tell (a timeout, a check, or little text without decisive marks), dead, download, unknown or
    internal."""
    ct = F.coalesce(content_type, F.lit(""))
    made = lambda k, e: F.struct((F.lit(k) if isinstance(k, str) else k).alias("kind"), e.cast("string").alias("evidence"))
    decisive = (evidence == "assets") | evidence.startswith("fields:")
    return (
        F.when(F.coalesce(looped, F.lit(False)), made("dead", F.lit("too_many_redirects")))
        .when(error == "timeout", made("needs_browser", F.lit("undecided")))
        .when(error.isNotNull(), made("dead", error))
        .when(F.coalesce(protected, F.lit(False)) | status.isin(*PASSABLE), made("needs_browser", F.lit("undecided")))
        .when(status >= 400, made("dead", F.concat(F.lit("http_"), status)))
        .when(~F.lower(ct).contains("html") & ct.rlike(DOWNLOADS), made(F.when(final.rlike(config.brand), "target").otherwise("download"), F.concat(F.lit("download:"), ct)))
        .when(~F.lower(ct).contains("html"), made("unknown", F.concat(F.lit("not_html:"), F.substring(ct, 1, 40))))
        .when(F.coalesce(inside, F.lit(False)), made("internal", F.lit("stayed_on_site")))
        .when(~F.coalesce(decisive, F.lit(False)) & (text_len < 500), made("needs_browser", F.lit("undecided")))
        .otherwise(made(kind, evidence))
    )


def expand_once(queue: DataFrame, links: DataFrame, budget: int = 12, per_page: int = 4) -> DataFrame:
    """PT3: a site's queue (site, url, ordinal) and, one level deep, at most per_page links of its gate pages
    (links: url, link, place), right behind the gate and the last of them first, within a budget per site; a link that is
    queued already stays where it is."""
    inner = links.withColumn("_r", F.row_number().over(Window.partitionBy("url").orderBy("place", "link"))).filter(F.col("_r") <= per_page)
    more = queue.join(inner, "url").select("site", F.col("link").alias("url"), "ordinal", (F.lit(per_page + 1) - F.col("_r")).alias("place"))
    known = queue.select(F.col("site").alias("_site"), F.col("url").alias("_url")).distinct()
    more = more.join(known, (F.col("site") == F.col("_site")) & (F.col("url") == F.col("_url")), "left_anti")
    both = queue.select("site", "url", "ordinal", F.lit(0).alias("place")).union(more)
    first = both.groupBy("site", "url").agg(F.min(F.struct("ordinal", "place")).alias("o"))
    rank = F.row_number().over(Window.partitionBy("site").orderBy("o", "url"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= budget).select("site", "url", "rank")


def home_chain(chains: Column) -> Column:
    """PT4, ST5: all URLs of several chains but each one's last, once each, in order."""
    return F.array_distinct(F.flatten(F.transform(chains, lambda c: F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))))))


def move_targets(chains: DataFrame, base: DataFrame) -> DataFrame:
    """JN14, AG18: hosts on chains (domain, class, host) that the base does not hold, with the most frequent class of the
    sites that move there (the smaller name of equally frequent ones)."""
    new = chains.join(base.select(F.col("domain").alias("_b")).distinct(), F.col("host") == F.col("_b"), "left_anti")
    counted = new.groupBy("host", "class").agg(F.count_distinct("domain").alias("n"))
    best = counted.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("m"), "class")).alias("_b"))
    return best.select("host", F.col("_b.class").alias("class"))
