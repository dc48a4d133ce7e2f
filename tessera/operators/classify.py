"""E1: sites to classes: tracker hosts, evidence of all sources, status and type cascades, overrides, reviews, moves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.functions import url as U
from tessera.operators import chains, decisions, evidence, sites, tables

#: Classes whose moves belong to the list.
MOVING = ("mono_other", "mono_mixed", "mono_hidden", "mono_xlink", "mono_target", "mono_unresolved", "mono_no_ads", "page_other", "multibrand", "article", "hacked")


@dataclass
class Classified:
    """sites: one row per site. moves: hosts that sites move to and the base does not hold, with their majority class."""

    sites: DataFrame
    moves: DataFrame


def classify(
    base: DataFrame,
    dests: DataFrame,
    verdicts: DataFrame,
    pages: DataFrame,
    referrals: DataFrame | None = None,
    follow: DataFrame | None = None,
    titled: DataFrame | None = None,
    config: Config = DEFAULT,
) -> Classified:
    """base: one row per site with the columns of redirect_target, site_status, site_type and site_tags but those that are
    made here (other_names, plain_names, target, unverified, ours, redirect), mode, incomplete (array), gates, trackers,
    hidden_hosts, aff_links and chain (array of URLs of the home page's moves).

    dests: as destination_verdicts. verdicts: domain, given, verdict, should_be. pages: as resources of page_evidence.
    referrals: domain, ref_url. follow: as chain_verdicts; titled: host. Missing evidence counts as none.
    """
    none = F.array().cast("array<string>")
    trackers = evidence.tracker_hosts(dests, base, config)
    links = base.select("domain", F.col("group").isNotNull().alias("scanned"), F.posexplode("aff_links").alias("ordinal", "l")).select("domain", "scanned", "ordinal", "l.*")
    empty = dests.select(F.lit("").alias("host")).limit(0)
    rows = evidence.verdict_rows(
        evidence.destination_verdicts(dests, trackers, config),
        None if referrals is None else evidence.referral_verdicts(referrals, trackers, config),
        None if follow is None else evidence.chain_verdicts(follow, trackers, empty if titled is None else titled, config),
        evidence.link_verdicts(links, trackers, config),
    )
    open_ = base.filter(F.size(F.coalesce("incomplete", none)) > 0).select("domain")
    found = evidence.ads(rows, open_).select(F.col("domain").alias("_d"), "target", F.col("other").alias("other_names"), F.col("plain").alias("plain_names"), "unverified", "ours", "links")
    df = base.join(found, F.col("domain") == F.col("_d"), "left").drop("_d")
    df = df.withColumns({"target": F.coalesce("target", F.lit(False)), "ours": F.coalesce("ours", F.lit(False)), "other_names": F.coalesce("other_names", none), "plain_names": F.coalesce("plain_names", none), "unverified": F.coalesce("unverified", F.lit(0).cast("long"))})
    marks = sites.site_tags(config)
    df = df.withColumn("tags", marks).withColumn("moved", F.array_contains("tags", "moved"))
    df = decisions.redirect_target(df, config)
    df = sites.site_type(sites.site_status(df, config), config)
    sub = sites.mono_subtype(F.col("target"), F.col("other_names"), F.col("plain_names"), F.col("unverified"), F.col("gates"), F.col("trackers"), F.col("mode"), F.col("group"), F.col("incomplete"))
    open_class = F.when(F.col("site_type") == "mono", sub).otherwise(F.col("site_type"))
    category = F.when(F.col("status") == "redirect", F.col("redirect")).when(F.col("status") != "open", F.col("status")).otherwise(open_class)
    why = F.when(F.col("status") != "open", F.col("status_why")).otherwise(F.col("site_type_why"))
    df = df.withColumn("category", category).withColumn("why", why)
    hidden, hidden_why = sites.hidden_override(F.col("category"), F.col("why"), F.col("plain_names"), F.col("hidden_hosts"), F.col("other_names"))
    df = df.withColumn("_c", hidden).withColumn("why", hidden_why).withColumn("category", F.col("_c")).drop("_c")
    inner = evidence.page_evidence(pages, dests, config).select(F.col("domain").alias("_e"), F.col("brands").alias("_b"), "page")
    df = df.join(inner, F.col("domain") == F.col("_e"), "left").withColumn("_b", F.when(F.col("category").isin(*sites.STRIKES), none).otherwise(F.coalesce("_b", none)))
    df = df.withColumns({"category": sites.evidence_override(F.col("category"), F.col("_b"), F.col("target")), "other_names": F.array_sort(F.array_union("other_names", "_b"))})
    df = tables.overlay(df, verdicts, "domain", "category", "category")
    out = df.select("domain", F.col("category").alias("rule_category"), F.col("final").alias("category"), "why", "tags", "target", F.col("other_names").alias("other"), F.col("plain_names").alias("plain"), "unverified", "links", "check")
    hosts = df.filter(F.col("category").isin(*MOVING)).select("domain", F.col("category").alias("class"), F.explode(F.array_distinct(F.coalesce("chain", none))).alias("url")).withColumn("host", U.url_host(F.col("url")))
    moving = hosts.filter((F.col("host") != "") & ~U.same_site(F.col("host"), U.base_host(F.col("domain"))) & ~U.ref_host(F.col("host"), config) & ~F.col("host").rlike(config.not_ad_hosts) & ~F.col("host").rlike(config.not_trade_hosts) & (~U.looks_tracker(F.col("url"), config) | F.col("host").rlike(config.brand)))
    moving = moving.join(trackers.select(F.col("host").alias("_t")), F.col("host") == F.col("_t"), "left_anti")
    return Classified(out, chains.move_targets(moving.select("domain", "class", "host"), base))
