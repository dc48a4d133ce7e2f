"""Evidence scores of classes and their calibration by reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import DEFAULT, Config
from tessera.operators import calibrate, keyed
from tessera.operators.cascade import Weight, weighted_score

MIXED = ("mono_other", "mono_mixed")
#: What a class is worth by itself, before its evidence is weighed.
BASE = {"mono_target": 0.86, "mono_unresolved": 0.75, "mono_no_ads": 0.72, "mono_xlink": 0.65, "mono_hidden": 0.85, "unrelated": 0.88, "other_topic": 0.88, "unclear": 0.30, "discredit": 0.78}
DEAD = {"dns_fail": 0.95, "connection_refused": 0.9, "tls_error": 0.85, "too_many_redirects": 0.85, "timeout": 0.75, "ServerDisconnectedError": 0.75, "connect_error": 0.8}
CLOSED = {"cloudflare_challenge": 0.85, "cloudflare_turnstile": 0.85, "geo_block": 0.9}
OTHER = 0.7
#: Classes whose page need not be there.
NO_PAGE = ("not_shown", "stub", "parked", "dead", "redirect_ref", "redirect_other")
BLOCK_TITLE = r"(?i)attention required|just a moment|you have been blocked|access denied"
CONTENT = r"content=([^:]*):(\d+) target=(\d+)"


def _table(key: Column, values: dict[str, float], default: float) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return out.otherwise(default)


def raw_score(df: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """DC23: adds raw (0.05 to 0.98) and minus, the reasons that lowered it.

    Columns: category, why (as the cascades give it), tags (array), title, other (array of names that a site advertises),
    other_links (array of structs name, url, final) and target_links (number) of the links that decided, target (boolean),
    density, text_len, topic_density, feed_links, shared_tracker (all others are trackers that lead to the target elsewhere),
    single_template (all other links are one known template's). Nulls count as none.
    """
    t, cat, why = config.thresholds, F.col("category"), F.coalesce("why", F.lit(""))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    tag = lambda name: F.coalesce(F.array_contains("tags", name), F.lit(False))
    links = F.coalesce("other_links", F.array().cast("array<struct<name:string,url:string,final:string>>"))
    mixed = cat.isin(*MIXED)
    named = F.filter(links, lambda x: ~x["name"].startswith("via ") & ~x["name"].contains("."))
    coded = F.exists(named, lambda x: F.coalesce(x["final"], F.lit("")) != "")
    top = lambda k: F.regexp_extract(why, CONTENT, k)
    held = why.rlike(CONTENT)
    ratio = F.coalesce(top(2).try_cast("double"), F.lit(0.0)) / (F.coalesce(top(3).try_cast("double"), F.lit(0.0)) + 1)
    code = F.regexp_extract(why, r"^(?:http|cloudflare)_(\d+)", 1)
    hidden = F.coalesce(F.regexp_extract(why, r"hidden links=(\d+)", 1).try_cast("int"), F.lit(0))
    brands = F.array_join("other", ", ")
    base = (
        F.when(mixed, F.when(coded, 0.92).when(F.size(named) > 0, 0.85).when(F.size(links) > 0, 0.68).otherwise(0.78))
        .when(cat == "page_other", F.when(brands.rlike("[A-Za-z]{3}") & ~brands.contains("."), 0.8).otherwise(0.68))
        .when(cat == "bait", F.when(why.contains("moves to"), 0.85).when(why.contains("never names"), 0.8).when(why.contains("meta only"), 0.7).when(held & (ratio >= 3), 0.88).when(held, 0.72).otherwise(OTHER))
        .when(cat == "redirect_ref", F.when(why.contains("pid"), 0.95).otherwise(0.85))
        .when(cat == "redirect_other", F.when(why.rlike(config.parked), 0.4).when(why.rlike(r"^redirect:\s*$"), 0.62).when(why.contains("script"), 0.7).otherwise(0.85))
        .when(cat == "mirror", F.when(why == "shell", 0.95).otherwise(0.8))
        .when(cat == "multibrand", F.when(~held | top(1).isin("", "other"), 0.6).when(ratio >= 3, 0.85).when(ratio >= 1.5, 0.75).otherwise(0.6))
        .when(cat == "article", F.when(n("feed_links") >= 30, 0.85).when(n("feed_links") >= 15, 0.75).otherwise(0.62))
        .when(cat == "hacked", F.when(hidden >= 3, 0.85).when(hidden >= 1, 0.8).when(why.contains("head only"), 0.55).otherwise(0.65))
        .when(cat == "stub", F.when(why == "placeholder text", 0.85).when(why.startswith("placeholder of"), 0.85).when(why.startswith("text_len"), 0.7).otherwise(0.6))
        .when(cat == "parked", F.when(why == "parked", 0.9).otherwise(0.85))
        .when(cat == "dead", _table(why, DEAD, OTHER))
        .when(cat == "not_shown", F.when(code.isin("403", "401", "429"), 0.8).when(code != "", 0.72).when(why.startswith("answered earlier"), 0.55).otherwise(_table(why, CLOSED, 0.62)))
    )
    for name, value in BASE.items():
        base = base.when(cat == name, value)
    weights = [
        Weight(0.0, mixed & (F.size(named) == 0) & (F.size(links) > 0), "only a tracker that did not open"),
        Weight(0.03, mixed & (F.size(F.array_distinct(F.transform(links, lambda x: x["name"]))) >= 2)),
        Weight(-0.03, mixed & why.contains("name_in_title")),
        Weight(-0.08, mixed & ~why.contains("name_in_title") & why.contains("dominant density="), "name neither in the domain nor in the title"),
        Weight(-0.08, mixed & (n("density") < t.mono_density), "few mentions"),
        Weight(-0.10, (cat == "mono_mixed") & (n("target_links") == 0) & ~flag("target"), "own advertising is not confirmed by a link"),
        Weight(-0.05, mixed & (tag("ads_search_only") | tag("ads_mobile_only")), "not seen by every visitor"),
        Weight(0.0, (cat == "bait") & held & (ratio < 3) & ~why.rlike("moves to|never names|meta only"), "the target is named almost as often"),
        Weight(-0.10, (cat == "bait") & held & ~tag("brand_in_domain"), "the name stands in the title alone"),
        Weight(0.05, (cat == "discredit") & (n("text_len") >= 5000)),
        Weight(-0.15, (cat == "discredit") & (n("topic_density") > 1), "words of the trade"),
        Weight(-0.08, (cat == "mono_target") & (n("target_links") == 0), "no deciding link"),
        Weight(-0.12, (cat == "mono_target") & tag("ads_unverified"), "open links"),
        Weight(-0.15, cat.isin("mono_unresolved", "mono_no_ads") & (n("text_len") < 1500), "little text"),
        Weight(-0.10, (cat == "mono_no_ads") & tag("ads_unverified"), "open links"),
        Weight(-0.30, (cat == "multibrand") & tag("brand_in_domain"), "the name stands in the domain"),
        Weight(-0.10, (cat == "article") & (n("density") >= t.mono_density), "named as often as on a page about the target"),
        Weight(0.0, (cat == "dead") & (why == "timeout"), "one timeout"),
        Weight(-0.35, mixed & flag("shared_tracker"), "a tracker that leads to the target elsewhere"),
        Weight(-0.35, mixed & flag("single_template"), "one known template link"),
        Weight(-0.40, ~cat.isin("not_shown", "dead", "parked") & F.coalesce("title", F.lit("")).rlike(BLOCK_TITLE), "a block page"),
        Weight(-0.20, ~cat.isin(*NO_PAGE) & tag("no_html"), "no page"),
        Weight(-0.04, F.exists(F.coalesce("tags", F.array().cast("array<string>")), lambda x: x.startswith("cloaked:")), "seen by one visitor only"),
        Weight(-0.03, cat.isin(*MIXED, "mono_xlink") & tag("ads_unverified"), "open links"),
    ]
    score, reasons = weighted_score(base.otherwise(OTHER), weights, t.raw_low, t.raw_high)
    return df.withColumn("raw", score).withColumn("minus", reasons)


def labels(verdicts: DataFrame, now: DataFrame) -> DataFrame:
    """WN9, Appendix E: domain, category, expected and ok of the last sure verdict of every domain that has a class now.

    verdicts: domain, given, verdict, should_be, round, ordinal. A wrong verdict expects should_be, any other one given; a
    verdict without given means that the class of now holds.
    """
    last = keyed.resolved_labels(verdicts, "domain", "verdict", ["round", "ordinal"])
    j = last.join(now.select(F.col("domain").alias("_d"), "category"), F.col("domain") == F.col("_d"))
    expected = F.when(F.col("verdict") == "wrong", F.coalesce("should_be", F.lit("not_a_violator"))).otherwise(F.coalesce("given", "category"))
    return j.select("domain", "category", expected.alias("expected"), (expected == F.col("category")).alias("ok"))


def family_of(category: Column, config: Config = DEFAULT) -> Column:
    """The family of classes that share a calibration; "rest" for unknown ones."""
    return F.coalesce(*[F.when(category.isin(*classes), F.lit(name)) for name, classes in config.families], F.lit("rest"))


def calibrated(scored: DataFrame, reviewed: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """E3: adds confidence to scored sites (domain, category, raw): a Platt fit per family and an offset per class."""
    df = scored.withColumn("family", family_of(F.col("category"), config))
    points = df.join(reviewed.select(F.col("domain").alias("_d"), F.col("ok").cast("double").alias("y")), F.col("domain") == F.col("_d"))
    points = points.select("family", "category", calibrate.logit(F.col("raw"), config.thresholds.clamp).alias("x"), "y")
    params, offsets = _fitted(points, config)
    return calibrate.confidence(df, "family", "category", "raw", params, offsets)


def _fitted(points: DataFrame, config: Config) -> tuple[dict[str, tuple[float, float]], dict[str, float]]:
    params = calibrate.platt(points, "family", "x", "y", config.thresholds.fit_prior)
    pick = lambda k, default: F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for f, ab in params.items() for v in (f, ab[k])]), F.col("family")), F.lit(default)) if params else F.lit(default)
    return params, calibrate.class_offsets(points.withColumn("z", pick(0, 0.0) + pick(1, 1.0) * F.col("x")), "category", "z", "y", config.thresholds.class_prior)


def violations(scored: DataFrame, reviewed: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """ML5: adds violation, the probability that a site is a violator whatever its class.

    reviewed: domain, expected. A check counts for a violator class if it expects any violator, for another class if it
    expects none; scores of other classes count with the opposite sign, and their result is turned round.
    """
    bad = config.violators()
    df = scored.withColumn("family", family_of(F.col("category"), config))
    sign = F.when(F.col("category").isin(*bad), 1.0).otherwise(-1.0)
    x = sign * calibrate.logit(F.col("raw"), config.thresholds.clamp)
    points = df.join(reviewed.select(F.col("domain").alias("_d"), F.col("expected").isin(*bad).alias("_v")), F.col("domain") == F.col("_d"))
    y = (F.col("_v") == F.col("category").isin(*bad)).cast("double")
    params, offsets = _fitted(points.select("family", "category", x.alias("x"), y.alias("y")), config)
    out = calibrate.confidence(df.withColumn("_p", calibrate.sigmoid(x)), "family", "category", "_p", params, offsets, "violation")
    return out.withColumn("violation", calibrate.violation(F.col("violation"), F.col("category").isin(*bad))).drop("_p")


def rule_rows(rows: DataFrame) -> DataFrame:
    """HP6: classified rows with the rules' own class as category, since the scale measures the rules and not a checker's
    corrections; the class that is shown stays as shown_category."""
    own = F.coalesce(F.nullif("rule_category", F.lit("")), "category")
    return rows.withColumn("shown_category", F.col("category")).withColumn("category", own)
