import dataclasses
import datetime as dt
import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.operators import calibrate, chains, corpus, decisions, evidence, groups, keyed, sites, tables
from tessera.operators.cascade import Rule, Weight, first_match, tags, weighted_score
from tessera.sources import readers, sinks
from tessera.streaming import latest as stream


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 2, 3, "z"), ("b", 1, 4, None)], "k string, ts int, o int, v string")
    assert rows(keyed.latest(df, ["k"], ["ts", "o"])) == [("a", 2, 3, "z"), ("b", 1, 4, None)]
    assert rows(keyed.earliest(df, ["k"], ["o"])) == [("a", 1, 1, "x"), ("b", 1, 4, None)]
    got = {r.k: (r.first.o, r.last.o) for r in keyed.first_and_last(df, ["k"], "ts", "o").collect()}
    assert got == {"a": (1, 3), "b": (4, 4)}
    assert rows(keyed.latest(df.orderBy(F.rand(1)).repartition(3), ["k"], ["ts", "o"])) == rows(keyed.latest(df, ["k"], ["ts", "o"]))


def test_precedence(spark):
    make = lambda r: spark.createDataFrame(r, "k string, ts int, src string")
    got = keyed.by_precedence([make([("a", 1, "http"), ("c", 1, "http")]), make([("a", 5, "browser"), ("b", 5, "browser")]), make([("a", 4, "rest"), ("b", 6, "rest"), ("d", 1, "rest")])], "k", "ts", newer_only=(2,))
    assert {(r.k, r.src) for r in got.collect()} == {("a", "browser"), ("b", "rest"), ("c", "http"), ("d", "rest")}


def test_history_and_labels(spark):
    df = spark.createDataFrame([("a", ["x"], "1"), ("a", ["y", "x"], "2"), ("b", [], "1")], "k string, brands array<string>, sig string")
    assert rows(keyed.history(df, "k", ["brands"], "sig")) == [("a", ["x", "y"], True), ("b", [], False)]
    labels = spark.createDataFrame([("a", 1, "correct"), ("a", 2, "unsure"), ("b", 1, "wrong"), ("b", 2, "correct"), ("c", 1, "unsure")], "k string, round int, verdict string")
    assert {(r.k, r.verdict) for r in keyed.resolved_labels(labels, "k", "verdict", ["round"]).collect()} == {("a", "correct"), ("b", "correct")}
    seq = spark.createDataFrame([(["a", "a", "b", None, None, "a"],)], "v array<string>").select(keyed.collapse_array(F.col("v"))).first()[0]
    assert seq == ["a", "b", None, "a"]
    said = spark.createDataFrame([("two then one",)], "t string").select(keyed.first_mention_ranks(F.col("t"), [("One", "one"), ("Two", "two"), ("Three", "three")])).first()[0]
    assert said == ["Two", "One"]


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = {r.v: r.n for r in keyed.numbered(df, ["v"]).collect()}
    assert got == {v: v + 1 for v in range(1000)}


def test_slices_equal_their_definition(spark):
    pairs = [(r, n, k) for k in (3, 10) for n in range(k, 200) for r in range(n)]
    df = spark.createDataFrame(pairs, "r long, n long, k int")
    got = {k: {(x.r, x.n): x.s for x in df.filter(F.col("k") == k).select("r", "n", tables.slice_of(F.col("r"), F.col("n"), k).alias("s")).collect()} for k in (3, 10)}
    for r, n, k in pairs:
        assert next(i for i in range(k) if i * n // k <= r < (i + 1) * n // k) == got[k][(r, n)]


def test_tables(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(tables.three_way(a, b, "k")) == [(1, "left"), (2, "both"), (3, "right")]
    assert rows(tables.without(a, b, "k")) == [(1,)] and rows(tables.only(a, b, "k")) == [(2,), (2,)]
    hosts = spark.createDataFrame([("t", True), ("t", True), ("m", True), ("m", False), ("o", False)], "h string, is boolean")
    assert rows(tables.one_sided_hosts(hosts, "h", F.col("is"))) == [("t",)]
    kinds = spark.createDataFrame([("a", "target", ""), ("a", "other", "G"), ("b", "other", "I"), ("c", "x", ""), ("d", "target", "")], "s string, kind string, brand string")
    assert rows(tables.site_group(kinds, "s", "kind", "brand")) == [("a", "4_mixed", ["G"]), ("b", "3_other_only", ["I"]), ("c", "2_no_ads", []), ("d", "1_target_only", [])]
    votes = spark.createDataFrame([("k", "x", 3), ("k", "y", 1), ("k", "x", 4), ("k", "y", 2)], "k string, v string, o int")
    assert rows(tables.majority(votes, "k", "v", "o")) == [("k", "y", 2)]
    top = spark.createDataFrame([({"a": 1, "b": 3, "c": 3},)], "m map<string,int>").select(tables.top_entries(F.col("m"), 2)).first()[0]
    assert [tuple(x) for x in top] == [("b", 3), ("c", 3)]
    for part, whole, expected in ((245, 315, 77), (4, 17, 23), (37, 57, 64), (0, 0, 0)):
        assert spark.range(1).select(tables.floor_percent(F.lit(part), F.lit(whole))).first()[0] == expected
    truth = spark.createDataFrame([(k, "x") for k in range(60)], "k int, value string")
    found = spark.createDataFrame([(k, "x" if k < 47 else "y" if k < 57 else "unsure") for k in range(60)], "k int, value string")
    r = tables.agreement(truth, found, "k").first()
    assert (r.agree, r.disagree, r.unsure, r.missing) == (47, 10, 3, 0) and r.rate == pytest.approx(47 / 57)
    langs = spark.createDataFrame([("p", "en", "p"), ("p", "de", "q"), ("q", "de", "q"), ("q", "zzzz1", "r")], "page string, code string, href string")
    assert rows(tables.hreflang_checks(langs)) == [("p", True, False, 0, 1), ("q", True, False, 1, 1)]


def test_cascade_order(spark):
    df = spark.range(40)
    rules = [Rule(f"c{k}", F.col("id") >= k, f"why{k}") for k in range(35, 5, -1)] + [Rule("null", F.lit(None).cast("boolean"))]
    got = {r.id: (r["class"], r.class_rule) for r in first_match(df, rules, "none").collect()}
    assert got[39] == ("c35", 1) and got[20] == ("c20", 16) and got[6] == ("c6", 30) and got[3] == ("none", 0)
    assert df.filter("id = 7").select(tags([("a", F.col("id") > 3), ("b", F.col("id") > 9), ("c", F.lit(None).cast("boolean"))])).first()[0] == ["a"]
    score, why = weighted_score(F.lit(0.7), [Weight(0.5, F.col("id") > 3), Weight(-0.3, F.col("id") > 5, "low")], 0.05, 0.98)
    assert df.filter("id = 4").select(score).first()[0] == 0.98
    assert tuple(df.filter("id = 7").select(F.round(score, 6), why).first()) == (0.9, ["low"])


LANDINGS = [
    ("http://x.example/", "", "<script src='https://cdn.acme.example/a.js'>", "t", [], "target", "assets"),
    ("http://globex.example/", "Globex", "", "text " * 50, [], "other", "fields:Globex"),
    ("http://x.example/", "Globex", "", "bonus offer", [], "other", "fields:Globex"),
    ("http://x.example/", "Globex day", "x" * 6000, "plain", [], "off_topic", "no_topic_words"),
    ("http://x.example/?pid=7", "Acme", "", "plain", [], "target", "name_only"),
    ("http://x.example/", "Some - page", "", "bonus", [], "other", "topic_words"),
    ("http://x.example/", "", "", "", [], "unknown", "empty_page"),
]


def test_identify(spark):
    df = spark.createDataFrame([x[:5] for x in LANDINGS], "final_url string, title string, html string, text string, names array<string>").withColumn("i", F.monotonically_increasing_id())
    got = decisions.identify(df).orderBy("i").collect()
    assert [(r.kind, r.evidence) for r in got] == [x[5:] for x in LANDINGS]
    assert got[4].pid == "7" and got[5].brand == "Some"


def test_refine_is_idempotent(spark):
    r = random.Random(1)
    pick = lambda: (r.choice(["other", "topic_site", "target", "unknown"]), r.choice(["Globex", "?", ""]), r.choice(["fields", "topic_words", "assets"]), r.choice(["Globex", "Access denied", "Domain is for sale", "x"]), r.choice(["http://parking.example/", "http://hooli.example/?aff=1", "http://x.example/"]), r.choice(["http://a.example/", "http://a.example/?aff=1"]), r.choice([None, [], ["http://t.example/"]]), r.choice([True, False]))
    df = spark.createDataFrame([pick() for _ in range(300)], "kind string, brand string, evidence string, title string, final_url string, start_url string, hops array<string>, ad_route boolean")
    once = decisions.refine(df)
    assert rows(decisions.refine(once)) == rows(once)
    parked = once.filter("kind = 'off_topic'").count()
    assert parked and not once.filter("kind = 'target'").subtract(df.filter("kind = 'target'")).count()


def test_walls(spark):
    df = spark.createDataFrame([("Just a moment...", "<div class='cf-turnstile'>", "x"), ("Shop", "recaptcha", "x" * 2000), ("Shop", "g-recaptcha", "short"), ("Access denied", "", ""), (None, None, None)], "t string, h string, x string")
    assert [r[0] for r in df.select(decisions.challenge_kind(F.col("t"), F.col("h"), F.col("x"))).collect()] == ["cloudflare_turnstile", None, "recaptcha", None, None]


def test_stale_names_are_judged_by_their_own_pattern(spark):
    config = dataclasses.replace(DEFAULT, stale=("Globex", "Hooli"))
    cases = [("Globex", "fields:globex", "Hooli day", True), ("Globex", "fields:globex", "Globex day", True), ("Hooli", "fields:hooli", "Acme day", True), ("Hooli", "fields:hooli", "Acme day", False), ("Hooli", "fields:hooli", "Night • x", True), ("Hooli", "fields:hooli", "Night", False), ("Hooli", "topic_words", "x", True)]
    df = spark.createDataFrame([("other", *c[:3], "http://x.example/", c[3]) for c in cases], "kind string, brand string, evidence string, title string, final_url string, ad_route boolean").withColumn("i", F.monotonically_increasing_id())
    got = [(r.kind, r.brand, r.evidence) for r in decisions.refine(df, config).orderBy("i").collect()]
    assert got == [("other", "Hooli", "title_or_host:Hooli"), ("other", "Globex", "fields:globex"), ("target", "Acme", "name_only"), ("brand_site", "Acme", "name_only"), ("other", "Night", "topic_words"), ("topic_site", "Night", "topic_words"), ("other", "Hooli", "topic_words")]


def test_groups(spark):
    none = F.array().cast("array<string>")
    df = spark.createDataFrame([("2_no_ads", True, True), ("5_dead", True, True), ("8_no_mention", False, True), ("3_other_only", True, False), ("2_no_ads", False, False)], "g string, t boolean, o boolean")
    brands = F.when(F.col("o"), F.array(F.lit("G"))).otherwise(none)
    assert [r[0] for r in df.select(groups.with_history(F.col("g"), F.when(F.col("g") == "3_other_only", F.array(F.lit("G"))).otherwise(none), F.col("t"), brands)).collect()] == ["4_mixed", "5_dead", "8_no_mention", "4_mixed", "2_no_ads"]
    ans = spark.createDataFrame([(True, "positive", []), (False, None, ["x"]), (None, None, [])], "m boolean, s string, b array<string>")
    assert [r[0] for r in ans.select(decisions.answer_bucket(F.col("m"), F.col("s"), F.col("b"))).collect()] == ["ok", "absent", "n/a"]


def site_row(spark, **change):
    """A site as the cascades take it, nothing on it but what change says."""
    row = {"domain": "shop.example", "host": "", "moved": False, "title": "", "h1": "", "text_sample": "", "meta_text": "", "text_len": 500, "mentions": 0, "density": 0.0, "in_title": False, "in_h1": False, "meta_mentions": 0, "n_heads": 0, "heads_named": 0, "topic_density": 0.0, "topic_words": 0, "articles": 0, "date_links": 0, "slug_links": 0, "anchor_ext": 0, "anchor_int": 0, "hidden_named": 0, "in_posts": 0, "from_meta": False, "target": False} | change
    rivals = row.pop("rivals", 0)
    brands = F.array(F.struct(F.lit("Globex").alias("name"), F.lit(rivals).alias("n"))) if rivals else F.array().cast("array<struct<name:string,n:int>>")
    lists = {k: F.array(*[F.lit(x) for x in row.pop(k, [])]).cast("array<string>") for k in ("other_names", "plain_names")}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()], brands.alias("other_brands"), *[v.alias(k) for k, v in lists.items()])


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"domain": "acme.example", "from_meta": True}, "bait"),
        ({"domain": "acme.example", "moved": True, "host": "new.example", "topic_density": 3.0}, "bait"),
        ({"domain": "acmetal.example"}, "unrelated"),
        ({}, "unrelated"),
        ({"topic_density": 3.0}, "other_topic"),
        ({"mentions": 1, "date_links": 6}, "article"),
        ({"mentions": 1, "hidden_named": 3}, "hacked"),
        ({"mentions": 3, "in_title": True, "text_len": 1200}, "hacked"),
        ({"domain": "acme.example", "mentions": 9, "density": 2.0, "topic_density": 6.0}, "mono"),
        ({"mentions": 20, "rivals": 20, "topic_density": 6.0}, "multibrand"),
        ({"domain": "acme.example", "text_len": 2000}, "discredit"),
        ({"domain": "acme.example"}, "stub"),
    ],
)
def test_site_type(spark, change, expected):
    assert sites.site_type(site_row(spark, **change)).first().site_type == expected


def test_nulls_count_as_none(spark):
    df = site_row(spark, domain="acme.example")
    empty = df.select("domain", *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name != "domain"])
    assert sites.site_type(empty).first().site_type == "stub"


def test_ads(spark):
    dests = [
        ("s.example", 1, "http://t.example/a", "http://acme.example/", "link", "target", "Acme", "assets", "5", True, []),
        ("s.example", 2, "http://g.example/?aff=1", "http://globex.example/", "link", "other", "Globex", "fields:x", "", True, []),
        ("s.example", 3, "http://g.example/?aff=2", "http://globex.example/", "link", "other", "Globex", "fields:x", "", True, []),
        ("s.example", 4, "http://h.example/", "http://h.example/", "link", "other", "Hooli", "fields:x", "", False, []),
        ("s.example", 5, "http://u.example/", "http://u.example/", "link", "unknown", "", "", "", True, []),
        ("s.example", 6, "http://x.example/?aff=1", "http://x.example/", "home_redirect", "other", "X", "", "", True, []),
    ]
    df = spark.createDataFrame(dests, "domain string, ordinal int, url string, final_url string, via string, kind string, brand string, evidence string, pid string, ad_route boolean, hops array<string>")
    got = evidence.ads(evidence.verdict_rows(evidence.destination_verdicts(df, spark.createDataFrame([("t.example",)], "host string")))).first()
    assert got.target and got.other == ["Globex"] and got.plain == ["h.example"] and got.unverified == 1 and not got.ours
    assert got.links == '[["other","Globex","http://g.example/?aff=1","http://globex.example/"],["target","Acme","http://t.example/a","http://acme.example/"],["plain","h.example","http://h.example/",""]]'


def test_follow(spark):
    hops = [("http://a.example/", 301, "http://b.example/"), ("http://b.example/", 302, "http://go.acme.com/Ab3d"), ("http://l.example/", 301, "http://l.example/"), ("http://e.example/", 404, None), ("http://n.example/", 200, None)] + [(f"http://m{k}.example/", 301, f"http://m{k + 1}.example/") for k in range(20)]
    starts = [("http://a.example/",), ("http://l.example/",), ("http://e.example/",), ("http://n.example/",), ("http://m0.example/",), ("http://zz.example/",)]
    got = {r.start[7:-1]: (r.stop, len(r.chain)) for r in chains.follow(spark.createDataFrame(starts, "url string"), spark.createDataFrame(hops, "url string, status int, location string")).collect()}
    assert got == {"a.example": ("found", 3), "l.example": ("no_redirect", 1), "e.example": ("error", 1), "n.example": ("no_redirect", 1), "m0.example": ("max_hops", 9), "zz.example": ("error", 1)}
    moves = spark.createDataFrame([("a", "mono", "new"), ("b", "mono", "new"), ("c", "bait", "new"), ("a", "mono", "b")], "domain string, class string, host string")
    assert rows(chains.move_targets(moves, spark.createDataFrame([("b",)], "domain string"))) == [("new", "mono")]


def test_wide_grids_use_all_cores(spark):
    from tessera.plans import inputs

    one, wide = (inputs.grid(spark, "/root/testdata/sf0.001", wide=w) for w in (False, True))
    assert one.rdd.getNumPartitions() < wide.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert rows(one) == rows(wide)


def test_ads_go_through_verdicts_once(spark):
    schema = "domain string, source int, ordinal long, side string, name string, url string, final_url string"
    made = [("a", 1, 2, "other", "G", "u2", "u2"), ("a", 1, 1, "other", "G", "u1", "f"), ("a", 2, 0, "plain", "p", "", ""), ("a", 4, 3, "unverified", "", "u3", ""), ("b", 4, 1, "ours", "Acme", "u4", ""), ("c", 1, 1, "none", "", "u5", "")]
    found = evidence.ads(spark.createDataFrame(made, schema), spark.createDataFrame([("c",), ("d",)], "domain string"))
    assert rows(found) == [("a", False, ["G"], ["p"], 1, False, '[["other","G","u1","f"]]'), ("b", True, [], [], 0, True, ""), ("c", False, [], [], 1, False, ""), ("d", False, [], [], 1, False, "")]
    once = evidence.ads(spark.createDataFrame(made, schema).withColumn("url", F.concat("url", F.lit("mark"))))
    assert once._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_rules_over_urls_split_each_once(spark):
    trackers = spark.createDataFrame([("trk.example",)], "host string")
    links = spark.createDataFrame([("a.example", 1, "https://go.acme.com/Ab3d", "go.acme.com", "", "ref", True)], "domain string, ordinal long, url string, host string, brand string, ref_kind string, scanned boolean")
    for found in (evidence.link_verdicts(links, trackers), evidence.referral_verdicts(links.select("domain", F.col("url").alias("ref_url")), trackers)):
        plan = found.select("side", "name")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract(") < 12
        assert [(r.side, r.name) for r in found.select("side", "name").collect()] == [("target", "Acme")]


def test_a_url_with_several_hops_leads_on_if_one_does(spark):
    hops = [("http://a.example/", 302, None), ("http://a.example/", 302, "http://b.example/"), ("http://b.example/", None, "http://c.example/"), ("http://b.example/", 404, "http://c.example/"), ("http://c.example/", 200, None)]
    got = chains.follow(spark.createDataFrame([("http://a.example/",)], "url string"), spark.createDataFrame(hops, "url string, status int, location string")).collect()
    assert [(r.final_url, r.stop) for r in got] == [("http://b.example/", "error")]


def test_host_rollup_counts_repeated_urls_once_a_row(spark):
    u, v, far = "https://a.example/1", "https://a.example/2", "https://b.example/"
    pool = spark.createDataFrame([(u, ["q"], ["q"]), (u, ["q", "r"], []), (v, [], [])], "url string, cited array<string>, top10 array<string>")
    pages = spark.createDataFrame([(u, 60, "x"), (u, 70, "x"), (u, 5, "x"), (v, None, "x"), (far, 90, "x")], "url string, words int, host string")
    tones = spark.createDataFrame([(u, "good"), (u, "bad"), (v, "good"), (far, "odd")], "url string, tone string")
    metrics = spark.createDataFrame([("a.example", 7, 1)], "host string, domain_rating int, refdomains int")
    assert rows(corpus.host_rollup(pool, pages, tones, metrics)) == [("a.example", 2, 3, 2, 1, 2, ["bad", "good"], 7, 1)]


@pytest.mark.parametrize("most", [1, 2, 5, 8])
def test_chains_equal_single_steps(spark, most):
    r = random.Random(most)
    names = [f"http://h{k}.example/" for k in range(30)] + ["http://go.acme.com/Ab3d", "http://video.example/x"]
    table = {n: (r.choice([301, 302, 302, 404, None]), r.choice([*names, *names, "http://gone.example/", None])) for n in r.sample(names, 28)}

    def walk(at):
        chain = [at]
        for k in range(most + 1):
            if at == "http://go.acme.com/Ab3d":
                return chain, "found"
            if k == most:
                return chain, "max_hops"
            if at == "http://video.example/x":
                return chain, "platform_host"
            status, to = table.get(at, (500, None))
            if (status or 0) >= 400:
                return chain, "error"
            if to is None or to in chain:
                return chain, "no_redirect"
            at = to
            chain.append(at)

    starts = [*names, "http://gone.example/"] * 2
    got = chains.follow(spark.createDataFrame([(n, "s.example") for n in starts], "url string, site string"), spark.createDataFrame([(n, s, t) for n, (s, t) in table.items()], "url string, status int, location string"), most).collect()
    assert len(got) == len(starts)
    for row in got:
        assert (list(row.chain), row.stop) == walk(row.start), row.start
        assert row.final_url == row.chain[-1]


def test_both_ways_to_fit_agree(spark):
    r = np.random.default_rng(5)
    points = [(f, float(round(v, 1)), float(r.uniform() < 0.6)) for f in ("a", "b", None) for v in r.normal(size=60)] + [("one", 1.0, 1.0), ("a", None, 1.0)]
    df = spark.createDataFrame(points, "f string, x double, y double")
    here, spread = calibrate.platt(df, "f", "x", "y"), calibrate.platt(df, "f", "x", "y", most=1)
    assert set(here) == set(spread) == {"a", "b", None, "one"}
    assert all(here[f] == pytest.approx(spread[f], abs=1e-6) for f in here)
    here, spread = calibrate.class_offsets(df, "f", "x", "y"), calibrate.class_offsets(df, "f", "x", "y", most=1)
    assert set(here) == set(spread) and all(here[f] == pytest.approx(spread[f], abs=1e-6) for f in here)
    whole = [(f, x, y) for f, x, y in points if x is not None]
    loo = calibrate.leave_one_out(df, "f", "x", "y", block=7).collect()
    assert sorted(str((q.family, q.x, q.y)) for q in loo) == sorted(map(str, whole))
    for f, x, y in (whole[0], whole[70], whole[130]):
        k = whole.index((f, x, y))
        own = [p for i, p in enumerate(whole) if p[0] == f and i != k]
        a, b = plain_fit(np.array([p[1] for p in own]), np.array([p[2] for p in own]), DEFAULT.thresholds.fit_prior)
        assert next(q.p for q in loo if (q.family, q.x, q.y) == (f, x, y)) == pytest.approx(1 / (1 + np.exp(-(a + b * x))), abs=1e-6)


def test_platt_equals_a_plain_fit(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=200)
    y = (r.uniform(size=200) < 1 / (1 + np.exp(-(0.5 + 1.5 * x)))).astype(float)
    df = spark.createDataFrame([("f", float(a), float(b)) for a, b in zip(x, y, strict=True)], "f string, x double, y double")
    a, b = calibrate.platt(df, "f", "x", "y")["f"]
    assert (a, b) == pytest.approx(plain_fit(x, y, DEFAULT.thresholds.fit_prior), abs=1e-6)
    p = 1 / (1 + np.exp(-(a + b * x)))
    assert (p - y).sum() + 4 * a == pytest.approx(0, abs=1e-4) and ((p - y) * x).sum() + 4 * (b - 1) == pytest.approx(0, abs=1e-4)
    off = calibrate.class_offsets(df.withColumn("z", F.lit(a) + F.lit(b) * F.col("x")), "f", "z", "y")["f"]
    assert abs(off) < 0.5
    loo = calibrate.leave_one_out(df.limit(20), "f", "x", "y", block=8).collect()
    xs, ys = np.array([w.x for w in loo]), np.array([w.y for w in loo])
    assert len(loo) == 20
    for k, row in enumerate(loo):
        qa, qb = plain_fit(np.delete(xs, k), np.delete(ys, k), 4.0)
        assert row.p == pytest.approx(1 / (1 + np.exp(-(qa + qb * xs[k]))))


def plain_fit(x, y, prior):
    a, b = 0.0, 1.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a + b * x)))
        w = p * (1 - p)
        h = np.array([[prior + w.sum(), (w * x).sum()], [(w * x).sum(), prior + (w * x * x).sum()]])
        step = np.linalg.solve(h, np.array([a * prior + (p - y).sum(), (b - 1) * prior + ((p - y) * x).sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).sum() < 1e-10:
            break
    return a, b


def test_the_last_record_is_that_of_the_later_file(spark, tmp_path):
    """Spark reads large files first; the order of names and lines counts all the same."""
    (tmp_path / "a.json").write_text('{"domain":"a","ts":"1","n":1}\n')
    (tmp_path / "b.json").write_text('{"domain":"a","ts":"1","n":2}\n' + '{"domain":"x","ts":"1","n":3}\n' * 500 + '{"domain":"x","ts":"1","n":4}\n')
    log = readers.read_json_log(spark, str(tmp_path), "domain string, ts string, n int")
    assert rows(keyed.latest(log.select("domain", "n", "ts", "ordinal"), ["domain"], ["ts", "ordinal"]).select("domain", "n")) == [("a", 2), ("x", 4)]
    with_blocks = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        log = readers.read_json_log(spark, str(tmp_path), "domain string, ts string, n int")
        assert [r.n for r in log.filter("domain = 'x'").orderBy("ordinal").collect()][-1] == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_blocks)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('// note\nk,v\n1,"x\ny"\n2,\n')
    assert rows(readers.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string", comment="/")) == [(1, "x\ny"), (2, None)]
    (tmp_path / "l.txt").write_text("A.example\n\n# c\na.example \nb.example\n")
    assert rows(readers.read_lines(spark, str(tmp_path / "l.txt"))) == [("a.example",), ("b.example",)]
    (tmp_path / "log.jsonl").write_text('{"domain":"a","ts":"1"}\n{"domain":"b"\n{"domain":"a","ts":"2"}\n')
    log = readers.read_json_log(spark, str(tmp_path / "log.jsonl"))
    assert [(r.domain, r.ts) for r in log.orderBy("ordinal").collect()] == [("a", "1"), ("a", "2")]
    assert readers.bad_lines(spark, str(tmp_path / "log.jsonl")).count() == 1
    data = gzip.compress(b"one\n") + gzip.compress(b"two\n") + gzip.compress(b"three\n" * 50)[:-12]
    assert readers.gunzip_members(data).startswith(b"one\ntwo\n") and readers.gunzip_members(b"") == b""
    (tmp_path / "m.gz").write_bytes(data)
    assert [r.value for r in readers.read_gzip_members(spark, str(tmp_path / "m.gz")).orderBy("line_no").limit(2).collect()] == ["one", "two"]
    (tmp_path / "html").mkdir()
    (tmp_path / "html/a.example__browser.html.gz").write_bytes(gzip.compress(b"<!-- saved browser 2026-01-02T03:04:05 status=200 final_url=http://a.example/ -->\n<p>x"))
    page = readers.read_saved_pages(spark, str(tmp_path / "html")).first()
    assert tuple(page) == ("a.example", "browser", "2026-01-02T03:04:05", 200, "http://a.example/", "<p>x")
    (tmp_path / "marks.json").write_text('{"_note":"n","a.example":"mono"}')
    assert rows(readers.read_keyed_json(spark, str(tmp_path / "marks.json"), "string")) == [("a.example", "mono")]
    df = spark.createDataFrame([(1, ["a", "b"], None)], "k int, tags array<string>, v string")
    sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "out"))) == [("1", "a b", None)]
    parts = list(sinks.markdown_parts(["x" * 40] * 5, most=100))
    assert "\n".join(parts) == "\n".join(["x" * 40] * 5) and all(len(p) <= 100 for p in parts)
    assert sinks.markdown_table(df).splitlines()[2] == "| 1 | a b |  |"


def test_answers(spark):
    import base64

    html = base64.b64encode(b"<p>hi</p>").decode()
    docs = "".join(f"<group><doc><url>http://a.example/{k}</url><title>&lt;b&gt;A&lt;/b&gt; {k}</title></doc></group>" for k in range(12))
    results = f"<results><grouping>{docs}</grouping></results>"
    ai = f"<ai><answer> {html} </answer><item><url>http://s.example/</url><title> S </title></item></ai><relatedQuestions><item><question>why</question></item><item/></relatedQuestions>"
    xmls = [f'<x><response date="d">{ai}{results}</response></x>', '<x><response><error code="7"> none </error></response></x>', "<x><resp", None, "<x><response><ai><answer>!</answer></ai></response></x>"]
    found = readers.parse_answers(spark.createDataFrame([(k, x, "clash") for k, x in enumerate(xmls)], "id int, xml string, response string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 or plan.count("xmltostructs") == 1
    got = {r.id: r for r in found.collect()}
    assert got[0].answer == "<p>hi</p>" and got[0].date == "d" and got[0].error is None and got[0].related == ["why"]
    assert [tuple(x) for x in got[0].sources] == [("http://s.example/", "S", None)]
    assert [tuple(x) for x in got[0].organic] == [(k + 1, f"http://a.example/{k}", f"A {k}") for k in range(10)]
    assert [got[k].error for k in (1, 2, 3, 4)] == ["7: none", "xml", None, "b64"]
    assert not got[1].ai_present and got[4].ai_present and got[2].organic == [] and got[3].sources == []


def test_answers_are_parsed_by_all_cores(spark):
    from tessera.plans import q_files

    found = q_files.answer_documents(spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    rows_of = {r.k: r for r in found.collect()}
    lines = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_orderkey").count().collect()}
    assert len(rows_of) == 1500 and all(r.found == (0 if k % 11 == 1 else min(10, lines.get(k, 0))) for k, r in rows_of.items())


def test_sitemaps(spark):
    maps = [("s", "http://s/m.xml", True, "<loc>http://s/n.xml</loc><loc>http://s/a</loc>"), ("s", "http://s/n.xml", False, "<loc>http://s/b</loc><loc>http://s/a</loc>")]
    got = readers.sitemap_pages(spark.createDataFrame(maps, "site string, url string, root boolean, xml string"))
    assert [(r.url, r.level) for r in got.orderBy("rank").collect()] == [("http://s/a", 0), ("http://s/b", 1)]


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "k string, ts int, o int"
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    for n, part in enumerate(['{"k":"a","ts":1,"o":1}\n{"k":"b","ts":5,"o":2}\n', '{"k":"a","ts":3,"o":3}\n{"k":"b","ts":4,"o":4}\n{"k":"c","ts":1,"o":5}\n']):
        (source / f"{n}.json").write_text(part)
        stream.latest_stream(spark, str(source), schema, ["k"], ["ts", "o"], out, check).awaitTermination(120)
    batch = keyed.latest(spark.read.schema(schema).json(str(source)), ["k"], ["ts", "o"])
    assert rows(stream.read_latest(spark, out, schema)) == rows(batch)
    counted = stream.windowed_counts(spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), "x"), (dt.datetime(2024, 1, 1, 0, 50), "x")], "ts timestamp, e string"), "ts", "e")
    assert [r.n for r in counted.collect()] == [2]


def test_scan_report(spark):
    from tessera.operators import scan

    schema = f"ordinal long, {readers.SCAN_RECORD}"
    dest = lambda kind, brand: ("http://t.example/?aff=1", "link", "http://x.example/", kind, brand, "assets", "1", True, "", [(200, "http://t.example/?aff=1", None, None)])
    home = ("http://a.example/", 200, "A", 900, 3, 9, 0, None, None)
    recs = [(1, "a.example", "1", "n", "browser", home, [dest("target", "Acme")], None), (2, "a.example", "2", "n", "browser", home, [dest("other", "Globex")], None), (3, "b.example", "1", "n", "http", ("http://b.example/", 200, "B", 900, 3, 9, 2, None, None), [], None), (4, "c.example", "1", "n", "http", (None, 200, "", 9, 0, 0, 0, None, None), [], None)]
    got = {r.domain: r for r in scan.scan_report(spark.createDataFrame(recs, schema)).collect()}
    a = got["a.example"]
    assert (a.group, a.group_now, a.ever_brands, a.ever_pids, a.n_records, a.ads_differ, a.group_history) == ("4_mixed", "3_other_only", ["Globex"], ["1"], 2, True, "1_target_only > 3_other_only")
    assert got["b.example"].group == "7_unresolved" and got["b.example"].incomplete == ["js_buttons_not_clicked=2"] and got["c.example"].group == "8_no_mention"
    df = spark.createDataFrame([("a.example", "http://q.example/p", "unknown", "", None), ("b.example", "http://q.example/p", "needs_browser", "", None), ("a.example", "http://r.example/", "other", "G", "f")], "domain string, url string, kind string, brand string, final_url string")
    filled = scan.fill_from_cache(df, spark.createDataFrame([("http://q.example/p", "other", "Hooli", "http://h.example/")], "key string, kind string, brand string, final_url string"))
    assert {(r.domain, r.kind, r.brand) for r in filled.collect()} == {("a.example", "other", "Hooli"), ("b.example", "other", "Hooli"), ("a.example", "other", "G")}


def test_corpus_pieces(spark):
    from tessera.operators import corpus

    answers = spark.createDataFrame([("KZ", " Best Site ", True), ("KZ", "x", True), ("KZ", "y", False)], "cc string, query string, present boolean")
    classes = spark.createDataFrame([("KZ", "best site", True, "negative"), ("KZ", "X", True, "positive")], "cc string, query string, mentioned boolean, sentiment string")
    assert [r.query for r in corpus.problem_answers(answers, classes).collect()] == [" Best Site "]
    reqs = spark.createDataFrame([("KZ", "A", "d", 2), ("KZ", " a", "d", 1), ("UZ", "a", "d", 3)], "cc string, query string, device string, ordinal int")
    assert rows(corpus.request_keys(reqs).select("cc", "ordinal")) == [("KZ", 1), ("UZ", 3)]
    pages = spark.createDataFrame([("u", "globex first, then acme is bad")], "url string, text string")
    got = corpus.page_analysis(pages, [("acme", "acme"), ("globex", "globex")], "acme", "bad").first()
    assert got.brands_order == ["globex", "acme"] and got.target_rank == 2 and got.neg_near == 1 and got.words == 6
    keys = spark.createDataFrame([("acme вход", 20), ("acme", 5), ("вход цена", 50)], "keyword string, volume int")
    assert rows(corpus.selected(keys, "[а-я]", "^$", [("price", "цена")], "вход").select("keyword", "theme")) == [("вход цена", "price")]


def test_classify(spark):
    from tessera.operators import classify

    scan_side = {"final_url": "", "home_group": None, "scan_method": None, "ref_method": None, "pids": "", "brands": "", "group": "2_no_ads", "group_history": "", "reason": "", "http_status": "200", "scan_title": "", "scan_text": "", "has_page": True, "has_features": True, "from_scan": False, "parked": False, "shell": False, "assets": False, "cloaked": "", "pwa": False, "platform": False, "ads_differ": False, "referrer_js": False, "mode": "http"}
    made = [
        ("acme.m.example", {"mentions": 9, "density": 2.0, "topic_density": 6.0}, ["http://new.example/"]),
        ("d.example", {"group": "5_dead", "reason": "timeout", "has_page": False, "text_len": 0}, []),
        ("acme.r.example", {"mentions": 3, "topic_density": 9.0, "density": 1.0}, []),
        ("p.example", {"mentions": 1, "date_links": 9}, []),
    ]
    df = None
    for domain, change, chain in made:
        texts = {k: v for k, v in (scan_side | {k: v for k, v in change.items() if k in scan_side}).items()}
        one = site_row(spark, domain=domain, **{k: v for k, v in change.items() if k not in scan_side}).drop("target", "other_names", "plain_names", "moved")
        empty = F.array().cast("array<string>")
        one = one.select("*", *[F.lit(v).cast("string").alias(k) if v is None else F.lit(v).alias(k) for k, v in texts.items()], *[empty.alias(k) for k in ("visitor_tags", "apk", "gates", "trackers", "incomplete", "hidden_hosts")], F.array(*[F.lit(c) for c in chain]).cast("array<string>").alias("chain"), F.array().cast("array<struct<url:string,host:string,brand:string,ref_kind:string,hidden:boolean>>").alias("aff_links"))
        df = one if df is None else df.unionByName(one)
    dests = spark.createDataFrame([("acme.m.example", 1, "http://g.example/?aff=1", "http://globex.example/", "link", "other", "Globex", "fields:x", "", True, []), ("p.example", 1, "http://h.example/x?aff=1", "http://hooli.example/", "deep", "internal", "", "", "", False, [])], "domain string, ordinal int, url string, final_url string, via string, kind string, brand string, evidence string, pid string, ad_route boolean, hops array<string>")
    verdicts = spark.createDataFrame([("d.example", "dead", "wrong", "stub"), ("acme.m.example", "bait", "wrong", "x")], "domain string, given string, verdict string, should_be string")
    pages = spark.createDataFrame([("p.example", 1, "http://p.example/acme", "Acme guide", [("http://hooli.example/play", False)], [])], "domain string, ordinal int, page string, title string, links array<struct<url:string,hidden:boolean>>, script_urls array<string>")
    got = classify.classify(df, dests, verdicts, pages)
    found = {r.domain: r for r in got.sites.collect()}
    m = found["acme.m.example"]
    assert (m.category, m.other, m.check, m.why) == ("mono_other", ["Globex"], None, "name_in_domain") and m.tags == ["brand_in_domain"]
    assert found["d.example"].rule_category == "dead" and found["d.example"].category == "stub" and found["d.example"].check == "fixed"
    assert found["acme.r.example"].category == "mono_no_ads"
    assert found["p.example"].category == "page_other" and found["p.example"].other == ["Hooli"]
    assert rows(got.moves) == [("new.example", "mono_other")]


def test_scores(spark):
    from tessera.operators import scores

    cols = {"category": "mono_other", "why": "name_in_domain", "title": "", "target": False, "target_links": 0, "density": 2.0, "text_len": 5000, "topic_density": 0.0, "feed_links": 0, "shared_tracker": False, "single_template": False}
    links = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("u").alias("url"), F.lit("f").alias("final")) for n in ("Globex", "Hooli")])

    def make(tags, **c):
        return spark.range(1).select(*[F.lit(v).alias(k) for k, v in (cols | c).items()], F.array(*map(F.lit, tags)).cast("array<string>").alias("tags"), F.array(F.lit("Globex"), F.lit("Hooli")).alias("other"), links.alias("other_links"))

    r = scores.raw_score(make(["cloaked:bot"])).first()
    assert r.raw == pytest.approx(0.91) and r.minus == ["seen by one visitor only"]
    r = scores.raw_score(make([], category="unclear", title="Access denied")).first()
    assert r.raw == 0.05 and r.minus == ["a block page"]
    now = spark.createDataFrame([("a", "mono_other"), ("b", "dead"), ("c", "dead")], "domain string, category string")
    verdicts = spark.createDataFrame([("a", "mono_other", "correct", None, 1, 1), ("a", None, "unsure", None, 2, 1), ("b", "dead", "wrong", "stub", 1, 1), ("z", "dead", "correct", None, 1, 1)], "domain string, given string, verdict string, should_be string, round int, ordinal int")
    lab = scores.labels(verdicts, now)
    assert rows(lab) == [("a", "mono_other", "mono_other", True), ("b", "dead", "stub", False)]
    out = {r.domain: r.confidence for r in scores.calibrated(now.withColumn("raw", F.lit(0.8)), lab).collect()}
    assert out["a"] > 0.8 > out["b"] == out["c"]


def test_candidates(spark):
    from tessera.operators import scan

    urls = ["http://s.example/about", "http://globex.example/1", "http://globex.example/2", "http://globex.example/3", "http://globex.example/4", "http://x7q.example/Ab3d", "http://s.example/go/x", "http://plain.example/"]
    df = spark.createDataFrame([("s.example", u, "a", k) for k, u in enumerate(urls)], "domain string, url string, source string, ordinal int")
    got = [r.url for r in scan.pick_candidates(df).orderBy("rank").collect()]
    assert got == [urls[5], urls[6], *urls[1:4]]


def test_many_destinations_of_a_record_take_time_in_proportion(spark):
    import time

    n = 30_000
    one = lambda k: F.struct(k.cast("string").alias("url"), F.lit("other").alias("kind"), F.lit("Globex").alias("brand"), F.when(k % 3 == 0, "timeout").otherwise("x").alias("evidence"))
    records = spark.createDataFrame([("a",), ("b",)], "domain string").select("domain", F.transform(F.sequence(F.lit(1), F.lit(n)), one).alias("dests"))
    later = spark.createDataFrame([("b", [("u", "target", "", "x"), ("v", "dead", None, None)])], "domain string, dests array<struct<url:string,kind:string,brand:string,evidence:string>>")
    began = time.time()
    found = {r.domain: r for r in groups.regroup(records, later).select("domain", "group", "other_brands", "unresolved", F.size("dests").alias("n")).collect()}
    assert time.time() - began < 15
    assert (found["a"].group, found["a"].other_brands, found["a"].unresolved, found["a"].n) == ("3_other_only", ["Globex"], 0, n - n // 3)
    assert (found["b"].group, found["b"].other_brands, found["b"].unresolved, found["b"].n) == ("4_mixed", ["Globex"], 1, n - n // 3 + 2)
