"""Joins, sets, aggregates, top-k, samples and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.keyed import numbered
from tessera.space import broadcast_if_small, cut


# Joins -------------------------------------------------------------------------------------------------------------


def outer_by_key(tables: Sequence[DataFrame], key: str, extra: Sequence[DataFrame] = ()) -> DataFrame:
    """JN1: a full outer join of all tables by key, then left joins of extra."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full_outer")
    for t in extra:
        out = out.join(t, key, "left")
    return out


def lookup(df: DataFrame, table: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """JN2: a left join with defaults where the key is not found."""
    return df.join(table, key, "left").na.fill(defaults)


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """JN3, IN1: rows whose key the other table does not have."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def only(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """JN4: rows whose key the other table has."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def grouped_lookup(df: DataFrame, many: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """JN5: the many rows of each key as one ordered array."""
    rest = [c for c in many.columns if c != key]
    rows = many.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in rest if c not in order]))).alias(name))
    return df.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))


def by_normal_key(a: DataFrame, b: DataFrame, exact: str, text: str, how: str = "inner") -> DataFrame:
    """JN6: equal on one column, and on another one trimmed and lower-cased."""
    right = b.withColumnsRenamed({exact: "_exact", text: "_text"})
    met = (F.col(exact) == F.col("_exact")) & (F.lower(F.trim(F.col(text))) == F.lower(F.trim(F.col("_text"))))
    return a.join(right, met, how).drop("_exact", "_text")


def by_keyword(a: Column) -> Column:
    """TK1: a sort key in which null is the empty text, so that it comes first and meets other empty ones."""
    return F.coalesce(a.cast("string"), F.lit(""))


def overlay(df: DataFrame, verdicts: DataFrame, key: str, given: str, value: str, out: str = "final") -> DataFrame:
    """JN9, DC20: a verdict replaces a class only where it was given for that class; check says what happened."""
    v = verdicts.select(F.col(key).alias("_k"), F.col("given").alias("_given"), F.col("verdict").alias("_verdict"), F.col("should_be").alias("_to"))
    j = df.join(v, (F.col(key) == F.col("_k")) & (F.col(given) == F.col("_given")), "left")
    fixed = (F.col("_verdict") == "wrong") & F.col("_to").isNotNull()
    check = F.when(F.col("_verdict").isNull(), F.lit(None).cast("string")).when(fixed, "fixed").when(F.col("_verdict") == "correct", "confirmed").otherwise("unsure")
    return j.withColumn(out, F.when(fixed, F.col("_to")).otherwise(F.col(value))).withColumn("check", check).drop("_k", "_given", "_verdict", "_to")


def agreement(truth: DataFrame, found: DataFrame, key: str, unsure: str = "unsure") -> DataFrame:
    """JN10, ML6: agree, disagree, unsure and missing over the truth's rows, and the share of agreement among decided."""
    t, f = truth.select(key, F.col("value").alias("_t")), found.select(key, F.col("value").alias("_f"))
    j = t.join(f, key, "left")
    decided = F.col("_f").isNotNull() & (F.col("_f") != unsure)
    agg = j.agg(F.count_if(decided & (F.col("_t") == F.col("_f"))).alias("agree"), F.count_if(decided & (F.col("_t") != F.col("_f"))).alias("disagree"), F.count_if(F.col("_f") == unsure).alias("unsure"), F.count_if(F.col("_f").isNull()).alias("missing"))
    return agg.withColumn("rate", F.when(F.col("agree") + F.col("disagree") > 0, F.col("agree") / (F.col("agree") + F.col("disagree"))))


# Sets --------------------------------------------------------------------------------------------------------------


def union_by_name(tables: Sequence[DataFrame], fill: str | None = None) -> DataFrame:
    """ST1, ST7: all rows; columns that a table lacks are null, or fill for text."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out if fill is None else out.na.fill(fill)


def three_way(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """ST3, AG22: every key with its status both, left or right."""
    left, right = a.select(key).distinct().withColumn("_l", F.lit(1)), b.select(key).distinct().withColumn("_r", F.lit(1))
    status = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both").when(F.col("_l").isNotNull(), "left").otherwise("right")
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def one_sided_hosts(df: DataFrame, host: str, is_target: Column, excluded: DataFrame | None = None) -> DataFrame:
    """AG13: hosts that lead to the target and to nobody else, less the excluded ones."""
    sides = df.groupBy(host).agg(F.bool_or(is_target).alias("_t"), F.bool_or(~is_target).alias("_o")).filter("_t AND NOT _o").select(host)
    return sides if excluded is None else sides.join(excluded.select(host), host, "left_anti")


# Aggregates --------------------------------------------------------------------------------------------------------


def floor_percent(part: Column, whole: Column) -> Column:
    """AG8: floor(100 * part / max(1, whole)) of whole numbers."""
    return F.floor(100 * part / F.greatest(F.lit(1), whole))


def majority(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """AG18: the most frequent value of each key; of equally frequent ones the one seen first."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counted.groupBy(key).agg(F.max_by(F.struct(value, "n"), F.struct(F.col("n"), -F.col("_first"))).alias("_b")).select(key, F.col(f"_b.{value}").alias(value), F.col("_b.n").alias("n"))


def share_of_total(df: DataFrame, value: str, within: Sequence[str] = ()) -> DataFrame:
    """AG10, AG21: value as a share of the sum of all rows, or of a group's. For tables that are aggregates already."""
    return df.withColumn("share", F.col(value) / F.sum(value).over(Window.partitionBy(*within)))


def risk_bins(df: DataFrame, p: str, ok: str, bins: int = 5) -> DataFrame:
    """AG17: bins of a probability with their number, hits and summed probability."""
    k = F.least(F.lit(bins - 1), F.floor(F.col(p) * bins)).cast("int")
    return df.groupBy(k.alias("bin")).agg(F.count("*").alias("n"), F.sum(F.col(ok).cast("int")).alias("hits"), F.sum(p).alias("p_sum"))


def site_group(df: DataFrame, key: str, kind: str, brand: str, target: str = "target", other: str = "other", most: int = 30) -> DataFrame:
    """AG15: the group of each site by whom it advertises, and the sorted brands of the others."""
    has_t, has_o = F.bool_or(F.col(kind) == target), F.bool_or(F.col(kind) == other)
    brands = F.slice(F.array_sort(F.collect_set(F.when((F.col(kind) == other) & (F.col(brand) != ""), F.col(brand)))), 1, most)
    g = df.groupBy(key).agg(F.coalesce(has_t, F.lit(False)).alias("_t"), F.coalesce(has_o, F.lit(False)).alias("_o"), brands.alias("other_brands"))
    group = F.when(F.col("_t") & F.col("_o"), "4_mixed").when(F.col("_t"), "1_target_only").when(F.col("_o"), "3_other_only").otherwise("2_no_ads")
    return g.select(key, group.alias("group"), "other_brands")


# Order, samples, batches -------------------------------------------------------------------------------------------


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """TK4, TK9: the first k rows of each group; the order must break all ties."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= k)


def top_entries(counts: Column, k: int) -> Column:
    """TK5: the k largest entries of a map, ties by key, as an array of structs key, value."""
    pairs = F.transform(F.map_entries(counts), lambda e: F.struct((-e["value"]).alias("_v"), e["key"].alias("key"), e["value"].alias("value")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def slice_of(rank: Column, n: Column, k: int) -> Column:
    """TK6: which of k slices [i * n // k, (i + 1) * n // k) holds a rank that counts from 0."""
    return F.floor(((rank + 1) * k - 1) / n).cast("int")


def stratified_sample(df: DataFrame, strata: Sequence[str], order: Sequence[str], key: str, k: int, seed: int = 1) -> DataFrame:
    """TK6: each stratum is sorted and cut into k slices, and one row of each is drawn by a seeded hash of its key.

    Places within a stratum are places in the whole sorted table less the stratum's first one, so that no task ranks a whole
    stratum; the draw is an aggregate.
    """
    parts = [F.col(f"`{c}`") for c in strata]
    ranked = cut(numbered(df, [*strata, *order], "_n"))
    whole = ranked.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(parts)]).agg(F.min("_n").alias("_first"), F.count("*").alias("_size"))
    same = [c.eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(parts)]
    j = ranked.join(broadcast_if_small(whole, 100_000), same).withColumn("_r", F.col("_n") - F.col("_first"))
    part = F.when(F.col("_size") <= k, F.col("_r")).otherwise(slice_of(F.col("_r"), F.col("_size"), k)).cast("int")
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{key}`").cast("string")).cast("binary"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns], part.alias("slice"))
    drawn = j.groupBy(*[F.col(f"_k{i}") for i in range(len(parts))], part.alias("_slice")).agg(F.min_by(row, F.struct(draw, key)).alias("_row"))
    return drawn.select("_row.*")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """TK7: n rows without replacement, the first by a seeded hash of the key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def control_sample(df: DataFrame, key: str, refuted: Column, n: int, seed: int = 1) -> DataFrame:
    """TK7: a control set of n rows: a third (or all, if there are fewer) refuted ones, the rest of the others."""
    no = seeded_sample(df.filter(refuted), key, n // 3, seed)
    have = no.count()
    return no.unionByName(seeded_sample(df.filter(~refuted), key, n - have, seed))


def in_batches(df: DataFrame, rank: str, size: int) -> DataFrame:
    """TK11, SNK4: batch_id of rows numbered from 1."""
    return df.withColumn("batch_id", F.floor((F.col(rank) - 1) / size))


def round_robin(df: DataFrame, rank: str, n: int) -> DataFrame:
    """TK10."""
    return df.withColumn("bucket", F.pmod(F.col(rank), F.lit(n)))


def priority(reason: Column, rules: Sequence[tuple[str, int]], default: int) -> Column:
    """WN10: the bucket of a queue entry by the first pattern its reason matches."""
    out = None
    for rx, bucket in rules:
        out = F.when(reason.rlike(rx), bucket) if out is None else out.when(reason.rlike(rx), bucket)
    return F.lit(default) if out is None else out.otherwise(default)


def column_identity(df: DataFrame, a: str, b: str, c: str) -> DataFrame:
    """MT2: rows where a - b differs from c."""
    return df.filter((F.col(a) - F.col(b)) != F.col(c))


def share_at_last(df: DataFrame, month: str, part: str, whole: str) -> DataFrame:
    """MT2: part as a share of whole in the last month; null where whole is 0."""
    last = df.agg(F.max_by(F.struct(month, part, whole), month).alias("l")).select("l.*")
    return last.withColumn("share", F.try_divide(F.col(part), F.col(whole)))


def shared_donors(links: DataFrame, donor: str, target: str, rating: str, k: int) -> tuple[DataFrame, DataFrame]:
    """MT7: donors that link to several targets (donor, targets), and the k best-rated donors of each target."""
    pairs = links.groupBy(donor, target).agg(F.max(rating).alias(rating))
    shared = pairs.groupBy(donor).agg(F.count("*").alias("targets")).filter("targets > 1")
    return shared, top_per_group(pairs, [target], [F.desc_nulls_last(rating), F.col(donor)], k)


def peak(df: DataFrame, month: str, value: str) -> DataFrame:
    """MT1: the peak month and value, the last value and its ratio to the peak; of equal peaks the earliest."""
    best = F.max_by(F.struct(month, value), F.struct(F.col(value), -F.unix_date(F.to_date(month))))
    return df.agg(best.alias("_b"), F.max_by(value, month).alias("last")).select(F.col(f"_b.{month}").alias("peak_month"), F.col(f"_b.{value}").alias("peak"), "last", (F.col("last") / F.col(f"_b.{value}")).alias("ratio"))


def hreflang_checks(pairs: DataFrame) -> DataFrame:
    """MT12: page, code, href -> per page: self reference, x-default, invalid codes, links that are not returned."""
    back = pairs.select(F.col("page").alias("_from"), F.col("href").alias("_to")).distinct()
    j = pairs.join(back, (F.col("href") == F.col("_from")) & (F.col("page") == F.col("_to")), "left")
    valid = F.col("code").rlike(r"^([a-z]{2,3}(-[a-z]{2,4})?|x-default)$")
    return j.groupBy("page").agg(F.bool_or(F.col("href") == F.col("page")).alias("self_reference"), F.bool_or(F.col("code") == "x-default").alias("x_default"), F.count_if(~valid).alias("invalid_codes"), F.count_if(F.col("_from").isNull()).alias("not_returned"))


def page_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """MT10: two captures of pages (url, html) side by side: status (both, left or right), what each shows, and which fields
    changed. Words, headings, tables and numbers like 1.85 are counted, head fields compared."""
    from tessera.functions import html as H

    counts = ("words", "n_h2", "n_tables", "n_odds")
    heads = ("h1", "title", "description", "canonical")

    def read(df: DataFrame, tag: str) -> DataFrame:
        h = F.col("html")
        meta = F.regexp_extract(F.regexp_extract(h, r'(?i)(<meta[^>]*\bname="description"[^>]*>)', 1), r'(?i)content="([^"]*)"', 1)
        bare = F.regexp_replace(F.regexp_replace(h, r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " "), r"<[^>]*>", " ")
        fields = df.select("url", *H.head_fields(h), F.regexp_count(h, F.lit(r"(?i)<table[\s>]")).alias("n_tables"), F.regexp_count(bare, F.lit(r"\b\d\.\d\d\b")).alias("n_odds"), meta.alias("description"))
        return fields.select(F.col("url").alias(f"_url_{tag}"), *[F.col(c).alias(f"{c}_{tag}") for c in (*counts, *heads)])

    a, b = read(before, "before"), read(after, "after")
    j = a.join(b, F.col("_url_before") == F.col("_url_after"), "full_outer")
    status = F.when(F.col("_url_before").isNull(), "right").when(F.col("_url_after").isNull(), "left").otherwise("both")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after")), F.lit(c)) for c in (*counts, *heads)]))
    kept = [f"{c}_{tag}" for c in counts for tag in ("before", "after")]
    return j.select(F.coalesce("_url_before", "_url_after").alias("url"), status.alias("status"), *kept, F.when(status == "both", F.array_join(changed, " ")).otherwise("").alias("changed"))


def audit_flags(pages: DataFrame, least_words: int = 300) -> DataFrame:
    """MT11: page_id, missing_h1, missing_title, shared_title, few_words, images, missing_alt, technical_alt of pages (page_id,
    html). An alt text is technical if it is a file name, a bare number or an identifier with underscores. Titles are
    counted before the join: a window would bring all pages of one title into one task."""
    from tessera.functions import html as H

    images = F.regexp_extract_all(F.col("html"), F.lit(r"(?i)(<img[^>]*>)"), F.lit(1))
    alt = lambda t: F.regexp_extract(t, r'(?i)\balt="([^"]*)"', 1)
    own = pages.select("page_id", *H.head_fields(F.col("html")), images.alias("_i"))
    again = own.filter("title <> ''").groupBy("title").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("title").alias("_t"))
    met = own.join(again, F.col("title") == F.col("_t"), "left")
    bad = r"(?i)\.(png|jpe?g|gif|webp|svg)$|^[0-9]+$|^[a-z0-9]+(_[a-z0-9]+)+$"
    return met.select(
        "page_id",
        (~F.col("has_h1")).alias("missing_h1"),
        (F.col("title") == "").alias("missing_title"),
        F.col("_t").isNotNull().alias("shared_title"),
        (F.col("words") < least_words).alias("few_words"),
        F.size("_i").alias("images"),
        F.size(F.filter("_i", lambda t: alt(t) == "")).alias("missing_alt"),
        F.size(F.filter("_i", lambda t: alt(t).rlike(bad))).alias("technical_alt"),
    )
