"""Quality rules by distribution divergence, in DataFrame functions alone.

The character classes and the common words of a document are compared with the references of its language by the
Jensen-Shannon distance; short documents are guarded. Counts of words, symbols, repeated lines and repeated windows make
the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, broadcast_if_small, cut

#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
COMMON = (
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "was",
    "der", "die", "und", "das", "von", "zu", "nicht", "ist", "mit", "den",
    "le", "les", "des", "et", "est", "que", "pour", "dans", "une", "du",
    "el", "los", "las", "y", "del", "por", "con", "una", "para", "se", "de", "la", "en",
    "il", "di", "che", "non", "per", "sono", "della", "os", "não", "uma", "com", "mais", "em", "het", "een", "van", "dat", "niet", "zijn",
)
#: Character classes of words, taken off in turn; what is left over is the last class.
CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\-]+", r"[^\x00-\x7F]+")
WINDOW = 5
#: Share of common words below which a reference says nothing about a text without them.
LEAST_COMMON = 0.05


def _windows(words: Column, n: Column) -> Column:
    """64-bit hashes of all windows of WINDOW words; null where a text has one window at most."""
    return F.when(n > WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))


def base_counts(docs: DataFrame, carried: list[str]) -> DataFrame:
    """One row per row of docs: a struct named row with the columns carried, then words (array) and the base counts.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long); a null or blank text has none of them.
    """
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("t"))
    split = plain.withColumn("words", F.array_remove(F.split("t", SPACE), "")).withColumn("n", F.size("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    made = split.withColumn("joined", F.array_join("words", "")).withColumn("lines", lines).withColumn("grams", _windows(F.col("words"), F.col("n")))
    n_grams = F.size("grams")
    pairs = F.when(n_grams > F.size(F.array_distinct("grams")), F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    made = made.withColumn("pairs", pairs)
    again = F.filter("pairs", lambda p, k: F.coalesce(p["g"] == F.get("pairs", k - 1)["g"], F.lit(False)) | F.coalesce(p["g"] == F.get("pairs", k + 1)["g"], F.lit(False)))
    made = made.withColumn("starts", F.when(F.col("pairs").isNotNull(), F.sort_array(F.transform(again, lambda p: p["i"]))))
    widths = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - s, F.lit(WINDOW))).cast("long"))
    covered = F.coalesce(F.aggregate(widths, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    return made.select(
        "row",
        "lang",
        "words",
        "joined",
        F.col("n").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        F.regexp_count(F.col("t"), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def histograms(counted: DataFrame) -> DataFrame:
    """Adds chars and common (arrays of long): characters per class, and common words with all other words last."""
    rest, left = F.col("joined"), counted
    names = []
    for k, pattern in enumerate(CLASSES):
        left = left.withColumn(f"_r{k}", F.regexp_replace(rest, pattern, ""))
        names.append((F.length(rest) - F.length(f"_r{k}")).cast("long"))
        rest = F.col(f"_r{k}")
    chars = F.array(*names, F.length(rest).cast("long"))
    left = left.withColumn("chars", chars)
    #: The common words of a text stand in one string, each between blanks of its own, so that their number shows in
    #: what is left without them.
    found = F.transform(F.filter("words", lambda w: F.lower(w).isin(*COMMON)), lambda w: F.lower(w))
    left = left.withColumn("n_found", F.size(found)).withColumn("found", F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" ")))
    each = [((F.octet_length("found") - F.octet_length(F.replace("found", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long") for w in COMMON]
    return left.withColumn("common", F.array(*each, F.col("n_words") - F.col("n_found")))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """The Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def _measured(docs: DataFrame, carried: list[str]) -> DataFrame:
    made = histograms(base_counts(docs, carried))
    #: seq is not deterministic, so no filter that needs it moves below and evaluates the counts again.
    return made.select("row", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common", F.monotonically_increasing_id().alias("seq"))


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def references(measured: DataFrame, ref_words: int = 20) -> DataFrame:
    """One row per language: the summed histograms, as shares, of its documents of at least ref_words words that pass the
    base rules, so that repeated windows do not make the reference."""
    chars, common = range(len(CLASSES) + 1), range(len(COMMON) + 1)
    sound = (F.col("n_words") >= ref_words) & ~_base_failed()
    counts = lambda c, k: F.sum(F.when(sound, F.col(c)[k]).otherwise(F.lit(0)))
    known = F.count_if(sound).alias("docs")
    ref = measured.groupBy("lang").agg(known, *[counts("chars", k).alias(f"a{k}") for k in chars], *[counts("common", k).alias(f"b{k}") for k in common]).filter("docs > 0")
    shares = ref.select(
        F.col("lang").alias("ref_lang"),
        _shares(F.array(*[F.col(f"a{k}") for k in chars])).alias("ref_chars"),
        _shares(F.array(*[F.col(f"b{k}") for k in common])).alias("ref_common"),
    )
    #: How far a text without any common word lies.
    return shares.withColumn("far_common", js_distance(F.array(*[F.lit(0.0)] * len(COMMON), F.lit(1.0)), F.col("ref_common")))


def judge(measured: DataFrame, ref: DataFrame, min_words: int = 50, max_char: float = 0.32, max_common: float = 0.45, common_share: float = 0.8, short_share: float = 0.9, short_words: int = 100) -> DataFrame:
    """row, the base counts, char_distance, common_distance, base_failed and kept of every measured document.

    base_failed: n_words < 10 or 100 * n_repeat_words > 20 * n_words. A document of at least min_words words must lie
    within max_char and max_common of the references of its language, and its common_distance within common_share
    (short_share below short_words words) of the distance of a text without any common word, where the reference holds at
    least LEAST_COMMON of them. Shorter documents are not judged by distance. reference says what a language is judged by:
    "none", "characters" (its common words are not known here) or "characters and words". A null language is a language of its own. Null, empty and blank texts fail
    the base rules. Repeated rows are judged alike; an empty table gives no rows.
    """
    joined = measured.join(ref, measured.lang.eqNullSafe(ref.ref_lang), "left")
    far = joined.withColumn("char_distance", js_distance(_shares(F.col("chars")), F.col("ref_chars"))).withColumn("common_distance", js_distance(_shares(F.col("common")), F.col("ref_common")))
    base = _base_failed()
    close = (F.coalesce("char_distance", F.lit(0.0)) <= max_char) & (F.coalesce("common_distance", F.lit(0.0)) <= max_common)
    share = F.when(F.col("n_words") < short_words, short_share).otherwise(common_share)
    known = F.element_at("ref_common", -1) <= 1 - LEAST_COMMON
    close &= ~F.coalesce(known & (F.col("common_distance") > share * F.col("far_common")), F.lit(False))
    reference = F.when(F.col("ref_common").isNull(), "none").when(known, "characters and words").otherwise("characters")
    near = (F.col("n_words") < min_words) | close
    return far.select("row", "seq", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "common_distance", reference.alias("reference"), base.alias("base_failed"), (~base & near).alias("kept"))


def report(docs: DataFrame, **limits: float) -> DataFrame:
    """doc_id, the base counts, the two distances (six digits), base_failed and kept of every row; each text is read once."""
    measured = cut(_measured(docs.select("doc_id", "text", "lang"), ["doc_id"]))
    found = judge(measured, broadcast_if_small(cut(references(measured)), 10_000), **limits)
    found = found.withColumns({c: F.round(c, 6) for c in ("char_distance", "common_distance")})
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), *[c for c in found.columns if c not in ("row", "seq")])


def passed(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of docs that judge keeps, with all their columns. Texts are read twice, so that none is checkpointed."""
    slim = cut(_measured(docs.select("doc_id", "text", "lang"), ["doc_id"]).select("lang", "n_words", "n_repeat_words", "chars", "common"))
    ref = broadcast_if_small(cut(references(slim)), 10_000)
    found = judge(_measured(docs, docs.columns), ref, **limits).filter("kept AND seq >= 0")
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _sql(min_words: int = 50, ref_words: int = 20, max_char: float = 0.32, max_common: float = 0.45, common_share: float = 0.8, short_share: float = 0.9, short_words: int = 100) -> str:
    rest, chars, steps = "j", [], []
    for k, pattern in enumerate(CLASSES):
        quoted = pattern.replace("'", "''")
        steps.append(f"c{k} AS (SELECT *, regexp_replace({rest}, '{quoted}', '', 'g') AS r{k} FROM {'w' if not k else f'c{k - 1}'})")
        chars.append(f"length({rest}) - length(r{k})")
        rest = f"r{k}"
    chars.append(f"length({rest})")
    common = [f"len(list_filter(low, lambda x: x = '{w}'))" for w in COMMON]
    others = f"len(list_filter(low, lambda x: x NOT IN ({', '.join(repr(w) for w in COMMON)})))"
    part = lambda a, b: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), w AS (
  SELECT *, len(words) AS n_words, array_to_string(words, '') AS j, list_transform(words, lambda x: lower(x)) AS low,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i + 1:i + 5]) AS n FROM (SELECT rid, words, unnest(range(0, len(words) - 4)) AS i FROM d WHERE len(words) > 5)
), r AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY rid
), {", ".join(steps)}, h AS (
  SELECT c.rid, lang, n_words, n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS failed, [{", ".join(chars)}] AS chars, [{", ".join(common)}, {others}] AS common FROM c{len(CLASSES) - 1} c LEFT JOIN r ON c.rid = r.rid
), v AS (
  SELECT rid, lang, n_words, failed, 'chars' AS kind, unnest(chars) AS x, generate_subscripts(chars, 1) AS k FROM h
  UNION ALL SELECT rid, lang, n_words, failed, 'common', unnest(common), generate_subscripts(common, 1) FROM h
), f AS (
  SELECT lang, kind, k, x / nullif(sum(x) OVER (PARTITION BY lang, kind), 0)::DOUBLE AS q FROM (SELECT lang, kind, k, sum(x) AS x FROM v WHERE n_words >= {ref_words} AND NOT failed GROUP BY ALL)
), e AS (
  SELECT lang, max(q) FILTER (WHERE k = {len(COMMON) + 1}) AS rest, sqrt(greatest(0, sum(({part("z", "q")} + {part("q", "z")}) / 2))) AS far FROM (SELECT *, CASE WHEN k = {len(COMMON) + 1} THEN 1.0 ELSE 0.0 END::DOUBLE AS z FROM f WHERE kind = 'common') GROUP BY lang
), p AS (
  SELECT *, coalesce(x / nullif(sum(x) OVER (PARTITION BY rid, kind), 0)::DOUBLE, 0) AS p FROM v
), s AS (
  SELECT rid, p.kind, sqrt(greatest(0, sum(({part("p", "q")} + {part("q", "p")}) / 2))) AS js FROM p JOIN f ON p.lang IS NOT DISTINCT FROM f.lang AND p.kind = f.kind AND p.k = f.k GROUP BY ALL
), b AS (
  SELECT w.doc_id, n_words::BIGINT AS n_words, length(j)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, sc.js AS jc, sm.js AS jm, e.rest, e.far, n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed
  FROM w LEFT JOIN e ON w.lang IS NOT DISTINCT FROM e.lang LEFT JOIN r ON w.rid = r.rid LEFT JOIN s sc ON w.rid = sc.rid AND sc.kind = 'chars' LEFT JOIN s sm ON w.rid = sm.rid AND sm.kind = 'common'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(jc, 6) AS char_distance, round(jm, 6) AS common_distance, CASE WHEN rest IS NULL THEN 'none' WHEN rest <= {1 - LEAST_COMMON} THEN 'characters and words' ELSE 'characters' END AS reference, base_failed,
  NOT base_failed AND (n_words < {min_words} OR (coalesce(jc, 0) <= {max_char} AND coalesce(jm, 0) <= {max_common} AND NOT coalesce(rest <= {1 - LEAST_COMMON} AND jm > CASE WHEN n_words < {short_words} THEN {short_share} ELSE {common_share} END * far, false))) AS kept FROM b
"""


SQL = _sql()
