"""Calibration over reviews; the SQL takes the same Newton steps, one table each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import calibrate, scores
from tessera.plans.inputs import GRID, flag, grid, number, pick, read, sql_flag, sql_number, sql_pick
from tessera.plans.registry import query

P = "((n_chars % 1000) / 1000.0)::DOUBLE"
POINTS = f"pts AS (SELECT doc_id, lang AS f, source AS s, ln(least(1 - 1e-6, greatest(1e-6, {P})) / (1 - least(1 - 1e-6, greatest(1e-6, {P})))) AS x, quality::DOUBLE AS y FROM labels JOIN documents USING (doc_id))"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    return j.select("doc_id", F.col("lang").alias("f"), F.col("source").alias("s"), calibrate.logit(F.pmod("n_chars", F.lit(1000)) / 1000.0).alias("x"), F.col("quality").alias("y"))


def s_platt(points: str, key: str, steps: int = 30, name: str = "p") -> str:
    """(key, a, b) of the fits by key after so many steps, as tables name0 to the last."""
    out = [f"{name}0 AS (SELECT DISTINCT {key}, 0.0::DOUBLE AS a, 1.0::DOUBLE AS b FROM {points})"]
    for k in range(steps):
        q = "(1 / (1 + exp(-(a + b * x))))"
        sums = f"SELECT {key}, any_value(a) AS a, any_value(b) AS b, sum({q} - y) + 4 * any_value(a) AS ga, sum(({q} - y) * x) + 4 * (any_value(b) - 1) AS gb, sum({q} * (1 - {q})) + 4 AS haa, sum({q} * (1 - {q}) * x) AS hab, sum({q} * (1 - {q}) * x * x) + 4 AS hbb FROM {points} JOIN {name}{k} USING ({key}) GROUP BY {key}"
        step = f"SELECT *, (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS da, (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS db FROM ({sums})"
        out.append(f"{name}{k + 1} AS (SELECT {key}, a - da * least(1, 1 / greatest(abs(da) + abs(db), 1e-300)) AS a, b - db * least(1, 1 / greatest(abs(da) + abs(db), 1e-300)) AS b FROM ({step}))")
    return ",\n".join(out)


def s_offsets(points: str, key: str, steps: int = 30, name: str = "o") -> str:
    """(key, o): the shifts of classes on the scale z."""
    out = [f"{name}0 AS (SELECT DISTINCT {key}, 0.0::DOUBLE AS o FROM {points})"]
    for k in range(steps):
        q = "(1 / (1 + exp(-(z + o))))"
        out.append(f"{name}{k + 1} AS (SELECT {key}, any_value(o) - (sum({q} - y) + 3 * any_value(o)) / (sum({q} * (1 - {q})) + 3) AS o FROM {points} JOIN {name}{k} USING ({key}) GROUP BY {key})")
    return ",\n".join(out)


@query(f"WITH {POINTS}, {s_platt('pts', 'f')} SELECT f AS family, round(a, 5) AS a, round(b, 5) AS b FROM p30")
def platt_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1, ML2: parameters per language; Newton steps over distributed sums."""
    found = calibrate.platt(_points(spark, sf_dir), "f", "x", "y")
    return spark.createDataFrame([(k, round(a, 5), round(b, 5)) for k, (a, b) in sorted(found.items())], "family string, a double, b double")


@query(f"WITH {POINTS}, {s_platt('pts', 'f')}, zs AS (SELECT s, a + b * x AS z, y FROM pts JOIN p30 USING (f)), {s_offsets('zs', 's')} SELECT s AS label, round(o, 5) AS o FROM o30 WHERE s IS NOT NULL")
def class_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3: the shift of each class on the scale of its family."""
    points = _points(spark, sf_dir).filter("s IS NOT NULL")
    params = calibrate.platt(_points(spark, sf_dir), "f", "x", "y")
    pick_ = lambda k: F.element_at(F.create_map(*[F.lit(v) for f, ab in params.items() for v in (f, ab[k])]), F.col("f"))
    found = calibrate.class_offsets(points.withColumn("z", pick_(0) + pick_(1) * F.col("x")), "s", "z", "y")
    return spark.createDataFrame([(k, round(o, 5)) for k, o in sorted(found.items())], "label string, o double")


@query(f"""
WITH {POINTS}, held AS (SELECT h.doc_id AS id, r.x, r.y FROM pts h JOIN pts r ON h.f = r.f AND h.doc_id <> r.doc_id), {s_platt('held', 'id', 12)}
SELECT f AS family, round(x, 6) AS x, y, round(1 / (1 + exp(-(a + b * x))), 6) AS p FROM pts JOIN p12 ON id = doc_id
""")
def leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4: each review's probability by a fit of its language without it, exactly."""
    found = calibrate.leave_one_out(_points(spark, sf_dir), "f", "x", "y", block=32)
    return found.select("family", F.round("x", 6).alias("x"), "y", F.round("p", 6).alias("p"))


CLASSES = ("mono_other", "bait", "mono_target", "article", "unrelated", "dead")
FAMILY = "CASE WHEN c IN ('mono_other', 'bait') THEN 'violation' WHEN c = 'mono_target' THEN 'mono' WHEN c = 'dead' THEN 'dead' ELSE 'other' END"
SCORED = f"""
g AS ({GRID}), s AS (SELECT k, {sql_pick(0, 2, CLASSES)} AS c, ({sql_number(0, 6, 80)} + 10) / 100.0::DOUBLE AS raw, {sql_flag(1, 2, 3)} AS wrong, {sql_flag(1, 10, 5)} AS seen, {sql_pick(1, 6, ("article", "mono_other"))} AS expected FROM g), f AS (SELECT *, {FAMILY} AS f, ln(raw / (1 - raw)) AS x FROM s)
"""


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    g = grid(spark, sf_dir).select("k", F.col("k").cast("string").alias("domain"), pick(0, 2, CLASSES).alias("category"), ((number(0, 6, 80) + 10) / 100.0).alias("raw"), (~flag(1, 2, 3)).alias("ok"), pick(1, 6, ("article", "mono_other")).alias("expected"), flag(1, 10, 5).alias("seen"))
    return g.select("k", "domain", "category", "raw"), g.filter("seen").select("domain", "ok", "expected")


@query(f"""
WITH {SCORED}, pts AS (SELECT f, c, x, (NOT wrong)::INT::DOUBLE AS y FROM f WHERE seen), {s_platt('pts', 'f')}, zs AS (SELECT c, a + b * x AS z, y FROM pts JOIN p30 USING (f)), {s_offsets('zs', 'c')}
SELECT k, round(1 / (1 + exp(-(coalesce(a, 0) + coalesce(o, 0) + coalesce(b, 1) * x))), 6) AS confidence FROM f LEFT JOIN p30 USING (f) LEFT JOIN o30 USING (c)
""")
def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2, ML3, ML5: how sure a site's class is, by families and classes."""
    scored, reviewed = _scored(spark, sf_dir)
    return scores.calibrated(scored, reviewed).select("k", F.round("confidence", 6).alias("confidence"))


@query(f"""
WITH {SCORED}, v AS (SELECT *, c IN ('mono_other', 'bait') AS bad FROM f), w AS (SELECT *, CASE WHEN bad THEN x ELSE -x END AS vx FROM v), pts AS (SELECT f, c, vx AS x, ((expected = 'mono_other') = bad)::INT::DOUBLE AS y FROM w WHERE seen), {s_platt('pts', 'f')}, zs AS (SELECT c, a + b * x AS z, y FROM pts JOIN p30 USING (f)), {s_offsets('zs', 'c')},
q AS (SELECT k, bad, 1 / (1 + exp(-(coalesce(a, 0) + coalesce(o, 0) + coalesce(b, 1) * vx))) AS p FROM w LEFT JOIN p30 USING (f) LEFT JOIN o30 USING (c)) SELECT k, round(CASE WHEN bad THEN p ELSE 1 - p END, 6) AS violation FROM q
""")
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5: how likely a site is a violator, whatever its class."""
    scored, reviewed = _scored(spark, sf_dir)
    return scores.violations(scored, reviewed).select("k", F.round("violation", 6).alias("violation"))
