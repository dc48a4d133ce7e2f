"""Calibration of scores by reviews: Platt scaling per family and an offset per class, with Gaussian pulls.

A fit needs how often each point occurs and no more, so points are counted by Spark and the counts fitted, a family in a
task, or, beyond a bound, by distributed sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.space import cut


def logit(p: Column, clamp: float = 1e-6) -> Column:
    """ML1."""
    q = F.least(F.lit(1 - clamp), F.greatest(F.lit(clamp), p))
    return F.log(q / (1 - q))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


#: Different points of all families that are fitted in one task each family; beyond, every step is a job of its own.
FIT_POINTS = 1_000_000


def compressed(points: DataFrame, family: str, x: str, y: str) -> DataFrame:
    """f, x, y and n: how often each point occurs. A fit needs no more, and scores are few."""
    rows = points.select(F.col(family).alias("f"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return rows.groupBy("f", "x", "y").agg(F.count("*").cast("double").alias("n"))


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: float, steps: int, tolerance: float) -> tuple[float, float]:
    """Newton steps for (a, b) over points that occur n times, from (0, 1)."""
    a, b = 0.0, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a + b * x)))
        off, w = n * (p - y), n * p * (1 - p)
        a, b, moved = _step(a, b, (off.sum(), off @ x, w.sum(), w @ x, w @ (x * x)), prior)
        if moved < tolerance:
            break
    return a, b


def _step(a: float, b: float, sums: tuple, prior: float) -> tuple[float, float, float]:
    """One step by the sums of both gradients and of the three second derivatives; no step is longer than 1, or Newton may
    swing."""
    ga, gb, haa, hab, hbb = (float(s) for s in sums)
    step = np.linalg.solve(np.array([[haa + prior, hab], [hab, hbb + prior]]), np.array([ga + a * prior, gb + (b - 1) * prior]))
    step *= min(1.0, 1.0 / float(np.abs(step).sum() or 1.0))
    return a - float(step[0]), b - float(step[1]), float(np.abs(step).sum())


def platt(points: DataFrame, family: str, x: str, y: str, prior: float = 4.0, steps: int = 200, tolerance: float = 1e-8, most: int = FIT_POINTS) -> dict[str, tuple[float, float]]:
    """ML2: (a, b) of p = sigmoid(a + b x) per family, pulled to (0, 1). The number of families is that of the classes.

    Points are counted first; families of so few different points are fitted in one job, a family in a task. Beyond most
    points the same steps are taken over distributed sums.
    """
    data = cut(compressed(points, family, x, y).filter("x IS NOT NULL AND y IS NOT NULL"))
    if data.limit(most + 1).count() <= most:

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            a, b = _fit(rows["x"].to_numpy(), rows["y"].to_numpy(), rows["n"].to_numpy(), prior, steps, tolerance)
            return pd.DataFrame({"f": [key[0]], "a": [a], "b": [b]})

        kind = data.schema["f"].dataType.simpleString()
        return {r["f"]: (r["a"], r["b"]) for r in data.groupBy("f").applyInPandas(run, f"f {kind}, a double, b double").collect()}
    found = {r["f"]: (0.0, 1.0) for r in data.select("f").distinct().collect()}
    open_ = set(found)
    for _ in range(steps):
        if not open_:
            break
        p = sigmoid(_by_family(found, 0) + _by_family(found, 1) * F.col("x"))
        off, w = F.col("n") * (p - F.col("y")), F.col("n") * p * (1 - p)
        sums = data.groupBy("f").agg(*[F.sum(v).alias(k) for k, v in (("ga", off), ("gb", off * F.col("x")), ("haa", w), ("hab", w * F.col("x")), ("hbb", w * F.col("x") * F.col("x")))]).collect()
        for r in (r for r in sums if r["f"] in open_):
            a, b, moved = _step(*found[r["f"]], tuple(r)[1:], prior)
            found[r["f"]] = (a, b)
            if moved < tolerance:
                open_.discard(r["f"])
    return found


def _by_family(found: dict[str, tuple[float, float]], k: int) -> Column:
    """A value of each family; a null family has its own."""
    table = F.create_map(*[v for f, ab in found.items() if f is not None for v in (F.lit(f), F.lit(float(ab[k])))])
    named = F.try_element_at(table, F.col("f"))
    return F.when(F.col("f").isNull(), F.lit(float(found[None][k]))).otherwise(named) if None in found else named


def class_offsets(points: DataFrame, label: str, z: str, y: str, prior: float = 3.0, steps: int = 100, most: int = FIT_POINTS) -> dict[str, float]:
    """ML3: the shift of each class on the logit scale, pulled to 0; in one job as platt, or a job a step."""
    data = cut(compressed(points, label, z, y).filter("x IS NOT NULL AND y IS NOT NULL"))
    if data.limit(most + 1).count() <= most:

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            zs, ys, n, o = rows["x"].to_numpy(), rows["y"].to_numpy(), rows["n"].to_numpy(), 0.0
            for _ in range(steps):
                p = 1 / (1 + np.exp(-(zs + o)))
                step = ((n * (p - ys)).sum() + o * prior) / ((n * p * (1 - p)).sum() + prior)
                o -= step
                if abs(step) < 1e-12:
                    break
            return pd.DataFrame({"f": [key[0]], "o": [o]})

        kind = data.schema["f"].dataType.simpleString()
        return {r["f"]: r["o"] for r in data.groupBy("f").applyInPandas(run, f"f {kind}, o double").collect()}
    found = {r["f"]: (0.0, 0.0) for r in data.select("f").distinct().collect()}
    for _ in range(steps):
        p = sigmoid(F.col("x") + _by_family(found, 0))
        sums = data.groupBy("f").agg(F.sum(F.col("n") * (p - F.col("y"))).alias("g"), F.sum(F.col("n") * p * (1 - p)).alias("h")).collect()
        moved = 0.0
        for r in sums:
            o = found[r["f"]][0]
            step = (r["g"] + o * prior) / (r["h"] + prior)
            found[r["f"]] = (o - step, 0.0)
            moved = max(moved, abs(step))
        if moved < 1e-12:
            break
    return {f: o for f, (o, _) in found.items()}


def confidence(df: DataFrame, family: str, label: str, raw: str, params: dict[str, tuple[float, float]], offsets: dict[str, float], out: str = "confidence") -> DataFrame:
    """ML5 in one direction: sigmoid(a + offset + b logit(raw)); families and classes without reviews keep the raw score."""

    def pick(table: dict[str, float], key: str, default: float) -> Column:
        if not table:
            return F.lit(default)
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), F.col(key)), F.lit(default))

    a, b = pick({f: ab[0] for f, ab in params.items()}, family, 0.0), pick({f: ab[1] for f, ab in params.items()}, family, 1.0)
    return df.withColumn(out, sigmoid(a + pick(offsets, label, 0.0) + b * logit(F.col(raw))))


def violation(confidence_of_class: Column, is_violator: Column) -> Column:
    """ML5: the probability of a violation; classes that are none turn it round."""
    return F.when(is_violator, confidence_of_class).otherwise(1 - confidence_of_class)


def _without_each(x: np.ndarray, y: np.ndarray, n: np.ndarray, held: np.ndarray, prior: float, start: tuple[float, float]) -> np.ndarray:
    """(a, b) of the fits that leave out one occurrence of the points held each; all fits take their steps together."""
    ab = np.tile(np.array(start), (held.size, 1))
    own = np.arange(held.size)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(ab[:, :1] + ab[:, 1:] * x)))
        off, w = n * (p - y), n * p * (1 - p)
        less = (n[held] - 1) / n[held]
        off[own, held] *= less
        w[own, held] *= less
        g = np.stack([ab[:, 0] * prior + off.sum(axis=1), (ab[:, 1] - 1) * prior + off @ x], axis=1)
        h = np.empty((held.size, 2, 2))
        h[:, 0, 0], h[:, 1, 1] = prior + w.sum(axis=1), prior + w @ (x * x)
        h[:, 0, 1] = h[:, 1, 0] = w @ x
        step = np.linalg.solve(h, g[:, :, None])[:, :, 0]
        size = np.abs(step).sum(axis=1)
        ab -= step * np.minimum(1.0, 1.0 / np.maximum(size, 1e-300))[:, None]
        if size.max(initial=0) < 1e-9:
            break
    return ab


def leave_one_out(points: DataFrame, family: str, x: str, y: str, prior: float = 4.0, block: int = 256) -> DataFrame:
    """ML4: each review's probability from a fit without it, exactly: family, x, y, p.

    Equal points have equal fits, so there is one refit for each different point of a family, from the counts with one taken
    off, and the reviews are joined to it: the work is linear in reviews, and quadratic in the different points of a family
    alone. Refits are shared out in blocks of block points, which start from the fit of all. A null family is a family.
    """
    rows = points.select(F.col(family).alias("family"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    found = platt(rows, "family", "x", "y", prior)
    distinct = cut(compressed(rows, "family", "x", "y").withColumn("id", F.row_number().over(Window.partitionBy("f").orderBy("x", "y")) - 1))
    blocks = distinct.groupBy(F.col("f").alias("_f")).agg(F.floor((F.count("*") - 1) / block).cast("int").alias("_last"))
    spread = distinct.join(blocks, F.col("f").eqNullSafe(F.col("_f"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_last")))).select("f", "block", "id", "x", "y", "n")
    kind = rows.schema["family"].dataType.simpleString()

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("id", kind="stable")
        xs, ys, ns, k = own["x"].to_numpy(), own["y"].to_numpy(), own["n"].to_numpy(), int(key[1])
        held = np.arange(k * block, min(len(xs), (k + 1) * block))
        ab = _without_each(xs, ys, ns, held, prior, found[key[0]])
        p = 1 / (1 + np.exp(-(ab[:, 0] + ab[:, 1] * xs[held])))
        return pd.DataFrame({"_f": [key[0]] * len(held), "_x": xs[held], "_y": ys[held], "p": p})

    refits = spread.groupBy("f", "block").applyInPandas(run, f"_f {kind}, _x double, _y double, p double")
    same = F.col("family").eqNullSafe(F.col("_f")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
    return rows.join(refits, same).select("family", "x", "y", "p")
