"""Ordered rule cascades: the first rule whose condition holds gives the class, its reason and its number.

Rules are data. Long cascades become several columns, so that no generated method grows beyond what codegen takes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A condition and what it decides; a null condition does not hold. why may be a Column."""

    name: str
    condition: Column
    why: Column | str = ""


def first_match(df: DataFrame, rules: Sequence[Rule], default: str, out: str = "class", step: int = 10) -> DataFrame:
    """Adds out, out_why and out_rule (from 1; 0 for the default).

    Earlier rules win whatever later ones say, so the order of rules is their meaning.
    """
    number = F.lit(0)
    for low in range(0, len(rules), step):
        part, chain = rules[low : low + step], None
        for k, rule in enumerate(part, low + 1):
            held = F.coalesce(rule.condition, F.lit(False))
            chain = F.when(held, k) if chain is None else chain.when(held, k)
        df = df.withColumn(f"_rule{low}", chain.otherwise(0))
    for low in reversed(range(0, len(rules), step)):
        number = F.when(F.col(f"_rule{low}") > 0, F.col(f"_rule{low}")).otherwise(number)
    df = df.withColumn(f"{out}_rule", number).drop(*[f"_rule{low}" for low in range(0, len(rules), step)])
    name, why = F.lit(default), F.lit("")
    at = F.col(f"{out}_rule")
    if rules:
        name = F.when(at == 0, default).otherwise(F.element_at(F.array(*[F.lit(r.name) for r in rules]), F.greatest(at, F.lit(1))))
        for k, rule in enumerate(rules, 1):
            text = F.lit(rule.why) if isinstance(rule.why, str) else rule.why
            why = F.when(at == k, text) if k == 1 else why.when(at == k, text)
        why = why.otherwise("")
    return df.withColumn(out, name).withColumn(f"{out}_why", why)


def tags(pairs: Sequence[tuple[str, Column]]) -> Column:
    """DC19: the names whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in pairs]))


@dataclass(frozen=True)
class Weight:
    """A contribution to a score where its condition holds, with the reason it is given for."""

    delta: float
    condition: Column
    why: str = ""


def weighted_score(base: Column, weights: Sequence[Weight], low: float, high: float) -> tuple[Column, Column]:
    """DC23: base plus the weights that apply, clipped, and the reasons of those that have one, in order."""
    total, reasons = base, []
    for w in weights:
        held = F.coalesce(w.condition, F.lit(False))
        total = total + F.when(held, F.lit(w.delta)).otherwise(F.lit(0.0))
        if w.why:
            reasons.append(F.when(held, F.lit(w.why)))
    return F.greatest(F.lit(low), F.least(F.lit(high), total)), F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
