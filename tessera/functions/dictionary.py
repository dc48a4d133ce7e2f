"""Dictionaries of many names over texts: one automaton for all names, one pass over each text.

Names are literals, found in any case, with or without word borders. What is found is a column of hits with places; which
name counts (the first in order, all but suppressed ones, counts) are expressions over the hits.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The hits of a text: number and name of the entry, first character (from 0) and length.
HIT = "struct<entry:int,name:string,start:int,length:int>"


class Entry(NamedTuple):
    """A name and one way to write it. starts, ends: a word begins and ends with it, that is, no letter, digit or
    underscore of any script stands before or behind it."""

    name: str
    text: str
    starts: bool = True
    ends: bool = True


def lowered(text: str) -> str:
    """Lower case that keeps every character's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class Automaton:
    """All places of all entries in a text."""

    def __init__(self, entries: Sequence[Entry]):
        import ahocorasick

        self.entries = entries
        texts: dict[str, list[int]] = {}
        for k, e in enumerate(entries):
            if e.text:
                texts.setdefault(lowered(e.text), []).append(k)
        self.tree = ahocorasick.Automaton() if texts else None
        for text, own in texts.items():
            self.tree.add_word(text, (len(text), own))
        if self.tree is not None:
            self.tree.make_automaton()

    def hits(self, text: str | None) -> list[tuple[int, int, int]]:
        """(entry, start, length), by start, then by entry."""
        if not text or self.tree is None:
            return []
        low, out = lowered(text), []
        word = lambda at: 0 <= at < len(low) and (low[at].isalnum() or low[at] == "_")
        for last, (size, own) in self.tree.iter(low):
            start = last + 1 - size
            before, after = word(start - 1), word(last + 1)
            out += [(start, k, size) for k in own if not (before and self.entries[k].starts) and not (after and self.entries[k].ends)]
        return [(k, start, size) for start, k, size in sorted(out)]


def _shared(entries: tuple[Entry, ...]) -> Automaton:
    """The automaton of this Python process; a worker that is used again does not build it again."""
    kept = sys.modules.setdefault("_tessera_kept", types.ModuleType("_tessera_kept"))
    found = kept.__dict__.setdefault("automata", {})
    if entries not in found:
        found.clear()
        found[entries] = Automaton(entries)
    return found[entries]


def hits(text: Column, entries: Iterable[Entry]) -> Column:
    """TX5, TX6, JN11: every place of every entry, overlapping ones included, as an array of entry, name, start and length
    in the order of places. Null and empty texts have none."""
    entries = tuple(entries)

    @F.arrow_udf(f"array<{HIT}>")
    def find(texts: pa.Array) -> pa.Array:
        automaton, ends, flat = _shared(entries), [0], []
        for t in texts:
            flat += automaton.hits(t.as_py())
            ends.append(len(flat))
        numbers, starts, sizes = (pa.array([h[k] for h in flat], pa.int32()) for k in range(3))
        names = pa.array([entries[h[0]].name for h in flat], pa.string())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([numbers, names, starts, sizes], ["entry", "name", "start", "length"]))

    return find(text)


def first_entry(found: Column) -> Column:
    """TX5, JN11: the name of the first entry in order that is found anywhere, "" without one."""
    return F.coalesce(F.array_min(F.transform(found, lambda h: F.struct(h["entry"], h["name"])))["name"], F.lit(""))


def names_found(found: Column, aliases: Mapping[str, str] | None = None, suppress: Mapping[str, str] | None = None) -> Column:
    """TX6: all names found, in the order of entries and once each. aliases rename; suppress drops a name where the name
    that it maps to is found as well."""
    ordered = F.array_sort(F.transform(found, lambda h: F.struct(h["entry"], h["name"])))
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]) if aliases else None
    renamed = (lambda n: F.coalesce(F.try_element_at(table, n), n)) if aliases else (lambda n: n)
    names = F.array_distinct(F.transform(ordered, lambda h: renamed(h["name"])))
    for name, by in (suppress or {}).items():
        names = F.when(F.array_contains(names, by), F.array_remove(names, name)).otherwise(names)
    return names


def outside_longer(found: Column) -> Column:
    """The hits that lie inside no longer hit: of "bank" and "bank note" at one place the second is left."""
    inside = lambda h, o: (o["start"] <= h["start"]) & (h["start"] + h["length"] <= o["start"] + o["length"]) & (o["length"] > h["length"])
    return F.filter(found, lambda h: ~F.exists(found, lambda o: inside(h, o)))


def count_by_name(df: DataFrame, keys: Sequence[str], found: Column) -> DataFrame:
    """TX4, JN11: keys, name, n and first (the smallest start) of each name in each row of df."""
    each = df.select(*keys, F.explode(found).alias("h"))
    return each.groupBy(*keys, F.col("h.name").alias("name")).agg(F.count("*").alias("n"), F.min("h.start").alias("first"))


def entries_of(table: DataFrame, name: str, text: str, most: int = 100_000, starts: bool = True, ends: bool = True) -> list[Entry]:
    """The entries of a table, by text. An automaton is held by every worker, so its size is bounded: raises ValueError
    beyond most rows, where phrases_by_join does the same without one."""
    rows = table.select(name, text).filter(F.col(text).isNotNull()).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} entries: join them with phrases_by_join")
    return [Entry(r[0], r[1], starts, ends) for r in sorted(rows, key=lambda r: (r[1], r[0] or ""))]


#: A word: letters, digits and underscores of any script.
WORD = r"[\p{L}\p{N}_]+"


def phrases_by_join(df: DataFrame, keys: Sequence[str], text: str, table: DataFrame, name: str, phrase: str) -> DataFrame:
    """JN11 for dictionaries of any size: keys, name and place (the word's number, from 0) of all phrases of whole words,
    one space between them, in any case. Words of texts and first words of phrases meet in an equi-join; the other words are
    compared where it meets. Words are parted by anything that is no letter, digit or underscore."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(WORD), 0)
    wanted = table.select(F.col(name).alias("_name"), words(F.col(phrase)).alias("_words")).filter("size(_words) > 0").withColumn("_word", F.col("_words")[0])
    rows = df.select(*keys, words(F.col(text)).alias("_text"))
    each = rows.select(*keys, F.posexplode("_text").alias("place", "_word"), F.col("_text"))
    longest = wanted.agg(F.max(F.size("_words"))).first()[0] or 1
    each = each.withColumn("_ahead", F.slice("_text", F.col("place") + 1, F.lit(longest))).drop("_text")
    met = each.join(wanted, "_word").filter(F.slice("_ahead", F.lit(1), F.size("_words")) == F.col("_words"))
    return met.select(*keys, F.col("_name").alias("name"), "place")
