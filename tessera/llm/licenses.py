"""Licence scans by a positional rare-token index, in DataFrame functions alone.

Of every licence template the words of the highest inverse document frequency, measured over all documents, are indexed
with their positions. They are looked up in documents for the templates whose mandatory key phrases stand there, and their
postings are intersected by relative position (place in the document less place in the template), each posting weighing its
word's inverse document frequency.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import UPPER, cut

#: Whatever parts words here: ASCII but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases whose places are reported, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Label, a passage of the public licence notice, mandatory key phrases (all of them must stand in a text).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ("apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or any later version", ("gnu general public license", "free software foundation", "version 3")),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or any later version", ("gnu general public license", "free software foundation", "version 2")),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ("copies or substantial portions of the software", "noninfringement")),
    ("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", ("apache org licenses license 2 0",)),
    ("agpl-3", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu affero general public license",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license", "free software foundation")),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ("redistributions of source code must retain", "redistributions in binary form must reproduce")),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software", "prior written permission")),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", ("copy of the mpl", "mozilla org mpl 2 0")),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software altered source versions must be plainly marked as such and must not be misrepresented as being the original software", ("must not be misrepresented", "plainly marked as such")),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use reproduce display distribute execute and transmit the software", ("accompanying documentation covered by this license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0", ("eclipse public license 2 0",)),
)


def template_words() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()})


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    """log(1 + documents / documents with the word) of every template word; a word that none holds weighs as one that one
    holds. At most one row for each template word comes to the driver."""
    words = docs.select(F.array_remove(F.split(_lower(F.coalesce("text", F.lit(""))), GAP), "").alias("words"))
    held = words.select(F.explode(F.array_intersect("words", F.array(*[F.lit(w) for w in template_words()]))).alias("word"))
    df = {r["word"]: r["df"] for r in held.groupBy("word").agg(F.count("*").alias("df")).collect()}
    n = docs.count()
    return {w: math.log(1.0 + n / df.get(w, 1)) for w in template_words()}


def rare_index(idf: dict[str, float], rare_words: int) -> list[list[tuple[str, int]]]:
    """The (word, place) postings of each template: all places of its rare_words words of the highest idf, ties by word."""
    out = []
    for _, text, _ in TEMPLATES:
        words = text.split()
        rare = set(sorted(set(words), key=lambda w: (-idf[w], w))[:rare_words])
        out.append([(w, i) for i, w in enumerate(words) if w in rare])
    return out


def _lower(word: Column) -> Column:
    return F.translate(word, UPPER, UPPER.lower())


def _starts(words: Column, phrase: str) -> Column:
    """The places where the words of a phrase stand one after another."""
    parts = phrase.split()
    firsts = F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull())
    return F.filter(firsts, lambda i: F.slice(words, i + 1, len(parts)) == F.array(*[F.lit(p) for p in parts]))


def read_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """One row per row of docs: doc_id, n_words, places (starts of base phrases), base (their labels), hits (words of the
    vocabulary with their places) and phrases (key phrases that stand in the text). Texts without a word of the vocabulary
    have neither, those without a key phrase have no hits."""
    phrases = sorted({p for _, _, keys in TEMPLATES for p in keys})
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_remove(F.split(F.coalesce("text", F.lit("")), GAP), "").alias("raw"))
    #: F.lower also maps two letters outside ASCII to ASCII ones; what it lets through is compared after A-Z alone.
    known = sorted({*vocabulary, *(p.split()[0] for p in phrases), *(p.split()[0] for p, _ in BASE)})
    some = words.withColumn("some", F.exists("raw", lambda w: F.lower(w).isin(known)))
    low = some.withColumn("words", F.when(F.col("some"), F.transform("raw", _lower)))
    flat = low.withColumn("flat", F.when(F.col("some"), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("at")))), lambda x: x.isNotNull())
    places = [F.when(F.contains("flat", F.lit(f" {p} ")), _starts(F.col("words"), p)) for p, _ in BASE]
    base = F.array(*[F.when(F.contains("flat", F.lit(f" {p} ")), F.lit(label)) for p, label in BASE])
    keys = F.array_compact(F.array(*[F.when(F.contains("flat", F.lit(f" {p} ")), F.lit(p)) for p in phrases]))
    return flat.select(
        "doc_id",
        F.size("raw").cast("long").alias("n_words"),
        F.flatten(F.array_compact(F.array(*places))).alias("places"),
        F.array_compact(base).alias("base"),
        F.when(F.col("some") & (F.size(keys) > 0), hits).alias("hits"),
        F.when(F.col("some"), keys).alias("phrases"),
    )


def template_matches(read: DataFrame, idf: dict[str, float], rare_words: int = 8, least_share: float = 0.5) -> DataFrame:
    """row_id, label, share: the largest weight of a template's postings that stand at one relative position, as a share of
    the weight of all of them, where it is least_share or more and the key phrases stand in the text."""
    spark = read.sparkSession
    postings = rare_index(idf, rare_words)
    whole = [sum(idf[w] for w, _ in own) for own in postings]
    index = spark.sql(f"SELECT * FROM VALUES {', '.join(f'({w!r}, {t}, {i}, {idf[w]!r}D)' for t, own in enumerate(postings) for w, i in own)} AS (word, template, place, idf)")
    rows = [f"({t}, '{label}', array({', '.join(map(repr, keys))}), {whole[t]!r}D)" for t, (label, _, keys) in enumerate(TEMPLATES)]
    known = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS (template, label, keys, whole)")
    candidates = read.filter(F.size("phrases") > 0).select("row_id", "phrases", "hits").join(F.broadcast(known), F.size(F.array_except("keys", "phrases")) == 0)
    hits = candidates.select("row_id", "template", "label", "whole", F.explode("hits").alias("hit")).select("row_id", "template", "label", "whole", "hit.word", "hit.at")
    met = hits.join(F.broadcast(index), ["word", "template"]).groupBy("row_id", "template", "label", "whole", (F.col("at") - F.col("place")).alias("shift")).agg(F.sum("idf").alias("weight"))
    scored = met.withColumn("share", F.least(F.lit(1.0), F.col("weight") / F.col("whole")))
    return scored.filter(F.col("share") >= least_share).groupBy("row_id", "label").agg(F.max("share").alias("share"))


def scan(docs: DataFrame, rare_words: int = 8, least_share: float = 0.5) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs.

    A-Z are lower-cased; words are runs of letters, digits and whatever is not ASCII. n_base counts all places of the
    base phrases, first_word and last_word are the smallest and largest (null without one). labels holds the base labels
    and those of matched templates, distinct, sorted and joined by commas ("" without any). score is 1 with a base phrase,
    else the largest share of a matched template, else 0. Null, empty and blank texts have no words and no label;
    repeated rows are scanned alike; an empty table gives no rows; other columns are not looked at.
    """
    idf = inverse_frequencies(docs)
    vocabulary = sorted({w for own in rare_index(idf, rare_words) for w, _ in own})
    read = cut(read_words(docs, vocabulary).withColumn("row_id", F.monotonically_increasing_id()))
    found = template_matches(read, idf, rare_words, least_share).groupBy("row_id").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    both = read.select("row_id", "doc_id", "n_words", "places", "base").join(found.withColumnRenamed("row_id", "r"), F.col("row_id") == F.col("r"), "left")
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
