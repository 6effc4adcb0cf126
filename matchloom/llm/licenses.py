"""License scans with a positional index of rare tokens.

The templates' words form a small index: of each template's mandatory key phrase the ``RARE`` words
with the highest inverse document frequency over the whole corpus are posted with their places. A
file's words that have postings are looked up; each tells the places where its templates would
start. The places of a template's rarest word are intersected with those of its second and third,
so a place stays only where all of them stand at their relative positions. There the whole key
phrase is verified, and the share of the template's words that stand where they should be is the
place's score. The word frequencies are those of all documents; there are as many as the templates
have words, whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import let, unused

# fixed values: base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: label, template and the key phrase in it that has to stand
TEMPLATES = [
    *[(label, phrase, phrase) for phrase, label in BASE.items()],
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
        "permission is hereby granted free of charge to any person obtaining a copy",
    ),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software for any purpose"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable for any damages"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("public-domain", "this work is in the public domain", "in the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
    ("proprietary", "confidential and proprietary do not distribute", "confidential and proprietary"),
]
#: words posted of a key phrase
RARE = 3
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def key_start(template: str, key: str) -> int:
    """The word of the template that its key phrase begins at."""
    words, phrase = template.split(), key.split()
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def file_words(text: Column) -> Column:
    """Runs of ASCII digits and letters and of anything beyond ASCII, A-Z lower-cased; none for null.

    ``lower`` goes further than A-Z, but then stays beyond ASCII, where no template has a word. The
    one sign that it brings into ASCII, U+212A, is put aside first.
    """
    text = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.filter(F.split(text, NO_WORD), lambda w: w != "")


def rarities(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Inverse document frequency over all of ``docs`` of each word in the templates."""
    vocabulary = sorted({w for _, template, _ in TEMPLATES for w in template.split()})
    found = docs.select(F.array_intersect(file_words(F.col(text)), F.lit(vocabulary)).alias("w"))
    counts = found.agg(F.count("*").alias("n"), *[F.sum(F.array_contains("w", w).cast("long")).alias(w) for w in vocabulary]).first()
    return {w: math.log((1 + counts["n"]) / (1 + (counts[w] or 0))) for w in vocabulary}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, places, n_base, first_word, last_word, base_labels, labels and score.

    places: array of (template, label, start, score), template being a place in TEMPLATES. A null
    or empty text has no words and no places; score is then 0, first_word and last_word are null,
    the labels ''. Overlapping places all count. Columns of docs that have one of these names are
    replaced; all others stay. Nothing is shuffled but the word counts.
    """
    idf = rarities(docs, text)
    # turn r: word -> (template, place) of the templates whose r-th rarest key word it is; the last one again for shorter phrases
    turns: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(RARE)]
    for t, (_, template, key) in enumerate(TEMPLATES):
        phrase, at = key.split(), key_start(template, key)
        rare = sorted(range(len(phrase)), key=lambda i: (-idf[phrase[i]], i))
        for r, posted in enumerate(turns):
            i = rare[min(r, len(rare) - 1)]
            posted.setdefault(phrase[i], []).append((t, at + i))
    kinds = "array<struct<t:int,at:int>>"
    index = lambda posted: F.create_map(*[x for w, posts in posted.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in posts]).cast(kinds))])
    templates = F.lit([t.split() for _, t, _ in TEMPLATES])
    keys = F.lit([k.split() for _, _, k in TEMPLATES])
    key_at = F.lit([key_start(t, k) for _, t, k in TEMPLATES])
    labels = F.lit([label for label, _, _ in TEMPLATES])
    all_words, = unused(docs, "all_words")
    words = F.col(all_words)
    vocabulary = sorted({w for posted in turns for w in posted})
    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*vocabulary), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())

    def starts(hits: Column, posted: dict[str, list[tuple[int, int]]]) -> Column:
        told = F.filter(hits, lambda h: h["w"].isin(*posted))
        return F.flatten(F.transform(told, lambda h: F.transform(F.element_at(index(posted), h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["at"]).alias("start")))))

    def met(hits: Column) -> Column:
        found = starts(hits, turns[0])
        for posted in turns[1:]:
            found = F.array_intersect(found, starts(hits, posted))
        return F.array_distinct(found)

    def stands(p: Column) -> Column:
        key = F.get(keys, p["t"])
        first = p["start"] + F.get(key_at, p["t"])
        return F.when(first < 0, False).otherwise(F.slice(words, F.greatest(first, F.lit(0)) + 1, F.size(key)) == key)

    def place(p: Column) -> Column:
        whole = F.get(templates, p["t"])
        agree = F.size(F.filter(whole, lambda w, k: F.when(p["start"] + k >= 0, F.get(words, p["start"] + k) == w).otherwise(False)))
        return F.struct(p["t"].alias("template"), F.get(labels, p["t"]).alias("label"), p["start"].cast("long").alias("start"), (agree / F.size(whole)).alias("score"))

    # key phrases of one template that overlap the file's edge may start before it: start can be negative
    found = F.transform(F.filter(let(hits, met), stands), place)
    out = ["n_words", "places", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    base = F.filter("places", lambda p: p["template"] < len(BASE))
    at = F.transform(base, lambda p: p["start"])
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda p: p["label"]))), ",")
    docs = docs.drop(*out).withColumn(all_words, file_words(F.col(text)))
    docs = docs.select("*", F.size(words).cast("long").alias("n_words"), found.alias("places")).drop(all_words)
    return docs.select(
        "*", F.size(base).cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """Brute force in SQL: every template at every place."""
    rows = ", ".join(f"({t}, '{label}', {template.split()!r}, {key.split()!r}, {key_start(template, key)})" for t, (label, template, key) in enumerate(TEMPLATES))
    return f"""
WITH tpl(t, label, words, phrase, key_at) AS (VALUES {rows}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NO_WORD}'), lambda w: w <> '') AS words FROM documents),
places AS (
  SELECT doc_id, t, label, pos - 1 - key_at AS start,
    len(list_filter(range(len(tpl.words)), lambda k: pos - key_at + k >= 1 AND d.words[pos - key_at + k] = tpl.words[k + 1])) / len(tpl.words) AS score
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM d) d JOIN tpl ON d.words[pos] = tpl.phrase[1] AND d.words[pos : pos + len(tpl.phrase) - 1] = tpl.phrase)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, count(*) FILTER (t < {len(BASE)}) AS n_base,
  min(start) FILTER (t < {len(BASE)}) AS first_word, max(start) FILTER (t < {len(BASE)}) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (t < {len(BASE)}), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0) AS score
FROM d LEFT JOIN places USING (doc_id) GROUP BY d.doc_id, d.words"""
