"""License scans with a positional rare-token index, in DataFrame functions only.

The index holds, for each rare licence word, its postings: the templates whose
rarest key word it is, and the word's position in them. All texts are cut into
words once. A file whose words hold no whole key phrase is done: key phrases are
mandatory. Of the others the licence words are written with their places (other
words as nulls), and over all documents the frequency of each licence word is
counted; of a template's key words, which a file must all have, the one with the
highest IDF gets the posting.

In a file its highest-IDF licence words are looked up in the index. A place less
a posting's position is where a template would begin. There the places of the
key phrases are verified word for word, and those of the template's other words
are counted: the score is the share of its words that stand where they should.
Any key word would find the same templates, so the frequencies decide how many
places are tried, and change no result.

All but the counting happens within a row, where a word at a place is found in
one step. Only the counts of licence words are shuffled, combined first. The
index and the templates are constants of a few hundred words. Places that are
tried are occurrences of the rarest words, so no work grows faster than a
document's length.

Defined results: null and empty texts have no words, no labels, score 0 and
null positions; whole texts of any length are read; of key words of equal
frequency the first in the template is looked up; repeated rows get equal
results; a null doc_id stays null; an empty table gives an empty result; extra
columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from .shared import written

#: Share of a template's words that must stand at their places.
LEAST_SCORE = 0.7

# Phrases and labels of the base rule.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Fixed values: (label, template words, mandatory key phrases), the public texts of licences and their usual notices.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge", "associated documentation files"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["except in compliance with the license"]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ["unless required by applicable law or agreed to in writing"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["this permission notice shall be included"]),
    ("gpl", "you should have received a copy of the gnu general public license along with this program", ["a copy of the gnu general public license along with this program"]),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["nor the names of its contributors", "endorse or promote products"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["redistribute it and or modify it", "gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms", "with or without modification"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify", "with or without fee"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
]

#: A word, once A-Z are lower case: digits, a-z and all that is not ASCII.
WORD = r"[0-9a-z\u0080-\x{10FFFF}]+"


def words_of(text: Column) -> Column:
    """The words of a text. Two letters whose lower case holds ASCII stay what they are: not ASCII."""
    kept = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ĸ"))
    return F.regexp_extract_all(F.lower(kept), F.lit(WORD), F.lit(0))


def key_places(template: str, keys: list[str]) -> list[tuple[int, str]]:
    """(position, word) of every word of the key phrases."""
    words, out = template.split(), {}
    for key in keys:
        k = key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(k)] == k)
        out |= dict(enumerate(k, at))
    return sorted(out.items())


def licence_words(docs: DataFrame, vocabulary: list[str], phrases: list[list[str]]) -> DataFrame:
    """doc_id, n_words, _has (the licence words of the text) and _w (its words, those of no licence as null; null where no phrase has all its words)."""
    some = docs.select("doc_id", words_of(F.col("text")).alias("_all"))
    some = some.select("doc_id", F.size("_all").cast("long").alias("n_words"), F.transform("_all", lambda w: F.when(w.isin(vocabulary), w)).alias("_w"))
    some = some.select("doc_id", "n_words", F.array_distinct(F.array_compact("_w")).alias("_has"), "_w")
    whole = reduce(or_, (F.size(F.array_intersect("_has", F.array(*map(F.lit, sorted(set(p)))))) == len(set(p)) for p in phrases))
    return some.select("doc_id", "n_words", "_has", F.when(whole, F.col("_w")).alias("_w"))


def document_frequency(table: DataFrame) -> dict[str, int]:
    """Documents with each licence word, counted over all documents."""
    found = table.select(F.explode("_has").alias("word")).groupBy("word").count()
    return {r.word: r["count"] for r in found.collect()}  # at most the templates' words


def postings(having: dict[str, int], rows: int) -> dict[str, list[tuple[int, int]]]:
    """word -> (number of the template, position in it) of the templates whose key word of highest IDF it is; of equal ones the first. Base phrases come behind the templates."""
    idf = lambda w: math.log((rows + 1) / (having.get(w, 0) + 1))
    index: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, keys) in enumerate(_all_templates()):
        at, word = max(key_places(text, keys), key=lambda x: (idf(x[1]), -x[0]))
        index.setdefault(word, []).append((t, at))
    return index


def _all_templates() -> list[tuple[str, str, list[str]]]:
    return TEMPLATES + [(label, phrase, [phrase]) for phrase, label in PHRASES]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    every = _all_templates()
    keyed = [[w for _, w in key_places(text, keys)] for _, text, keys in every]
    vocabulary = sorted({w for _, text, _ in every for w in text.split()})
    table = written(licence_words(docs, vocabulary, keyed), "licence-words")
    index = postings(document_frequency(table), table.count())

    strings, ints = lambda x: F.array(*map(F.lit, x)), lambda x: F.array(*map(F.lit, x))
    templates = F.array(*(F.struct(strings(text.split()).alias("words"), ints(at for at, _ in key_places(text, keys)).alias("keys")) for _, text, keys in every))
    looked_up = F.create_map(*(x for word, found in sorted(index.items()) for x in (F.lit(word), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in found)))))
    names = F.array(*(F.lit(label) for label, _, _ in every))

    # the file's rarest licence words with their places; files without any have none of what follows
    places = F.filter(F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h.w.isin(sorted(index)))
    begins = F.flatten(F.transform(places, lambda h: F.transform(F.element_at(looked_up, h.w), lambda p: F.struct(p.t.alias("t"), (h.i - p.at).alias("s")))))
    stands = lambda x, j, word: F.coalesce(F.get(F.col("_w"), x.s + j) == word, F.lit(False))
    template = lambda x: F.get(templates, x.t)
    held = lambda x: F.forall(template(x).keys, lambda j: stands(x, j, F.get(template(x).words, j)))
    agree = lambda x: F.size(F.filter(F.transform(template(x).words, lambda word, j: stands(x, j, word)), lambda ok: ok)) / F.size(template(x).words)
    some = table.select("doc_id", "n_words", "_w", begins.alias("_b"))
    some = some.select("doc_id", "n_words", F.when(F.size("_b") > 0, F.transform(F.filter("_b", held), lambda x: F.struct(x.t.alias("t"), x.s.alias("s"), agree(x).alias("score")))).alias("_f"))
    found = some.select("doc_id", "n_words", F.coalesce("_f", F.array().cast(some.schema["_f"].dataType)).alias("_f"))

    base = F.filter("_f", lambda x: x.t >= len(TEMPLATES))
    good = F.filter("_f", lambda x: x.score >= LEAST_SCORE)
    joined = lambda these: F.array_join(F.array_sort(F.array_distinct(F.transform(these, lambda x: F.get(names, x.t)))), ",")
    starts = F.transform(base, lambda x: x.s)
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(good).alias("labels"), F.coalesce(F.array_max(F.transform(good, lambda x: x.score)), F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """The same in DuckDB SQL, from the fixed values above."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def stands(words: list[tuple[int, str]], start: str) -> list[str]:
        return [f"coalesce({start} + {j} >= 0 and w[{start} + {j} + 1] = '{x}', false)" for j, x in words]

    found = []
    for p, label in PHRASES:
        found.append(f"select doc_id, true as base, '{label}' as label, i, 1.0::double as score from p where {' and '.join(stands(list(enumerate(p.split())), 'i'))}")
    for label, text, keys in TEMPLATES:
        places, words = key_places(text, keys), text.split()
        at, anchor = places[0]
        start = f"(i - {at})"
        share = " + ".join(f"{x}::int" for x in stands(list(enumerate(words)), start))
        found.append(f"select doc_id, false as base, '{label}' as label, null as i, ({share})::double / {len(words)} as score from p where w[i + 1] = '{anchor}' and {' and '.join(stands(places, start))}")
    return f"""
with d as (select doc_id, regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
p as (select doc_id, w, unnest(range(len(w))) as i from d where list_has_any(w, {sorted({key_places(t, k)[0][1] for _, t, k in TEMPLATES} | {p.split()[0] for p, _ in PHRASES})})),
f as (select * from ({' union all '.join(found)}) where score >= {LEAST_SCORE}),
g as (select doc_id, count(*) filter (where base) as n, min(i) filter (where base) as a, max(i) filter (where base) as b, string_agg(distinct label, ',' order by label) filter (where base) as bl, string_agg(distinct label, ',' order by label) as al, max(score) as s from f group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_base, a::bigint as first_word, b::bigint as last_word, coalesce(bl, '') as base_labels, coalesce(al, '') as labels, coalesce(s, 0)::double as score from d left join g using (doc_id)"""
