"""License scans with a positional rare-token index, in DataFrame functions only.

Each licence phrase is a template: its words with their positions. The index
keeps, for each template, the words of its mandatory key phrase (of a base
phrase, all its words) of the highest inverse document frequency in the corpus,
with the templates and positions they post to. A document looks
up only these rare words among its own, each hit votes for the place where the
template would start, the votes of a template's rare words are intersected, and
the places are verified against all words of the template. A label needs its mandatory key phrase, and a template of several
words may be met in part: the score is the best share of a template's words
found at their relative positions.

Corpus statistics cover all documents; what the driver sees of them is one row
for each word of the templates.

Defined cases: a null text is empty; an empty text has no words, no labels and
score 0; long texts are scanned in whole; repeated rows give repeated results;
an empty table an empty one; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import ascii_lower, text_or_empty

#: The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: More templates: text, label, and the key phrase that must stand in the match. The notices
#: that files carry, as the licences' own texts give them, in lower case and without punctuation.
TEMPLATES = (
    ("licensed under the gnu general public license version 3", "gpl-3", "general public license version 3"),
    ("licensed under the gnu general public license version 2", "gpl-2", "general public license version 2"),
    ("licensed under the gnu lesser general public license", "lgpl", "lesser general public license"),
    ("licensed under the gnu affero general public license", "agpl", "affero general public license"),
    ("subject to the terms of the mozilla public license", "mpl-2", "mozilla public license"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", "permission is hereby granted free of charge"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", "redistribution and use in source and binary forms"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", "permission to use copy modify"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "released into the public domain"),
    ("licensed under the creative commons attribution sharealike license", "cc-by-sa", "attribution sharealike"),
    ("licensed under the creative commons attribution noncommercial license", "cc-by-nc", "attribution noncommercial"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache-2",
        "may not use this file except in compliance with the license",
    ),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
        "apache-2",
        "distributed on an as is basis without warranties or conditions",
    ),
    (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied",
        "mit",
        "included in all copies or substantial portions of the software",
    ),
    (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "bsd",
        "redistributions of source code must retain the above copyright notice",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
        "for any purpose with or without fee is hereby granted",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
        "gpl-3",
        "gnu general public license as published by the free software foundation either version 3",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license "
        "or at your option any later version",
        "gpl-2",
        "gnu general public license as published by the free software foundation either version 2",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        "lgpl",
        "terms of the gnu lesser general public license as published",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        "agpl",
        "terms of the gnu affero general public license as published",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        "mpl-2",
        "subject to the terms of the mozilla public license v 2 0",
    ),
    (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at",
        "epl-2",
        "terms of the eclipse public license 2 0",
    ),
    ("distributed under the boost software license version 1 0 see accompanying file", "bsl-1", "boost software license version 1 0"),
    (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software",
    ),
    (
        "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
        "cc0-1",
        "has waived all copyright and related or neighboring rights",
    ),
)
#: Rare words a template is looked up by, and the share of a template's words that has to be in place.
RARE, SHARE = 2, 0.6
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, in lower case; the split's empty first and last parts are cut off."""
    parts = F.split(ascii_lower(text), GAP)
    parts = F.when(parts[0] == "", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    return F.when((F.size(parts) > 0) & (F.element_at(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("x"))), -1) == ""), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of ``vocabulary`` stands; one row a word reaches the driver."""
    terms = F.array(*[F.lit(w) for w in vocabulary])
    # not explode: Spark would filter by the size of what it explodes first, and split every text again for it
    words = docs.select(F.array_intersect(words_of(text_or_empty(F.col("text"))), terms).alias("words"))
    found = words.select(F.explode_outer("words").alias("word")).filter("word is not null")
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def key_at(words: list[str], keys: list[str]) -> int:
    """Where the key phrase stands in its template."""
    return next(k for k in range(len(words)) if words[k : k + len(keys)] == keys)


def index(frequencies: dict[str, int], phrases: list[str], keys: list[str]) -> list[list[int]]:
    """For each phrase the positions of its key phrase's rarest words, rarest first, ties by position.

    Every match holds the whole key phrase, so each of these words votes for it.
    """
    out = []
    for phrase, key in zip(phrases, keys):
        words, inside = phrase.split(), key.split()
        at = key_at(words, inside)
        order = sorted(range(at, at + len(inside)), key=lambda i: (frequencies[words[i]], i))
        kept = []
        for i in order:
            if words[i] not in {words[k] for k in kept}:
                kept.append(i)
        out.append(kept[:RARE])
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``."""
    phrases = [p for p, _ in BASE] + [p for p, *_ in TEMPLATES]
    vocabulary = sorted({w for p in phrases for w in p.split()})
    posts = index(document_frequencies(docs, vocabulary), phrases, [p for p, _ in BASE] + [key for _, _, key in TEMPLATES])
    rare = sorted({p.split()[i] for p, at in zip(phrases, posts) for i in at})
    terms = F.array(*[F.lit(w) for w in rare])

    read = docs.select("doc_id", words_of(text_or_empty(F.col("text"))).alias("words"))
    # the look-up: only rare words, with their places
    hit = F.when(
        F.arrays_overlap("words", terms),
        F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x.w.isin(rare)),
    )
    read = read.withColumn("hits", F.coalesce(hit, F.array().cast("array<struct<w:string,i:int>>")))

    def vote(n: int, place: int) -> Column:
        """Where phrase n starts if its word at ``place`` is the one hit."""
        word = phrases[n].split()[place]
        return F.transform(F.filter("hits", lambda x: x.w == word), lambda x: x.i - F.lit(place))

    def starts(n: int) -> Column:
        """Places where phrase n may start: those that all its rare words vote for, as a match holds them all."""
        first, *rest = [vote(n, i) for i in posts[n]]
        return reduce(F.array_intersect, rest, F.array_distinct(first))

    def exact(n: int) -> Column:
        """Places where all words of phrase n stand; every rare word votes there, so the rarest one's votes do."""
        words = phrases[n].split()
        votes = vote(n, posts[n][0])
        whole = F.array(*[F.lit(w) for w in words])
        return F.filter(votes, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, len(words)) == whole))

    def share(n: int) -> Column:
        """The best share of phrase n's words in place, 0 without its key phrase."""
        words, (_, _, key) = phrases[n].split(), TEMPLATES[n - len(BASE)]
        keys = key.split()
        at = key_at(words, keys)
        key_array = F.array(*[F.lit(w) for w in keys])

        def one(s: Column) -> Column:
            same = sum((F.coalesce(F.get(F.col("words"), s + k) == w, F.lit(False)).cast("int") for k, w in enumerate(words)), F.lit(0))
            has_key = (s + at >= 0) & (F.slice("words", F.greatest(s + at, F.lit(0)) + 1, len(keys)) == key_array)
            return F.when(has_key, same / F.lit(float(len(words)))).otherwise(0.0)

        return F.when(F.size("hits") > 0, F.coalesce(F.array_max(F.transform(starts(n), one)), F.lit(0.0))).otherwise(0.0)

    places = [exact(n) for n in range(len(BASE))]
    read = read.select("doc_id", "words", "hits", F.size("words").cast("long").alias("n_words"), *[p.alias(f"b{n}") for n, p in enumerate(places)], *[share(n + len(BASE)).alias(f"s{n}") for n in range(len(TEMPLATES))]).drop("words", "hits")
    all_places = F.concat(*[F.col(f"b{n}") for n in range(len(BASE))])
    base = F.filter(F.array(*[F.when(F.size(f"b{n}") > 0, label) for n, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    more = F.filter(F.array(*[F.when(F.col(f"s{n}") >= SHARE, label) for n, (_, label, _) in enumerate(TEMPLATES)]), lambda x: x.isNotNull())
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return read.select(
        "doc_id",
        "n_words",
        F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"),
        F.array_max(all_places).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.when(F.size(all_places) > 0, 1.0).otherwise(F.greatest(*[F.col(f"s{n}") for n in range(len(TEMPLATES))])).alias("score"),
    )
