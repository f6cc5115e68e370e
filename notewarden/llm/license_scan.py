"""License scans with a positional index of rare template words.

Templates are a table of passages, each with a label and mandatory key phrases.  For every word of a template the number of
documents that hold it is counted over the whole corpus; a template is indexed by its ``rare`` words of highest
inverse document frequency there, with their positions.  A file's words that are in this index, its licence words of highest
IDF, are looked up; every (file position - template position) is a vote for one alignment of one template,
and the best alignment of a template must gather at least ``MIN_SHARE`` of its indexed places.  The template counts only if all its
key phrases stand in the text.  Short base phrases are found at every place where their words stand consecutively.

The index is as large as the catalogue (``MAX_WORDS`` template words at most, else an error), never as the corpus: it is a
map literal, sent with the plan.  So the scan is one narrow projection without shuffle or Python; only the counts of template words
are aggregated before it, a row for each word.  Alignment runs only for texts that hold enough index words and all key phrases of a template.

Defined results: null and empty texts have 0 words, null places, empty labels and score 0; very long texts are scanned
whole; repeated rows stay and count in the document frequencies; words of equal frequency are taken by length, then alphabetically; ties between
alignments do not matter, as only the best count is used; an empty table gives no rows; templates without a word match nothing.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewarden.llm.common import alnum_text

#: Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: (label, passage, mandatory key phrases), as letter-and-digit words in lower case.
TEMPLATES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the"
        " rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met redistributions of source code must retain the above copyright notice neither the"
        " name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        ("redistribution and use in source and binary forms", "endorse or promote products"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
        " license as published by the free software foundation either version 3 of the license or at your option any later"
        " version",
        ("gnu general public license", "free software foundation"),
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public"
        " license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        ("gnu lesser general public license",),
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
        " license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("apache license version 2", "in compliance with the license"),
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
        " distributed with this file you can obtain one at http mozilla org mpl 2 0",
        ("mozilla public license", "source code form"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile"
        " sell or distribute this software",
        ("unencumbered software released into the public domain",),
    ),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license to view a copy"
        " of this license visit creativecommons org licenses by nc 4 0",
        ("creative commons attribution noncommercial",),
    ),
    (
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license to view a copy"
        " of this license visit creativecommons org licenses by sa 4 0",
        ("creative commons attribution sharealike",),
    ),
]
RARE = 10
MIN_SHARE = (3, 5)
MAX_WORDS = 500_000


def template_table(spark: SparkSession, templates: list = TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(label, passage, list(keys)) for label, passage, keys in templates], "label string, passage string, phrases array<string>")


def document_frequency(norm: Column, documents: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each of the words stands; one row a word reaches the driver."""
    present = F.array_intersect(F.split(norm, " "), F.lit(vocabulary))
    counts = documents.select(F.explode(present).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return {r.w: r.n for r in counts.collect()}


def rare_index(templates: list[tuple[str, list[str], list[str]]], df: dict[str, int], rare: int = RARE) -> list[list[tuple[str, int]]]:
    """For each template (label, words, phrases) the places (word, position) of its words of highest idf."""
    index = []
    for _, words, _ in templates:
        top = set(sorted(set(words), key=lambda w: (df.get(w, 0), -len(w), w))[:rare])
        index.append([(w, i) for i, w in enumerate(words) if w in top])
    return index


def _needed(places: list) -> int:
    """How many places of a template an alignment must meet."""
    return -(-MIN_SHARE[0] * len(places) // MIN_SHARE[1])


def _fewest_words(places: list[tuple[str, int]]) -> int:
    """The smallest number of different words that can meet as many places."""
    left, n = _needed(places), 0
    words = [w for w, _ in places]
    for k in sorted(map(words.count, set(words)), reverse=True):
        if left <= 0:
            break
        left, n = left - k, n + 1
    return n


def _catalogue(templates: DataFrame) -> list[tuple[str, list[str], list[str]]]:
    """(label, words, key phrases) of every template that has a word and a label."""
    norm = templates.select("label", alnum_text(F.col("passage")).alias("p"), F.transform(F.coalesce("phrases", F.array().cast("array<string>")), alnum_text).alias("k"))
    norm = norm.where("label is not null and p <> ''").distinct()
    n = norm.agg(F.sum(F.size(F.split("p", " ")))).first()[0] or 0
    if n > MAX_WORDS:
        raise ValueError(f"a catalogue of {n} words; at most {MAX_WORDS} are indexed")
    return sorted((r.label, r.p.split(), [x for x in r.k if x]) for r in norm.collect())


def license_scan(documents: DataFrame, templates: DataFrame | None = None, text: str = "text", phrases: dict = PHRASES, rare: int = RARE) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels and score; templates has label, passage and phrases."""
    norm = alnum_text(F.col(text))
    catalogue = _catalogue(template_table(documents.sparkSession) if templates is None else templates)
    vocabulary = sorted({w for _, words, _ in catalogue for w in words})
    index = rare_index(catalogue, document_frequency(norm, documents, vocabulary) if vocabulary else {}, rare)

    df = documents.withColumn("__norm", norm)
    none = F.array().cast("array<string>")
    df = df.withColumn("__words", F.when(F.col("__norm") == "", none).otherwise(F.split("__norm", " ")))
    df = df.withColumn("__line", F.concat(F.lit(" "), "__norm", F.lit(" ")))
    words, n = F.col("__words"), F.size("__words")

    def where(phrase: str) -> Column:
        parts = phrase.split()
        at = F.filter(
            F.sequence(F.lit(0), n - len(parts)),
            lambda i: _all([words[i + j] == p for j, p in enumerate(parts)]),
        )
        return F.when(F.contains("__line", F.lit(f" {phrase} ")), at).otherwise(F.array().cast("array<int>"))

    df = df.withColumns({f"__at{k}": where(p) for k, p in enumerate(phrases)})
    every = F.concat(*[F.col(f"__at{k}") for k in range(len(phrases))])
    df = df.withColumns({"__every": every, "__found": _aligned(words, F.col("__line"), catalogue, index) if index else F.array().cast(FOUND)})
    labels = F.lit([label for label, _, _ in catalogue]) if catalogue else none
    found = F.transform("__found", lambda x: F.element_at(labels, x["t"] + 1))
    base = F.array_compact(F.array(*[F.when(F.size(f"__at{k}") > 0, F.lit(v)) for k, v in enumerate(phrases.values())]))
    return df.withColumns(
        {
            "n_words": n.cast("bigint"),
            "n_base": F.size("__every").cast("bigint"),
            "first_word": F.array_min("__every").cast("bigint"),
            "last_word": F.array_max("__every").cast("bigint"),
            "base_labels": F.array_join(F.array_sort(F.array_distinct(base)), ","),
            "labels": F.array_join(F.array_sort(F.array_distinct(F.concat(base, found))), ","),
            "score": F.when(F.size("__every") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("__found", lambda x: x["share"])), F.lit(0.0))),
        }
    ).drop("__norm", "__words", "__line", "__every", "__found", *[f"__at{k}" for k in range(len(phrases))])


FOUND = "array<struct<t:int,share:double>>"


def _aligned(words: Column, line: Column, catalogue: list, index: list) -> Column:
    """(t, share of its places) of each template whose key phrases stand in the text and whose best alignment meets enough places."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, places in enumerate(index):
        for w, p in places:
            postings.setdefault(w, []).append((t, p))
    place = lambda x: F.struct(F.lit(x[0]).alias("t"), F.lit(x[1]).alias("p"))
    lookup = F.create_map(*[c for w, at in sorted(postings.items()) for c in (F.lit(w), F.array(*map(place, at)))])
    needed, size = F.lit([_needed(p) for p in index]), F.lit([len(p) for p in index])
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.array(*[F.lit(f" {k} ") for k in need]).cast("array<string>").alias("k")) for t, (_, _, need) in enumerate(catalogue)])
    possible = F.transform(F.filter(keys, lambda x: F.forall(x["k"], lambda k: F.contains(line, k))), lambda x: x["t"])
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(sorted(postings)))
    some = lambda ts: F.flatten(
        F.transform(hits, lambda h: F.transform(F.filter(F.element_at(lookup, h["w"]), lambda x: F.array_contains(ts, x["t"])), lambda x: F.struct(x["t"].alias("t"), (h["i"] - x["p"]).alias("d"))))
    )

    def step(s: Column, v: Column) -> Column:
        """Counts equal votes of a sorted array; best is that of the present template, done holds those before."""
        same, now = (s["t"] == v["t"]) & (s["d"] == v["d"]), s["t"] == v["t"]
        n = F.when(same, s["n"] + 1).otherwise(F.lit(1))
        done = F.when(~now & (s["best"] >= F.element_at(needed, F.greatest(s["t"], F.lit(0)) + 1)), F.concat(s["done"], F.array(_share(s, size)))).otherwise(s["done"])
        return F.struct(v["t"].alias("t"), v["d"].alias("d"), n.alias("n"), F.when(now, F.greatest(s["best"], n)).otherwise(n).alias("best"), done.alias("done"))

    start = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("d"), F.lit(0).alias("n"), F.lit(0).alias("best"), F.array().cast(FOUND).alias("done"))
    # a vote for no template behind all others closes the last one
    end = F.array(F.struct(F.lit(len(index)).alias("t"), F.lit(0).alias("d")))
    best = lambda ts: F.aggregate(F.concat(F.sort_array(some(ts)), end), start, step, lambda s: s["done"])
    none = F.array().cast(FOUND)
    fewest = min(_fewest_words(p) for p in index)
    found = F.element_at(F.transform(F.array(possible), lambda ts: F.when(F.size(ts) > 0, best(ts)).otherwise(none)), 1)  # possible is computed once
    return F.when(F.size(F.array_intersect(words, F.lit(sorted(postings)))) >= fewest, found).otherwise(none)


def _share(s: Column, size: Column) -> Column:
    return F.struct(s["t"].alias("t"), (s["best"] / F.element_at(size, F.greatest(s["t"], F.lit(0)) + 1)).alias("share"))


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def op3(documents: DataFrame) -> DataFrame:
    return license_scan(documents.select("doc_id", "text")).drop("text")


def _sql() -> str:
    values = ", ".join(f"({t}, '{label}', '{w}', {p})" for t, (label, passage, _) in enumerate(TEMPLATES) for p, w in enumerate(passage.split()))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    keys = ", ".join(f"({t}, '{p}')" for t, (_, _, need) in enumerate(TEMPLATES) for p in need)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
ph(phrase, label, k) AS (VALUES {phrases}),
tw(t, label, word, p) AS (VALUES {values}),
ky(t, phrase) AS (VALUES {keys}),
ps AS (SELECT r, w, unnest(range(0, len(w))) AS i FROM d),
b AS (SELECT r, label, i FROM ps JOIN ph ON w[i + 1] = string_split(phrase, ' ')[1] AND array_to_string(w[i + 1 : i + k], ' ') = phrase),
bd AS (SELECT r, count(*) AS n_base, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r),
df AS (SELECT word, count(DISTINCT r) AS c FROM ps JOIN (SELECT DISTINCT word FROM tw) ON w[i + 1] = word GROUP BY word),
rk AS (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY coalesce(c, 0), length(word) DESC, word) AS k
  FROM (SELECT DISTINCT t, word FROM tw) LEFT JOIN df USING (word)),
ix AS (SELECT t, label, word, p, count(*) OVER (PARTITION BY t) AS n FROM tw JOIN rk USING (t, word) WHERE k <= {RARE}),
v AS (SELECT r, t, label, max(c / n) AS share FROM
  (SELECT r, t, label, i - p AS delta, n, count(*) AS c FROM ps JOIN ix ON w[i + 1] = word GROUP BY ALL) WHERE {MIN_SHARE[1]} * c >= {MIN_SHARE[0]} * n GROUP BY r, t, label),
s AS (SELECT v.r, v.label, share FROM v JOIN d ON d.r = v.r WHERE NOT EXISTS
  (SELECT 1 FROM ky WHERE ky.t = v.t AND NOT contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' '))),
u AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM b UNION SELECT r, label FROM s) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce((SELECT max(share) FROM s WHERE s.r = d.r), 0.0) END::DOUBLE AS score
FROM d LEFT JOIN bd USING (r) LEFT JOIN u USING (r)
"""


SQL = _sql()
