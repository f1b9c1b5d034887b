"""Licence scans with a positional index of rare words.

A template is a run of words and the key phrases within it that must be there. The index holds, for
each template, the words of its key phrases and its ``RARE`` rarest other words, by inverse document
frequency over all documents, each with its place in the template. Every place of an indexed word in
a text names the place where the template would begin; places of one template that agree are
intersected by grouping. A template is found where all its key phrases stand and at least
``threshold`` of the weight (summed idf) of its indexed words agrees.

Base phrases are templates of key words only, so the same intersection finds exactly the places
where their words stand consecutively.

Everything is DataFrame functions. The index has a row per indexed template word and is broadcast;
words of texts that hold no template's rarest key word are counted but not unfolded; what is
shuffled is a row per text and per possible place of a template.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 5
THRESHOLD = 0.7

#: Base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Label, opening words of a well-known notice, and its key phrases.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", ["waived all copyright and related rights"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


@dataclass
class Template:
    label: str
    words: list[str]
    keys: list[str]
    base: bool

    def key_places(self) -> set[int]:
        out: set[int] = set()
        for key in self.keys:
            key = key.split()
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(key)] == key)
            out |= set(range(at, at + len(key)))
        return out


def templates(base=BASE, others=TEMPLATES) -> list[Template]:
    return [Template(label, phrase.split(), [phrase], True) for phrase, label in base] + [
        Template(label, words.split(), keys, False) for label, words, keys in others
    ]


def words_of(text: Column) -> Column:
    """Words, A-Z in lower case. The two other characters that have an ASCII lower case are masked."""
    plain = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\u0130\\u212A]", "\u00ff"))
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def build_index(docs: DataFrame, known: list[Template], rare: int = RARE) -> tuple[list[tuple], list[str]]:
    """Rows (word, template, place, weight, key) of the index, and the words a text must hold one of.

    Document frequencies are counted over all of ``docs``; as many numbers as templates have words
    come to the driver.
    """
    vocabulary = sorted({w for t in known for w in t.words})
    own = F.array_intersect(words_of(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    counted = docs.select(F.explode_outer(own).alias("word"), F.lit(1).alias("one"))
    times = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = docs.count()
    idf = {w: log((n + 1) / (times.get(w, 0) + 1)) + 1e-3 for w in vocabulary}
    rows, entries = [], set()
    for number, template in enumerate(known):
        keys = template.key_places()
        others = sorted((i for i in range(len(template.words)) if i not in keys), key=lambda i: (-idf[template.words[i]], i))
        for i in sorted(keys | set(others[:rare])):
            rows.append((template.words[i], number, i, idf[template.words[i]], int(i in keys)))
        entries.add(min((template.words[i] for i in keys), key=lambda w: (-idf[w], w)))
    return rows, sorted(entries)


def scan(docs: DataFrame, *, known: list[Template] | None = None, rare: int = RARE, threshold: float = THRESHOLD) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): where base phrases stand, and all labels.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest start; null without one), base_labels, labels (distinct, sorted, joined by
    commas; empty without one) and score (the largest agreeing share of a template found, 1 for a
    base phrase, else 0). Null text is empty. Repeated rows and doc_ids are scanned row by row; other
    columns are not read.
    """
    known = known or templates()
    docs = docs.select("doc_id", "text")
    index, entries = build_index(docs, known, rare)
    spark = docs.sparkSession

    def table(rows, names) -> DataFrame:
        structs = [F.struct(*[F.lit(x).alias(c) for x, c in zip(row, names)]) for row in rows]
        return spark.range(0, 1, 1, 1).select(F.explode(F.array(*structs)).alias("x")).select("x.*")

    postings = table(index, ["word", "template", "place", "weight", "key"])
    totals = [
        (i, t.label, t.base, sum(r[3] for r in index if r[1] == i), sum(r[4] for r in index if r[1] == i)) for i, t in enumerate(known)
    ]
    totals = table(totals, ["template", "label", "base", "all_weight", "all_keys"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    held = F.when(F.arrays_overlap("words", F.array(*[F.lit(w) for w in entries])), F.col("words"))
    rows = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(held).alias("at", "word"))
    met = rows.join(F.broadcast(postings), "word", "left")
    met = met.groupBy("row", "doc_id", "n_words", "template", (F.col("at") - F.col("place")).cast("long").alias("start")).agg(
        F.sum("weight").alias("weight"), F.sum("key").alias("keys")
    )
    met = met.join(F.broadcast(totals), "template", "left")
    share = F.least(F.col("weight") / F.col("all_weight"), F.lit(1.0))
    found = F.coalesce((F.col("keys") == F.col("all_keys")) & (share >= threshold), F.lit(False))
    met = met.select("row", "doc_id", "n_words", "start", "label", F.when(found, share).alias("share"), (found & F.col("base")).alias("base"), found.alias("found"))
    in_base = F.col("base")
    labels = lambda own: F.array_join(F.sort_array(F.collect_set(F.when(own, F.col("label")))), ",")
    out = met.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(in_base).alias("n_base"),
        F.min(F.when(in_base, F.col("start"))).alias("first_word"),
        F.max(F.when(in_base, F.col("start"))).alias("last_word"),
        labels(in_base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")
