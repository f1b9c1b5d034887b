import random
import re

from osm_tables.llm import licences as L
from tests.llm.helpers import DOCS, odd_docs

TEXTS = [
    "Released under the MIT License.", "gnu general public license gnu general public license", "GNU-General PUBLIC\nlicense, cc by cc  by",
    "apache license", "apache. license", "apachelicense", "apache é license", "cc byé", "\u212A general public license", "gnu general public l\u0130cense",
    "x CC BY-NC 4.0 y", "Licensed under the Apache License, Version 2.0.", "cc by " * 3000, "license " * 2000 + "mit license", None, "", "...",
    "This work is licensed under the GNU General Public License, version 3.", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and",
    "gnu lesser general public license", "mit mit license license", "general public license version 3 gnu",
]


def by_hand(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    places = [(k, label) for phrase, label in L.BASE for k in range(len(own)) if own[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def rows():
    rng = random.Random(1)
    vocabulary = "gnu general public license apache cc by mit the released under version 3 x".split()
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(80)]
    return odd_docs() + [(1000 + i, t) for i, t in enumerate(TEXTS + made)] + [(1001, TEXTS[1]), (1001, TEXTS[1])]


def test_base_columns_against_brute_force(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], DOCS + ", labels string, word int").repartition(4)
    found = L.scan(docs).collect()
    assert len(found) == len(rows())
    key = lambda x: tuple(map(str, x))
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found), key=key)
    assert got == sorted(((d, *by_hand(t)) for d, t in rows()), key=key)
    for r in found:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_templates_need_their_key_phrases(spark):
    texts = {
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc-4.0",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
        "permission was hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "",
        "under the GNU Lesser General Public License this library is free": "",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": "lgpl",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd",
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOCS)
    found = {r["doc_id"]: r["labels"] for r in L.scan(docs).collect()}
    assert [found[i] for i in range(len(texts))] == list(texts.values())


def test_no_documents_and_no_python(spark):
    docs = spark.createDataFrame([], DOCS)
    assert L.scan(docs).count() == 0
    plan = L.scan(spark.createDataFrame(rows(), DOCS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
