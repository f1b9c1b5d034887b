import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from osm_tables.llm import weighted as W
from tests.llm.helpers import DOCS, odd_docs, signed, words, xx


def by_hand(text, samples):
    """The draws of a text, from the definition."""
    count = Counter(signed(xx(w)) & -2 for w in words(text))
    out = []
    for j in range(samples):
        best = None
        for term, n in count.items():
            first = xx(j, xx(("long", term)))
            second = xx(("long", signed(first)))
            u = lambda h, low, bits: ((h >> low & ((1 << bits) - 1)) + 0.5) / (1 << bits)
            r, b = -math.log(u(first, 0, 32) * u(first, 32, 32)), u(second, 0, 22)
            c = -math.log(u(second, 22, 21) * u(second, 43, 21))
            t = math.floor(math.log(n) / r + b)
            size = math.log(c) - r * (t - b + 1)
            if best is None or size < best[0]:
                best = (size, term, t)
        out.append(best and best[1:])
    return out


def likeness(x, y):
    return sum(a == b for a, b in zip(x, y)) / len(x)


def keyed(rows):
    return {(d, t or "") for d, t in rows}


def test_against_brute_force(spark):
    rows = [r for r in odd_docs() if r[0] is not None]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", fingerprint string").repartition(4)
    found = W.fingerprint_documents(docs).collect()
    assert len(found) == len(rows)
    single = {d: t or "" for d, t in rows}
    own = {}
    ids = sorted({d for d, _ in rows}, reverse=True)
    repeated = {d for d in single if len({t for x, t in rows if x == d}) > 1}
    for r in found:
        if r["doc_id"] in repeated:
            continue
        text, at = single[r["doc_id"]], ids.index(r["doc_id"])
        assert r["n_chars"] == len(text)
        own.setdefault(text, set()).add(r["fingerprint"])
        following = ids[(at + 1) % len(ids)]
        if following in repeated:
            continue
        after = single[following]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        draws = by_hand(text, W.SAMPLES)
        assert r["near_edited"] == pytest.approx(likeness(draws, by_hand(edited, W.SAMPLES)))
        assert r["near_next"] == pytest.approx(likeness(draws, by_hand(after, W.SAMPLES)))
    assert all(len(x) == 1 for x in own.values())


def test_repeated_rows_ids_and_nulls(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "other"), (None, "no id"), (None, None), (2, "c d e f")]
    found = W.fingerprint_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in found) == Counter((d, len(t or "")) for d, t in rows)
    by_text = {}
    for r in found:
        assert by_text.setdefault((r["doc_id"], r["n_chars"]), r) == r


def test_one_document_follows_itself_and_none_gives_none(spark):
    row = W.fingerprint_documents(spark.createDataFrame([(5, "ab cd")], DOCS)).collect()
    assert [(r["edited_sha256"], r["near_next"]) for r in row] == [(hashlib.sha256(b"ab ab").hexdigest(), 1.0)]
    assert W.fingerprint_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_equal_draws_estimate_generalised_jaccard(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 300))) for i in range(150)]
    found = {r["doc_id"]: r for r in W.fingerprint_documents(spark.createDataFrame(rows, DOCS)).collect()}
    texts = dict(rows)
    errors = []
    for i in range(150):
        x, y = Counter(texts[i].split()), Counter(texts[(i - 1) % 150].split())
        exact = sum((x & y).values()) / sum((x | y).values())
        errors.append(found[i]["near_next"] - exact)
    assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.15


def test_plan_has_no_python(spark):
    plan = W.fingerprint_documents(spark.createDataFrame(odd_docs(), DOCS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_likenesses_keep_the_error_bound_and_long_texts_do_not_collide(spark):
    rng = np.random.default_rng(3)
    rows, exact = [], []
    for i in range(150):  # pairs of similarity 0.8, one after another
        shared = [f"s{x}" for x in rng.choice(10**6, 240, replace=False)]
        rows += [(2 * i, " ".join(shared + [f"x{i}y{k}" for k in range(30)])), (2 * i + 1, " ".join(shared + [f"z{i}y{k}" for k in range(30)]))]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r["doc_id"]: r["near_next"] for r in W.fingerprint_documents(docs).collect()}
    errors = [found[2 * i + 1] - 0.8 for i in range(150)]
    assert W.SAMPLES >= 64 and np.std(errors) < 1.2 * math.sqrt(0.8 * 0.2 / 64) and abs(np.mean(errors)) < 0.015
    text = F.lit(" ".join(f"w{k}" for k in range(3000)))
    assert spark.range(1).select(F.size(W.pair_counts(text, text))).first()[0] == 3000


def test_terms_are_counted_in_both_texts(spark):
    texts = ["a b a c c c d", "c b b e", "", " ", "a"]
    pairs = [(x, y) for x in texts for y in texts]
    df = spark.createDataFrame(pairs, "own string, edited string")
    for r in df.select("own", "edited", W.pair_counts(F.col("own"), F.col("edited")).alias("found")).collect():
        x, y = words(r["own"]), words(r["edited"])
        wanted = {(signed(xx(w)) & -2, x.count(w), y.count(w)) for w in {*x, *y}}
        assert {tuple(f) for f in r["found"]} == wanted and len(r["found"]) == len(wanted)


def test_terms_that_cannot_be_drawn_take_no_logarithms(spark, monkeypatch):
    docs = spark.createDataFrame(odd_docs(), DOCS).union(spark.createDataFrame([(900, "a b a c d"), (901, "a " * 400 + "b")], DOCS))
    drawn = sorted(map(repr, W.fingerprint_documents(docs).collect()))
    # No term is near, or few are: what is missing is drawn from all terms, and is the same.
    for near in (1e-9, 1.0, 1e9):
        monkeypatch.setattr(W, "_NEAR", near)
        assert sorted(map(repr, W.fingerprint_documents(docs).collect())) == drawn
    terms = spark.range(20_000).select(F.xxhash64("id").alias("term"), (F.col("id") % 30 + 1).alias("n"), (F.col("id") % 64).cast("int").alias("j"))
    first = F.xxhash64("term", "j")
    u = W._uniforms(first, F.xxhash64(first))
    r, b, c = W.draw(F.col("term"), F.col("j"))
    t = F.floor(F.ln(F.col("n").cast("double")) / r + b)
    a = F.exp(c - r * (t - b + 1))
    bound = W._least(u["r"], u["b"], u["c"], F.col("n") == 1) / F.col("n")
    seen = terms.select((bound / a).alias("part")).agg(F.max("part"), F.avg("part")).first()
    assert seen[0] <= 1 + 1e-9 and seen[1] > 0.3
