import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from osm_tables.llm import pitman_yor as P
from osm_tables.llm import queries
from tests.llm.helpers import DOCS, odd_docs, words


def base_by_hand(rows, held):
    tokens = [words(t, fold=True) + [None] for _, t in rows]
    count = Counter(w for r, own in zip(rows, tokens) if not held(r) for w in own)
    n, v = count.total(), len(count)
    return [(r[0], len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)) for r, own in zip(rows, tokens)]


@pytest.mark.parametrize("hot", [1024, 20])
def test_base_columns_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(P, "HOT", hot)
    rows = odd_docs(n=40)
    held = lambda r: r[0] is not None and r[0] % 3 == 1
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], DOCS + ", score double").repartition(3)
    found = P.score_documents(docs, F.col("doc_id") % 3 == 1).collect()
    key = lambda x: (str(x[0]), x[1], round(x[4], 6))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=key)
    expected = sorted(base_by_hand(rows, held), key=key)
    assert [x[:4] for x in got] == [x[:4] for x in expected]
    assert [x[4] for x in got] == pytest.approx([x[4] for x in expected], abs=1e-6)
    assert all(r["held_out"] == (r["doc_id"] is not None and r["doc_id"] % 3 == 1) for r in found)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found)


def history_of(blobs, settings, totals):
    """Sweeps over one part that holds everything."""
    part, history = P.Part(blobs, settings, 0), [totals]
    for _ in range(settings.sweeps):
        part.sweep(history[-1])
        history.append(P.Totals(totals.tokens, totals.customers, np.bincount(part.context, part.tables, P.CONTEXTS),
                                int(np.count_nonzero(part.word_counts)), part.root_customers.sum(), part.root_tables.sum()))
    return part, history


def one_part():
    rng = np.random.default_rng(2)
    words_ = np.sort(rng.integers(1, 2**63, 50, dtype=np.uint64))
    times = rng.integers(1, 60, 50).astype(np.uint32)
    contexts = rng.integers(0, 6, int(times.sum())).astype(np.uint16)
    blob = [words_, times, contexts | P._TRAIN, np.zeros(len(contexts), np.uint16), np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.int64)]
    customers = np.bincount(contexts, minlength=P.CONTEXTS).astype(float)
    return blob, P.Totals(len(contexts), customers, 0.5 * customers)


def test_probabilities_sum_to_one_and_seating_is_sound():
    blob, totals = one_part()
    settings = P.Settings(parts=1, sweeps=4)
    part, history = history_of([blob], settings, totals)
    assert (part.tables >= 1).all() and (part.tables <= part.counts).all()
    assert (part.root_tables <= part.root_customers).all()
    now = history[-1]
    root = part.root(now)
    unknown = (settings.root_strength + settings.root_discount * now.root_tables) / (now.words + 1) / (settings.root_strength + now.root_customers)
    assert root.sum() + unknown == pytest.approx(1)
    direct, weight = part.direct(now), P._backoff(now, settings)
    for u in range(8):  # 6 and 7 have no customers
        assert direct[part.context == u].sum() + weight[u] * (root.sum() + unknown) == pytest.approx(1)


def test_seating_follows_the_restaurant_process():
    """Mean tables of a lone word against the exact expectation, for few and for many customers."""
    rng, d, theta, p = np.random.default_rng(1), 0.5, 1.0, 0.3
    for customers in (2, 5, 12, 400):
        chance = np.zeros(customers + 2)
        chance[1] = 1.0
        for seated in range(1, customers):
            tables = np.arange(len(chance))
            new = (theta + d * tables) * p
            opens = np.where((tables > 0) & (tables <= seated), new / np.maximum(new + seated - d * tables, 1e-9), 0)
            chance = chance * (1 - opens) + np.concatenate(([0], (chance * opens)[:-1]))
        exact = (chance * np.arange(len(chance))).sum()
        n = 20_000
        found = P.seat(np.full(n, float(customers)), np.full(n, p), np.zeros(n), d, theta, rng)
        assert found.mean() == pytest.approx(exact, rel=0.03)


def test_the_same_seed_gives_the_same_scores(spark):
    docs = spark.createDataFrame(odd_docs(), DOCS)
    run = lambda: sorted((str(r["doc_id"]), r["score"]) for r in P.score_documents(docs, F.lit(False)).collect())
    assert run() == run()


def test_shuffle_partitions_change_no_score(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_TOKENS", 500)  # many parts
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 37}" for j in range(60))) for i in range(120)], DOCS).repartition(3)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted((r["doc_id"], round(r["score"], 9)) for r in P.score_documents(docs, F.lit(False)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) == 120 and found[0] == found[1]


def test_sums_at_homes():
    """Customers, words and tables of each previous word, summed over parts, come back in the order they were sent."""
    names = [np.array([3, 5, 9], np.uint64), np.array([5, 7, 9], np.uint64)]
    customers, pairs = [np.array([4, 1, 2]), np.array([1, 3, 1])], [np.array([2, 1, 2]), np.array([1, 1, 1])]
    asked = [(0, i, 1, P._packed(names[i], customers[i], pairs[i])) for i in range(2)]
    back = [r["blob"] for b in P._summed(iter([P._exchanged(asked)])) for r in b.to_pylist()]
    # 3 and 7 vary; 5 (1 + 1 customers, 1 + 1 words) and 9 do not.
    first, second = ([x.tolist() for x in P._unpacked(b)] for b in back)
    assert first == [[4, 2, 3], [2, 0, 0], [0]] and second == [[2, 3, 3], [0, 2, 0], [1]]
    sent = [(0, i, 1, P._packed(np.array(gaps), np.array(more))) for i, (gaps, more) in enumerate([([0], [1]), ([1], [2])])]
    back = [P._unpacked(r["blob"])[0].tolist() for b in P._summed(iter([P._exchanged(sent)])) for r in b.to_pylist()]
    assert back == [[1], [2]]


def test_seating_one_by_one():
    """The exact process beyond 16 customers, against its expectation and the grouped one."""
    d, theta, p, n = 0.5, 1.0, 0.3, 4000
    mean = {}
    for exact in (True, False):
        rng = np.random.default_rng(5)
        mean[exact] = P.seat(np.full(n, 200.0), np.full(n, p), np.zeros(n), d, theta, rng, exact).mean()
    assert mean[False] == pytest.approx(mean[True], rel=0.03)


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    found = {r["doc_id"]: r for r in P.score_documents(docs, F.lit(True)).collect()}
    assert found[1]["score"] == pytest.approx(0) and found[1]["base_score"] == 0 and found[1]["n_tokens"] == 3
    assert found[2]["n_tokens"] == 1 and found[2]["train_tokens"] == 0
    assert P.score_documents(docs.where("false"), F.lit(False)).count() == 0


def test_held_out_perplexity(spark, sf_dir):
    found = queries.op2_lm_scoring(spark, sf_dir).toPandas()
    held = found[found.held_out]
    perplexity = lambda column: 10 ** (-held[column].sum() / held.n_tokens.sum())
    assert perplexity("score") < 0.6 * perplexity("base_score")
    assert (found.score > found.base_score).mean() > 0.9


def test_every_previous_word_has_a_restaurant_of_its_own(spark):
    """After each of 6,000 words one other follows; classes of previous words would mix them up."""
    rows = [(i, f"a{i} b{i} " * 6) for i in range(6000)] + [(10_000, "a7 b7"), (10_001, "a7 b8")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = {r["doc_id"]: r for r in P.score_documents(docs, F.col("doc_id") >= 10_000).collect()}
    tokens, before, _ = P.tokens_of(np.frombuffer(b"a1 b1 a2", np.uint8), np.array([0, 8]))
    assert len(set(before.tolist())) == 4 and (before[1:] == tokens[:-1]).all()
    # b7 is seen six times after a7 and never after another word: nearly (6 - 0.85) / 7.
    assert found[10_000]["score"] - found[10_001]["score"] > 3
    second = [r["score"] for d, r in found.items() if d < 6000]
    assert np.std(second) < 0.05 * abs(np.mean(second))
