import random
from collections import defaultdict

import pytest

from osm_tables.llm import near
from tests.llm.helpers import DOCS, odd_docs, random_text, words


def shingle_set(text):
    own = words(text, fold=True)
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def brute_force(rows):
    """Per row: (class members' smallest doc_id, links)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)].append(doc)
    smallest = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return [(doc, len(sets[i]), smallest[find(i)], links[i]) for i, (doc, _) in enumerate(rows)]


def edited(rng, text, changes):
    own = text.split()
    for _ in range(changes):
        own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
    return " ".join(own)


def planted(seed=3):
    rng = random.Random(seed)
    rows = odd_docs()
    for group in range(12):
        text = random_text(rng, rng.randrange(60, 400), 5000)
        for k in range(rng.choice([1, 2, 3, 40])):
            rows.append((1000 + len(rows), edited(rng, text, k % 4) if k % 3 else text))
    passage = random_text(rng, 60, 5000)
    rows += [(5000 + i, random_text(rng, 40, 5000) + passage) for i in range(30)]
    rng.shuffle(rows)
    return rows


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize(("block", "hot"), [(512, 1000), (4, 1), (512, 30)])
def test_classes_and_links_against_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "HOT", hot)
    rows = planted()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = near.jaccard_classes(docs).select("doc_id", "n_shingles", "class_id", "n_links").collect()
    assert order(map(tuple, found)) == order(brute_force(rows))


def test_one_of_each_class_stays(spark):
    rows = planted(4)
    docs = spark.createDataFrame([(*r, 1.5, "x") for r in rows], DOCS + ", `key` double, `a.b` string")
    kept = near.keep_first(docs)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    classes = near.jaccard_classes(docs).where("n_shingles > 0").select("class_key").distinct().count()
    worded = [x for x in found if words(x[1])]
    assert len(worded) == classes
    assert order(x for x in found if not words(x[1])) == order(x for x in rows if not words(x[1]))


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    found = near.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == {x: find(x) for x in root}
    assert len(found) == len(root)


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near.jaccard_classes(empty).count() == 0
    assert near.keep_first(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " ")], DOCS)
    assert order(map(tuple, near.jaccard_classes(blank).select("doc_id", "class_id", "n_links").collect())) == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]
    assert near.keep_first(blank).count() == 3


def test_prefix_is_shortened_to_the_target():
    length = near.prefix_length(0.8, 24, 6, 0.9999)
    found = [1 - (1 - 0.8**x) ** 24 for x in range(7)]
    assert found[length] >= 0.9999 > found[length + 1]
    with pytest.raises(ValueError, match="cannot reach"):
        near.prefix_length(0.1, 2, 4, 0.9999)
