import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from osm_tables.llm import multi_index as M

SCHEMA = "vec_id bigint, embedding array<float>, score string, page int"


def made(n=1500, width=9, seed=3):
    """Clustered vectors, copies of one vector as a third of the rows, ties, and every odd row."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    points = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, width))).astype(np.float32)
    points[rng.permutation(n)[: n // 3]] = points[7]
    rows = [(i, p.tolist(), "x", i % 3) for i, p in enumerate(points)]
    rows += [(2000, None, None, None), (2020, [0.0] * width, "z", 1), (2040, [math.nan] * width, "n", 1), (None, points[3].tolist(), "i", 1)]
    rows += [(2060, [None] + [1.0] * (width - 1), "m", 1), (2080, [math.inf] + [1.0] * (width - 1), "f", 1), rows[40], rows[41], rows[41]]
    random.Random(seed).shuffle(rows)
    return rows


def by_hand(rows, k, asks=lambda i: i % 20 == 0):
    good = [(i, v) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in dict(x for x in good if asks(x[0])).items():
        found = []
        for j, w in good:
            if i != j:
                score = 0.0
                for a, b in zip(v, w, strict=True):
                    score += a * b
                found.append((-score, j))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def found(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = M.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("page", [4096, 50])
def test_exact_bound_equals_brute_force(spark, monkeypatch, page):
    monkeypatch.setattr(M, "PAGE", page)
    monkeypatch.setattr(M, "CHUNK", 7)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], a, b) for i, v, a, b in made()]
    assert found(spark, rows, slack=1.0) == by_hand(rows, 20)


def test_fewer_candidates_than_asked_for(spark):
    rows = made(60)[:9]
    rows = [(20 * i, v, a, b) for i, (_, v, a, b) in enumerate(rows) if v and len([x for x in v if x]) == 9]
    assert found(spark, rows, k=20) == by_hand(rows, 20)


def test_empty_single_and_narrow_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], "a", 1)]) == []
    assert found(spark, [(0, [2.0], "a", 1), (1, [3.0], "a", 1), (2, [-1.0], "a", 1)]) == [(0, 1, 1, 6.0), (0, 2, 2, -2.0)]


def test_vectors_of_other_lengths_are_refused(spark):
    with pytest.raises(Exception, match="vectors must all have"):
        found(spark, [(0, [1.0, 2.0], "a", 1), (1, [1.0], "a", 1)])


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = M.search(table, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect()
    expected = by_hand(rows, 20)
    assert len(got) == len(expected)
    assert len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in expected}) >= 0.9 * len(expected)


def test_walk_goes_by_falling_offer():
    rng = np.random.default_rng(1)
    halves = [rng.normal(size=(5, 3)), rng.normal(size=(4, 3))]
    radii = [rng.random(5), rng.random(4)]
    index = M.Index(halves, radii, np.ones(20, int), np.zeros(20, int), np.ones(20, int), None)
    query = rng.normal(size=6)
    walked = list(M.Walk(index, query, 0.5))
    offer = [[h @ query[s] + 0.5 * np.linalg.norm(query[s]) * r for h, r in zip(hs, rs, strict=True)]
             for hs, rs, s in zip(halves, radii, (slice(0, 3), slice(3, 6)), strict=True)]
    assert [c for _, c in walked] == [c for _, c in sorted((-(offer[0][i] + offer[1][j]), 4 * i + j) for i in range(5) for j in range(4))]
    floor = walked[9][0]
    first, rest = (M.opened(index, query, 0.5, f) for f in (None, floor))
    assert set(first) == {c for _, c in walked} and rest == []  # 20 rows are fewer than the first round holds


def test_pages_share_small_cells_and_split_large_ones(monkeypatch):
    monkeypatch.setattr(M, "PAGE", 10)
    first, pages = M._pages(np.array([3, 4, 5, 0, 35, 2]))
    assert first.tolist() == [0, 0, 1, 1, 2, 6] and pages.tolist() == [1, 1, 1, 1, 4, 1]
