import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from osm_tables.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error int"


def made(n=400, width=24, seed=5):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(width)], rng.choice([0, 0, 1, None]), "c", 9) for i in range(n)]
    rows[5] = (5, rows[3][1], 1, "c", 9)  # an entry twice: ties go to the lower index
    rows += [(i, rows[7][1], 7, "hot", 1) for i in range(500, 700)]
    rows += [rows[50], rows[50], (None, rows[9][1], 2, "null id", 1), (900, None, 0, "x", 1), (901, [math.nan] * width, 0, "x", 1),
             (902, [None] * width, 0, "x", 1), (903, [-math.inf] * width, 0, "x", 1), (904, [0.0] * width, None, "zero", 1)]
    rng.shuffle(rows)
    return rows


def by_hand(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in first]
            for _, v, _ in kept:
                own[near(cut(v)[p], books[p])[1]].append(cut(v)[p])
            books[p] = [[sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)]
    coded = []
    for i, v, label in kept:
        found = [near(part, book) for part, book in zip(cut(v), books, strict=True)]
        coded.append((i, label, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    sums = {}
    for _, label, _, error in coded:
        sums[label] = sums.get(label, 0) + error
    said = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, sums[label]) for i, label, c, e in coded), key=str), hashlib.sha256(said.encode()).hexdigest()


@pytest.mark.parametrize(("entries", "bound"), [(16, 100_000), (70, 1)])
def test_codes_equal_brute_force(spark, monkeypatch, entries, bound):
    monkeypatch.setattr(V, "BROADCAST_LABELS", bound)
    df = spark.createDataFrame(made(), SCHEMA).repartition(6)
    rounds = 6 if entries == 16 else 2
    found = V.compress(df, "vec_id", "embedding", "label", entries=entries, rounds=rounds)
    rows = V.with_label_errors(found.rows)
    assert rows.columns == ["id", "label", "code", "error", "label_error"]
    got = sorted(((r["id"], r["code"], r["error"], r["label_error"]) for r in rows.collect()), key=str)
    assert (got, found.digest()) == by_hand(made(), entries=entries, rounds=rounds)


def test_candidates_hold_the_nearest_and_leave_others_out():
    rng = np.random.default_rng(2)
    book = V.Codebook(rng.integers(-500, 500, (70, 4)))
    points = rng.integers(-600, 600, (300, 4))
    far = ((points[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    best, error = book.nearest(points)
    assert (best == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
    radius = np.full(300, 200)
    masks = book.candidates(points, radius)
    box = (np.abs(points[:, None, :] - book.entries[None]) <= 200).all(axis=2)
    for j in range(70):
        assert ((masks[:, j // 64] >> np.uint64(j % 64) & np.uint64(1)).astype(bool) == box[:, j]).all()


def test_small_tables(spark):
    empty = V.compress(spark.createDataFrame([], SCHEMA), "vec_id", "embedding", "label")
    assert V.with_label_errors(empty.rows).collect() == []
    three = [(i, [float(i)] * 8, None, "", 0) for i in range(3)]
    found = V.compress(spark.createDataFrame(three, SCHEMA), "vec_id", "embedding", "label")
    assert sorted(r["code"] for r in found.rows.collect()) == ["00" * 8, "01" * 8, "02" * 8]
    none = V.compress(spark.createDataFrame([(1, [], 1, "", 0)], SCHEMA), "vec_id", "embedding", "label")
    assert [tuple(r) for r in none.rows.collect()] == [(1, 1, "00" * 8, 0)]


def test_what_does_not_fit_is_refused(spark):
    def run(rows):
        V.compress(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label").rows.collect()

    with pytest.raises(Exception, match="exceeds"):
        run([(1, [1e30] * 8, 1, "", 0)])
    with pytest.raises(Exception, match="one length"):
        run([(1, [1.0] * 9, 1, "", 0)])
    many = [(i, [1.0] * 8, 1, "", 0) for i in range(20)]
    with pytest.raises(Exception, match="vectors must all have"):
        run([*many, (99, [1.0] * 16, 1, "", 0)])


def test_labels_of_any_type(spark):
    df = spark.createDataFrame(made(60), SCHEMA).withColumn("label", F.col("label").cast("string"))
    rows = V.with_label_errors(V.compress(df, "vec_id", "embedding", "label", rounds=1).rows).collect()
    for label in {r["label"] for r in rows}:
        assert {r["label_error"] for r in rows if r["label"] == label} == {sum(r["error"] for r in rows if r["label"] == label)}
