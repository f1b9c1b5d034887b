import math
import re
from collections import Counter

import pytest

from osm_tables.llm import quality as Q
from tests.llm.helpers import DOCS, odd_docs, signed, words, xx


def base_columns(text):
    own = words(text)
    windows = [tuple(own[k : k + 3]) for k in range(len(own) - 2)]
    times = Counter(windows)
    covered = {p for k, w in enumerate(windows) if times[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered), failed


def buckets_of(text, size):
    tokens = [t for w in words(text) for t in re.findall(r"[!-&(-+/:-@\[-`{-~]+|[^!-&(-+/:-@\[-`{-~]+", w)]
    h = [signed(xx(t)) for t in tokens]
    pairs = [xx(("long", b), xx(("long", a))) for a, b in zip(h, h[1:])]
    return [x & (size - 1) for x in h] + [x & (size - 1) for x in pairs]


def rows_with_base(spark, rows, labels, **settings):
    judged = Q.judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int"), **settings)
    return judged.select("doc_id", "text", "verdict.*").collect()


LABELS = [(100, 1), (101, 1), (101, 1), (102, 0), (None, 1), (103, None), (999, 1)]


def test_every_value_against_brute_force(spark):
    rows = odd_docs(n=40)
    size = 256
    raw, good = Counter(), Counter()
    for doc, text in rows:
        grams = buckets_of(text, size)
        raw.update(grams)
        if doc in (100, 101):
            good.update(grams)
    scale = good.total() / raw.total()
    weight = [math.log((good[b] + Q.PRIOR) / (raw[b] * scale + Q.PRIOR)) for b in range(size)]
    found = rows_with_base(spark, rows, LABELS, buckets=size, threshold=-0.1)
    assert len(found) == len(rows)
    for r in found:
        n, chars, symbols, lines, repeat, failed = base_columns(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            n, chars, symbols, lines, repeat, failed
        ), r["text"]
        grams = buckets_of(r["text"], size)
        if grams:
            score = sum(weight[b] for b in grams) / len(grams)
            assert r["score"] == pytest.approx(score, abs=1e-5)
            if abs(score + 0.1) > 1e-4:
                assert r["kept"] == (not failed and score >= -0.1)
        else:
            assert r["score"] is None and r["kept"] is False


def test_long_texts_use_the_wide_form(spark, monkeypatch):
    rows = odd_docs()
    expected = {r["text"]: r["n_repeat_words"] for r in rows_with_base(spark, rows, LABELS)}
    monkeypatch.setattr(Q, "_PLACE", 10)  # texts beyond ten words no longer fit the packed form
    monkeypatch.setattr(Q, "_PLACE_BITS", 4)
    rows = [r for r in rows if len(words(r[1])) > 10]
    assert {r["text"]: r["n_repeat_words"] for r in rows_with_base(spark, rows, LABELS)} == {t: expected[t] for _, t in rows}


def test_without_trusted_labels_the_rules_decide(spark):
    found = rows_with_base(spark, odd_docs(), [(100, 0)])
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert any(r["kept"] for r in found)


def test_no_documents_and_clashing_columns(spark):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int")
    docs = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id bigint, text string, verdict string, words int")
    assert Q.judge(docs.where("false"), labels).count() == 0
    row = Q.judge(docs, labels).collect()[0]
    assert row["words"] == 2 and row["verdict"]["n_words"] == 2


def test_plan_has_no_python(spark):
    judged = Q.judge(spark.createDataFrame(odd_docs(), DOCS), spark.createDataFrame(LABELS, "doc_id bigint, quality int"))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_junk_is_told_from_prose_at_every_size(spark, sf):
    """Odd marks, tables and shouting score far below the threshold, plain prose far above it."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").repartition(8)
    found = Q.judge(docs, spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")).select("text", "verdict.*").toPandas()
    found = found[~found.base_failed]
    junk = found.text.str.contains(r"\| .* \| .* \||%%%|!! .*!! |\$\$\$", regex=True)
    assert found.score[junk].max() < Q.THRESHOLD - 0.2
    assert found.score[~junk].quantile(0.001) > Q.THRESHOLD + 0.15
    assert (found.kept == ~junk).mean() > 0.999


def test_a_filter_on_the_verdict_does_not_compute_it_again(spark):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int")
    judged = Q.judge(spark.createDataFrame(odd_docs(), DOCS), labels).where("verdict.kept").select("doc_id")
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (isnotnull(verdict" in plan and plan.count("zip_with(") <= 3
