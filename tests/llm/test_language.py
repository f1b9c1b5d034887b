import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from osm_tables.llm import language as L
from osm_tables.llm import queries
from osm_tables.llm.text import flat
from tests.llm.helpers import odd_docs


def plain_trigrams(text):
    low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else "\0" for c in text or "")
    low = f"\0{low}\0"
    return [low[i - 1 : i + 2] for i in range(1, len(low) - 1) if low[i] != "\0"]


def test_trigrams_match_plain_python():
    texts = [t for _, t in odd_docs()]
    keys, counts = L.trigrams(*flat(pa.array(texts, pa.string())))
    expected = [plain_trigrams(t) for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert keys.tolist() == [ord(a) << 42 | ord(b) << 21 | ord(c) for x in expected for a, b, c in x]


def test_a_long_text_has_the_trigrams_of_its_whole():
    text = "Añb 1日 " * 300_000
    keys, counts = L.trigrams(*flat(pa.array([text], pa.string())))
    expected = plain_trigrams(text)
    assert counts.tolist() == [len(expected)]
    assert keys[-5:].tolist() == [ord(a) << 42 | ord(b) << 21 | ord(c) for a, b, c in expected[-5:]]


def test_filters_agree_with_exact_sets(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chien et le chat", "fr"), (None, "en"), ("stray", None)]
    filters = L.train_filters(spark.createDataFrame(rows, "text string, lang string"))
    assert filters.languages == ["de", "en", "fr"]
    profiles = {lang: set(plain_trigrams(text)) for text, lang in rows[:3]}
    for text in ("the dog", "die katze", "chat", "x", "und the"):
        keys, counts = L.trigrams(*flat(pa.array([text], pa.string())))
        masks = filters.masks(keys, 0)
        for bit, lang in enumerate(filters.languages):
            exact = np.array([g in profiles[lang] for g in plain_trigrams(text)])
            seen = masks >> bit & 1 == 1
            assert (seen | ~exact).all()  # never missed
            assert (seen & ~exact).mean() <= 0.2
    best, score = filters.judge(*L.trigrams(*flat(pa.array(["the dog", "die katze", "12", ""], pa.string()))))
    assert best.tolist() == [1, 0, -1, -1] and (score[:2] > 0.8).all() and (score[2:] == 0).all()


def test_many_languages_share_a_filter(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"{a}{b} " * 5, f"lang-{a}{b}") for a in letters[:10] for b in letters[:10]]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = L.identify(docs, L.train_filters(docs))
    assert found.where("lang != lang_pred").count() == 0


def test_odd_rows_and_clashing_columns(spark):
    train = spark.createDataFrame([("plain english words", "en"), ("mots français", "fr")], "text string, lang string")
    filters = L.train_filters(train)
    docs = spark.createDataFrame([(*r, "own", 7) for r in odd_docs()], "doc_id bigint, text string, lang_pred string, `od.d` int")
    out = L.identify(docs, filters).collect()
    assert len(out) == len(odd_docs())
    assert out[0].asDict().keys() == {"doc_id", "text", "od.d", "lang_pred", "score"}
    for r in out:
        assert (r["lang_pred"] == "und") == (not plain_trigrams(r["text"])) and 0 <= r["score"] <= 1
    again = {(r["doc_id"], r["text"]): r["score"] for r in out}
    assert all(again[r["doc_id"], r["text"]] == r["score"] for r in out)


def test_nothing_learned_and_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    filters = L.train_filters(empty)
    docs = spark.createDataFrame([(1, "words")], "doc_id bigint, text string")
    assert [tuple(r) for r in L.identify(docs, filters).collect()] == [(1, "words", "und", 0.0)]
    assert L.identify(docs.where("false"), filters).count() == 0


def test_held_out_documents(spark, sf_dir):
    found = queries.op1_language_id(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held")).toPandas()
    both = docs.merge(found, on="doc_id")
    assert len(both) == len(docs) == len(found)
    assert (both.held == both.held_out).all()
    assert (both.lang == both.lang_pred)[both.held].mean() > 0.99
