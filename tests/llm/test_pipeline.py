import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from osm_tables.llm import queries
from tests.llm.helpers import words
from tests.llm.test_near import brute_force, shingle_set

SMALL = "/root/testdata/sf0.001"


def test_registered_queries():
    names = list(driver.queries())
    assert "pipeline" in names
    assert sorted(int(x[2:].split("_")[0]) for x in names if re.match(r"op\d+_", x)) == list(range(1, 14))


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = connection.sql(queries.oracle_sql()[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    got = queries.queries()[name](spark, SMALL).select(*columns).toArrow()
    assert Counter(zip(*got.to_pydict().values())) == Counter(zip(*expected.select(columns).to_pydict().values()))


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, on the small tables with oddities and copies added."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    copy = docs.where("doc_id % 10 = 3").withColumn("doc_id", F.col("doc_id") + 100_000)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "1 2 3 " * 40, "en", "s", 0)], docs.schema)
    clashing = ["verdict", "__w", "__H", "__weights", "__v", "__doc", "__text", "__own", "lang_pred", "LANG_SCORE", "_lang_pred"]
    out = [docs.unionByName(copy).unionByName(odd).withColumns({c: F.lit(c) for c in clashing})]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SMALL).cache())
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_copies", "packing"]
    assert all(sorted(x.columns) == sorted(stages[0].columns) for x in stages[:-1])
    for column in stages[0].columns[-11:]:
        assert {r[0] for r in stages[3].select(f"`{column}`").distinct().collect()} == {column}


def test_quality_drops_what_the_rules_reject(stages):
    before, after = stages[0].toPandas(), stages[1].toPandas()
    assert set(after.doc_id) <= set(before.doc_id.dropna())
    assert after.text.map(lambda t: len(words(t))).min() >= 50
    lost = before[~before.doc_id.isin(after.doc_id)]
    short = lost.text.map(lambda t: len(words(t)) < 50)
    strange = lost.text.map(lambda t: bool(re.search(r"\||%%|!!|\$\$", t or "")) or len(set(words(t))) < 0.6 * len(words(t)))
    assert (short | strange).mean() > 0.95  # plain prose stays


def test_language_keeps_prose(stages):
    before, after = stages[1].toPandas(), stages[2].toPandas()
    assert set(after.doc_id) <= set(before.doc_id)
    lost = before[~before.doc_id.isin(after.doc_id)]
    assert len(lost) <= 1 and not set(lost.doc_id) - {-2}
    assert -2 not in set(after.doc_id)


def test_one_of_each_group_stays(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[2].select("doc_id", "text").collect()]
    after = {r["doc_id"] for r in stages[3].select("doc_id").collect()}
    groups = Counter(c for _, _, c, _ in brute_force(before))
    kept = Counter(c for d, _, c, _ in brute_force(before) if d in after)
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    assert max(groups.values()) > 1
    assert all(shingle_set(t) for _, t in before)


def test_packing_holds_every_document(stages):
    pieces = stages[4].toPandas()
    assert set(pieces.doc_id) == {r["doc_id"] for r in stages[3].select("doc_id").collect()}
    for _, own in pieces.sort_values("start").groupby("doc_id"):
        assert own.length.sum() == own.doc_tokens.iloc[0]
        assert (own.start == own.length.cumsum() - own.length).all()


def test_run_gives_what_its_stages_give(spark):
    found = corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
    own = docs.select("doc_id", "doc_tokens").distinct().toPandas()
    assert Counter(zip(own.doc_id, own.doc_tokens)) == Counter(set(zip(found.doc_id, found.doc_tokens)))
    assert found.length.sum() == own.doc_tokens.sum()
