"""Every registered query against DuckDB on the tables that the entity files were made from."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import osm_tables

QUERIES = {query.__name__: query for query in driver._QUERIES}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_queries_are_registered():
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, tables, name):
    result = QUERIES[name](spark, sf_dir)
    expected = tables.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(result.columns) == columns
    got = result.select(*[f"`{c}`" for c in columns]).toArrow()
    assert got.num_rows == expected.num_rows
    assert {n: str(t) for n, t in zip(got.schema.names, got.schema.types)} == {
        n: str(expected.schema.field(n).type) for n in columns
    }
    assert Counter(zip(*got.to_pydict().values())) == Counter(
        zip(*expected.select(columns).to_pydict().values())
    )
    assert got.num_rows > 0


def test_entry(spark):
    counts = {r["entity_type"]: r["count"] for r in driver.entry(spark).collect()}
    assert counts == {"Node": 6000, "Way": 1500, "Relation": 150}


def test_an_index_that_lacks_anything_is_seen(spark, sf_dir, tables):
    files = driver.entity_files(spark, sf_dir)
    blobs = osm_tables.blob_index(spark, files).cache()

    def found(index):
        return Counter(map(tuple, driver.index_stats(spark, files, index).collect()))

    right = found(blobs)
    columns = ["codec", "entity_type", "n", "bad_headers", "bytes_left_out"]
    expected = tables.sql(ORACLES["blob_index_stats"]).select(*columns).fetchall()
    assert right == Counter(expected)
    first = blobs.where("blob_type = 'OSMData'").orderBy("file", "offset").first()
    one = (F.col("file") == first["file"]) & (F.col("offset") == first["offset"])
    end = blobs.groupBy("file").agg(F.max("offset").alias("offset")).orderBy("file").first()
    tail = (F.col("file") == end["file"]) & (F.col("offset") == end["offset"])
    for lacking in (one, tail, F.col("file") == first["file"], F.col("blob_type") == "OSMData", F.col("blob_type") == "OSMHeader"):
        assert found(blobs.where(~lacking)) != right
    blobs.unpersist()
