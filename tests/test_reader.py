"""``read_osm`` and the data source on Spark."""

import json
import os
from collections import Counter

import pytest
from micro import HEADER, block, data, dense, multiset, node, read_rows, relation, way, write
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as driver
from osm_fixtures.writer import blob, put, put_list
from osm_tables import FORMAT, OsmReadOptions, blob_index, count_by_type, osm_schema, read_osm, register_osm
from osm_tables.functions import tags_as_map, way_node_ids
from osm_tables.sources.files import to_location
from osm_tables.sources.reader import file_set, over_ranges, split_settings

TAGS = put_list(2, [1, 3]) + put_list(3, [2, 4])
STRINGS = ["", "highway", "path", "name", "Süd"]


def small_blocks(first=0):
    return [
        data(
            block(
                STRINGS,
                dense([i, i + 1], [i, i], [i, i], tags=[1, 2, 0, 0]),
                node(i + 2, rest=TAGS),
                way(i, [1, 2, 1], rest=TAGS),
                relation(i, [(1, 1, 0), (2, 0, 1)]),
            ),
            codec,
        )
        for i, codec in zip(range(first, first + 60, 10), ["raw", "zlib"] * 3)
    ]


@pytest.fixture(scope="module")
def osm_file(tmp_path_factory):
    return write(tmp_path_factory.mktemp("osm") / "small.pbf", HEADER, *small_blocks())


@pytest.fixture(scope="module")
def session(spark):
    register_osm(spark)
    return spark


def rows(df):
    return multiset(json.dumps(r.asDict(recursive=True), ensure_ascii=False) for r in df.collect())


def expected(path, **settings):
    return multiset(json.dumps(r, ensure_ascii=False) for r in read_rows(path, **settings))


def test_default_read(spark, osm_file):
    entities = read_osm(spark, osm_file)
    assert entities.schema == osm_schema(OsmReadOptions())
    assert rows(entities) == expected(osm_file)
    assert entities.count() == 30


@pytest.mark.parametrize("partitions", [1, 2, 3, 7, 1000])
def test_parallelism_does_not_change_the_rows(spark, osm_file, partitions):
    entities = read_osm(spark, osm_file, partitions=partitions)
    assert entities.rdd.getNumPartitions() >= min(partitions, os.path.getsize(osm_file))
    assert rows(entities) == expected(osm_file)


def test_parallelism_on_larger_files(spark, sf_dir):
    files = driver.entity_files(spark, sf_dir)

    def summary(df):
        return df.groupBy("entity_type").agg(F.count("*"), F.sum(F.xxhash64("*") % 1_000_003)).collect()

    whole = sorted(summary(read_osm(spark, files)))
    for settings in ({"partitions": 13}, {"partitions": 2}, {"partitions": 5}):
        assert sorted(summary(read_osm(spark, files, **settings))) == whole


def test_session_split_size(spark, osm_file):
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "64b")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        entities = read_osm(spark, osm_file)
        assert entities.rdd.getNumPartitions() > 5
        assert rows(entities) == expected(osm_file)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_several_paths_are_concatenated(spark, osm_file, tmp_path):
    other = write(tmp_path / "with a space.pbf", HEADER, *small_blocks(100))
    both = read_osm(spark, [osm_file, other, osm_file])
    assert rows(both) == expected(osm_file) + expected(other) + expected(osm_file)
    options = OsmReadOptions().with_paths(osm_file)
    assert read_osm(spark, other, options).count() == 60


def test_origin_file_is_the_text_given(spark, osm_file, tmp_path, monkeypatch):
    monkeypatch.chdir(os.path.dirname(osm_file))
    spaced = write(tmp_path / "with a space.pbf", HEADER, *small_blocks(100))
    given = ["small.pbf", f"file://{osm_file}", f"file:{osm_file}", spaced, f"file://{spaced}"]
    entities = read_osm(spark, given, include_origin_file=True)
    counts = {r["origin-file"]: r["count"] for r in entities.groupBy("`origin-file`").count().collect()}
    assert counts == dict.fromkeys(given, 30)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="absent.pbf"):
        read_osm(spark, str(tmp_path / "absent.pbf"))
    with pytest.raises(FileNotFoundError):
        read_osm(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no paths"):
        read_osm(spark)


def test_empty_files(spark, tmp_path):
    empty, header = write(tmp_path / "empty.pbf"), write(tmp_path / "header.pbf", HEADER)
    for settings in ({}, {"partitions": 3}):
        entities = read_osm(spark, [empty, header], **settings)
        assert entities.schema == osm_schema(OsmReadOptions())
        assert entities.count() == 0


def test_columns(spark, osm_file):
    chosen = read_osm(spark, osm_file, columns=["nodes", "id"])
    assert chosen.columns == ["nodes", "id"]
    assert rows(chosen) == rows(read_osm(spark, osm_file).select("nodes", "id"))
    assert read_osm(spark, osm_file, columns=[]).count() == 30
    with pytest.raises(ValueError):
        read_osm(spark, osm_file, columns=["tags"], exclude_tags=True)


def test_plan_has_no_shuffle(spark, osm_file):
    plan = read_osm(spark, osm_file)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_list_and_map_tags(spark, osm_file):
    as_map = read_osm(spark, osm_file, tags_as_map=True)
    assert as_map.schema == osm_schema(OsmReadOptions(tags_as_map=True))
    assert rows(as_map) == rows(read_osm(spark, osm_file).withColumn("tags", tags_as_map()))
    named = as_map.select(F.try_element_at("tags", F.lit("name")).alias("name"))
    assert Counter(r["name"] for r in named.collect()) == {"Süd": 12, None: 18}


def test_way_nodes(spark, osm_file):
    ids = read_osm(spark, osm_file, columns=["id", "nodes"], way_nodes_as_id_list=True)
    indexed = read_osm(spark, osm_file, columns=["id", "nodes"])
    assert rows(ids) == rows(indexed.select("id", way_node_ids().alias("nodes")))


def test_repeated_keys_obey_the_policy(session, tmp_path):
    tags = put_list(2, [1, 1]) + put_list(3, [2, 4])
    path = write(tmp_path / "dup_tag_keys.pbf", data(block(STRINGS, way(1, [1], rest=tags))))
    as_map = read_osm(session, path, tags_as_map=True)
    with pytest.raises(PySparkException, match="DUPLICATED_MAP_KEY"):
        as_map.collect()
    with pytest.raises(PySparkException, match="same tag key"):
        session.read.format(FORMAT).option("tags-as-map", "true").load(path).collect()
    last = session.read.format(FORMAT).option("tags-as-map", "true").option("mapKeyDedupPolicy", "last_win").load(path)
    assert last.first()["tags"] == {"highway": "Süd"}
    session.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    try:
        assert as_map.first()["tags"] == {"highway": "Süd"}
        register_osm(session)
        assert session.read.format(FORMAT).option("tags-as-map", "true").load(path).first()["tags"] == {"highway": "Süd"}
    finally:
        session.conf.unset("spark.sql.mapKeyDedupPolicy")
        register_osm(session)


def test_errors_name_file_and_offset(spark, tmp_path):
    path = write(tmp_path / "zstd.pbf", HEADER, blob("OSMData", b"", "raw"))
    with open(path, "ab") as f:
        message = put(2, 10) + put(7, b"zstd")
        header = put(1, "OSMData") + put(3, len(message))
        f.write(len(header).to_bytes(4, "big") + header + message)
    for settings in ({}, {"partitions": 3}):
        with pytest.raises(PySparkException, match=r"zstd\.pbf: blob at offset \d+: .*zstd"):
            read_osm(spark, path, **settings).collect()


@pytest.fixture
def nested_file(tmp_path):
    """A raw blob that holds whole blobs as text."""
    inner = b"".join(small_blocks())
    payload = put(2, way(1, [7])) + put(1, put(1, "") + put(1, inner))
    return write(tmp_path / "nested.pbf", HEADER, data(payload), *small_blocks(100))


@pytest.mark.parametrize("partitions", [1, 2, 7, 20])
def test_blobs_within_a_blob_are_not_read(session, nested_file, partitions):
    assert read_osm(session, nested_file, partitions=partitions).count() == 31
    source = session.read.format(FORMAT).option("partitions", partitions)
    assert rows(source.load(nested_file)) == expected(nested_file)


def test_what_a_task_is_sent_does_not_grow_with_the_ranges(spark, monkeypatch):
    from pyspark import cloudpickle

    sent = []
    real = type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, s: sent.append(len(cloudpickle.dumps(f))) or real(self, f, s))
    monkeypatch.setattr("osm_tables.sources.reader.file_sizes", lambda paths, s3: [10**12])
    for n in (10, 100_000):
        files = file_set(["/no/such.pbf"], n, 10**12, 2**22, 1)
        assert files.plan.n_tasks == n
        assert len(cloudpickle.dumps(files)) < 2000
        over_ranges(spark, files, lambda *_: iter(()), osm_schema(OsmReadOptions()))
    assert abs(sent[0] - sent[1]) < 100


@pytest.mark.parametrize("broadcast_bytes", [2**20, 0])
def test_spark_takes_no_read_for_smaller_than_its_files(spark, sf_dir, monkeypatch, broadcast_bytes):
    """Or it gathers large reads on the driver to join them."""
    files = driver.entity_files(spark, sf_dir)
    size = sum(os.path.getsize(to_location(f).removeprefix("file://")) for f in files)
    monkeypatch.setattr("osm_tables.sources.reader.BROADCAST_BYTES", broadcast_bytes)
    ids = read_osm(spark, files, columns=["id"])
    assert ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= size
    assert ids.count() == 76_500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size - 1)
    try:
        joined = ids.join(ids.select(F.col("id").alias("other")), F.col("id") == F.col("other"))
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark, osm_file):
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    old = configuration.get("fs.defaultFS")
    try:
        configuration.set("fs.defaultFS", "hdfs://names:8020")
        assert spark.conf.get("spark.hadoop.fs.defaultFS", None) is None
        default = split_settings(spark)["default_fs"]
        assert to_location("/data/x.osm.pbf", default) == "hdfs://names:8020/data/x.osm.pbf"
    finally:
        configuration.set("fs.defaultFS", old)
    assert to_location(osm_file, split_settings(spark)["default_fs"]) == osm_file


def test_access_settings_of_the_session_and_of_one_read(spark):
    from osm_tables.sources.datasource import _settings

    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        configuration.set("fs.s3a.endpoint", "http://one:9000")
        registered = split_settings(spark)
        assert registered["s3"]["endpoint_override"] == "http://one:9000"
        own = _settings({"fs.s3a.endpoint": "http://two:9000", "fs.s3a.access.key": "me"}, registered)
        assert own["s3"]["endpoint_override"] == "http://two:9000" and own["s3"]["access_key"] == "me"
    finally:
        configuration.unset("fs.s3a.endpoint")


def test_settings_of_one_read_through_the_data_source(session, osm_file):
    source = session.read.format(FORMAT)
    whole = source.load(osm_file)
    cut_up = session.read.format(FORMAT).option("maxPartitionBytes", "100b").option("openCostInBytes", 64).load(osm_file)
    assert cut_up.rdd.getNumPartitions() > 5 > whole.rdd.getNumPartitions()
    assert rows(cut_up) == rows(whole)


def test_blob_index(spark, osm_file):
    for partitions in (1, 5):
        blobs = blob_index(spark, osm_file, partitions).orderBy("offset").collect()
        assert [b["blob_type"] for b in blobs] == ["OSMHeader"] + ["OSMData"] * 6
        assert [b["offset"] for b in blobs[1:]] == [b["offset"] + b["length"] for b in blobs[:-1]]
        assert blobs[-1]["offset"] + blobs[-1]["length"] == os.path.getsize(osm_file)
        assert all(b["data_offset"] + b["datasize"] == b["offset"] + b["length"] for b in blobs)


def test_count_by_type(spark, osm_file):
    counts = {r["entity_type"]: r["count"] for r in count_by_type(spark, osm_file).collect()}
    assert counts == {"Node": 18, "Way": 6, "Relation": 6}
    counts = count_by_type(spark, osm_file, types={"way"}).collect()
    assert [tuple(r) for r in counts] == [("Way", 6)]
    options = OsmReadOptions().with_paths(osm_file).with_partitions(4)
    counted = count_by_type(spark, osm_file, options)
    assert rows(counted) == rows(read_osm(spark, [osm_file] * 2).groupBy("entity_type").count())


def test_count_of_kinds_that_are_absent(spark, tmp_path):
    path = write(tmp_path / "way.pbf", data(block([""], dense([]), way(1))))
    assert [tuple(r) for r in count_by_type(spark, path).collect()] == [("Way", 1)]
    assert count_by_type(spark, path, types={"node"}).collect() == []


OPTION_SETS = [
    {},
    {"types": {"node"}, "tags_as_map": True, "exclude_metadata": True},
    {"types": {"way"}, "way_nodes_as_id_list": True},
    {"types": {"relation"}, "exclude_tags": True, "partitions": 4},
    {"types": {"node", "way"}, "include_origin_file": True},
]


@pytest.mark.parametrize("settings", OPTION_SETS, ids=str)
def test_data_source_agrees(session, osm_file, settings):
    options = OsmReadOptions(**settings)
    source = session.read.format(FORMAT).options(**options.to_options()).load(osm_file)
    function = read_osm(session, osm_file, options)
    assert source.schema == function.schema == osm_schema(options)
    assert rows(source) == rows(function)


def test_data_source_paths(session, osm_file, tmp_path):
    other = write(tmp_path / "with a space.pbf", HEADER, *small_blocks(100))
    assert session.read.format(FORMAT).load([osm_file, other]).count() == 60
    options = OsmReadOptions().with_paths(osm_file, other).to_options()
    assert session.read.format(FORMAT).options(**options).load().count() == 60
    assert session.read.format(FORMAT).options(**options, path=other).load().count() == 90


def test_data_source_schema_needs_no_file(session):
    source = session.read.format(FORMAT).option("types", "way").load("/no/such/file.pbf")
    assert source.schema == osm_schema(OsmReadOptions(types={"way"}))


def test_data_source_unknown_type(session, osm_file):
    with pytest.raises(PySparkException, match="there are Node, Way, Relation"):
        session.read.format(FORMAT).option("types", "area").load(osm_file)


@pytest.mark.parametrize(
    ("condition", "n"),
    [
        ("entity_type = 'Way'", 6),
        ("entity_type = 'way'", 0),
        ("entity_type IN ('Way', 'Relation')", 12),
        ("entity_type = 'Way' AND entity_type = 'Node'", 0),
        ("entity_type = 'Way' OR id = 0", 8),
        ("entity_type <> 'Way'", 24),
        ("entity_type IS NULL", 0),
        ("entity_type = 'Node' AND id >= 10", 15),
    ],
)
def test_data_source_filters(session, osm_file, condition, n):
    source = session.read.format(FORMAT).load(osm_file)
    assert source.filter(condition).count() == n
    assert read_osm(session, osm_file).filter(condition).count() == n


@pytest.mark.parametrize("pushdown", ["true", "false"])
def test_a_filter_does_not_affect_later_queries(session, osm_file, pushdown):
    session.conf.set("spark.sql.python.filterPushdown.enabled", pushdown)
    try:
        source = session.read.format(FORMAT).load(osm_file)
        ways = source.filter("entity_type = 'Way'")
        assert ways.count() == 6
        assert source.count() == 30
        assert ways.union(source.filter("entity_type = 'Node'")).count() == 24
    finally:
        session.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_data_source_given_schema(session, osm_file):
    narrow = session.read.format(FORMAT).schema("id bigint, nodes array<struct<index:int,nodeId:bigint>>")
    assert rows(narrow.load(osm_file)) == rows(read_osm(session, osm_file, columns=["id", "nodes"]))
    for wrong in ("id int", "id bigint, shape string", "nodes array<struct<nodeId:bigint>>"):
        with pytest.raises(PySparkException):
            session.read.format(FORMAT).schema(wrong).load(osm_file).collect()


def test_sql(session, osm_file):
    session.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW osm USING {FORMAT} "
        f"OPTIONS (path '{osm_file}', types 'way,relation', `columns` 'entity_type,id')"
    )
    counts = session.sql("SELECT entity_type, count(*) FROM osm GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(r) for r in counts] == [("Relation", 6), ("Way", 6)]
    assert session.table("osm").columns == ["entity_type", "id"]
