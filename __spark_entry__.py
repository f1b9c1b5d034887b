"""

The entity files that the queries read are written by Spark from the driver's tables, once per
session and table directory; the SQL works on the tables directly and knows nothing of the files.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import osm_tables
from osm_fixtures.shipping import new_shared_directory, ship_packages
from osm_fixtures.tables import write_entity_files
from osm_tables.operators.blob_index import count_at
from osm_tables.operators.geometry import EARTH

Query = Callable[[SparkSession, str], DataFrame]

# Sums of ids are taken of remainders, so that they fit a bigint for any number of rows.
ID_MODULUS = 1_000_003

# What the filtering queries and their SQL ask for: ids, epoch milliseconds, and (south, west, north, east) in 1e-7
# degrees, which no node has for its place to the last digit.
_FIRST_WAY, _FIRST_TIME = 1000, 852_076_800_000
_BOX = (-300_000_000.5, -600_000_000.5, 455_000_000.5, 1_200_000_000.5)

_files: dict[tuple[str, str], list[str]] = {}
_zones: dict[tuple[str, str], str] = {}


def entity_files(spark: SparkSession, sf_dir: str) -> list[str]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _files:
        # The workers of a session that was started elsewhere cannot import from this directory.
        ship_packages(spark, os.path.dirname(os.path.abspath(__file__)), "osm_tables", "osm_fixtures")
        _files[key] = write_entity_files(spark, sf_dir)
    return _files[key]


def stored_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the files' blobs, made once and read from disk, as a user would keep it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _zones:
        _zones[key] = new_shared_directory(spark, "zones")
        osm_tables.blob_zones(spark, entity_files(spark, sf_dir)).write.parquet(_zones[key])
    return spark.read.parquet(_zones[key])


def read(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return osm_tables.read_osm(spark, entity_files(spark, sf_dir), **settings)


def _e7(column: str):
    return F.round(F.col(column) * 1e7).cast("long").alias(column[:3] + "_e7")


def _id_check():
    return F.sum(F.col("id") % ID_MODULUS).alias("id_check")


def _codec():
    return F.regexp_extract("`origin-file`", r"/(raw|zlib)/part-\d+\.pbf$", 1).alias("codec")


def _length(column: str, alias: str):
    # size() of null is null here, so an absent list and an empty one stay apart.
    return F.array_size(column).cast("long").alias(alias)


def entity_counts(spark, sf_dir):
    return osm_tables.count_by_type(spark, entity_files(spark, sf_dir))


def scan_all(spark, sf_dir):
    return read(spark, sf_dir, columns=["entity_type", "id"])


def scan_multi_path(spark, sf_dir):
    files = entity_files(spark, sf_dir)
    entities = osm_tables.read_osm(spark, files + files, columns=["entity_type", "id"])
    return entities.groupBy("entity_type").agg(F.count("*").alias("n"), _id_check())


def index_stats(spark, files, blobs):
    """What an index leads to: entities by codec and kind, wrong headers, and bytes it leaves out."""
    codec = F.regexp_extract("file", r"/(raw|zlib)/part-\d+\.pbf$", 1).alias("codec")
    counted = count_at(blobs).groupBy(codec, "entity_type").agg(F.sum("count").alias("n"))
    is_header = F.col("blob_type") == "OSMHeader"
    by_file = blobs.groupBy("file").agg(
        F.count_if(is_header).alias("headers"),
        F.count_if(is_header & (F.col("offset") == 0)).alias("leading"),
        F.sum("length").alias("covered"),
    )
    indexed = by_file.groupBy(codec).agg(
        F.count_if((F.col("headers") != 1) | (F.col("leading") != 1)).alias("bad_headers"),
        F.sum("covered").alias("covered"),
    )
    # Spark's own listing of the files, without their contents.
    listed = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), "length")
    sizes = listed.groupBy(codec).agg(F.sum("length").alias("size"))
    checked = sizes.join(indexed, "codec", "left").select(
        "codec", "bad_headers", (F.col("size") - F.coalesce("covered", F.lit(0))).alias("bytes_left_out")
    )
    return checked.join(counted, "codec", "left").select("codec", "entity_type", "n", "bad_headers", "bytes_left_out")


def blob_index_stats(spark, sf_dir):
    files = entity_files(spark, sf_dir)
    return index_stats(spark, files, osm_tables.blob_index(spark, files))


def scan_partitions(spark, sf_dir):
    entities = read(spark, sf_dir, columns=["entity_type", "id"], partitions=7)
    return entities.groupBy("entity_type").agg(F.count("*").alias("n"), _id_check())


def data_blob_counts(spark, sf_dir):
    entities = read(
        spark,
        sf_dir,
        columns=["entity_type", "id", "origin-file"],
        include_origin_file=True,
    )
    return entities.groupBy(_codec()).agg(F.count("*").alias("n"), _id_check())


def scan_raw_vs_zlib(spark, sf_dir):
    entities = read(
        spark, sf_dir, columns=["entity_type", "id", "origin-file"], include_origin_file=True
    )
    return entities.groupBy(_codec(), "entity_type").agg(F.count("*").alias("n"), _id_check())


def dense_vs_plain_nodes(spark, sf_dir):
    nodes = read(spark, sf_dir, types={"node"}, columns=["id", "latitude", "longitude"])
    plain = F.floor(F.col("id") / 8) % 8 == 3
    nodes = nodes.select(
        F.when(plain, "plain").otherwise("dense").alias("layout"), _e7("latitude"), _e7("longitude")
    )
    return nodes.groupBy("layout").agg(
        F.count("*").alias("n"),
        F.sum(F.col("lat_e7") % ID_MODULUS).alias("lat_check"),
        F.sum(F.col("lon_e7") % ID_MODULUS).alias("lon_check"),
    )


def block_scaling(spark, sf_dir):
    columns = ["id", "timestamp", "latitude", "longitude"]
    nodes = read(spark, sf_dir, types={"node"}, columns=columns)
    return nodes.select("id", "timestamp", _e7("latitude"), _e7("longitude"))


def origin_file_counts(spark, sf_dir):
    entities = read(spark, sf_dir, columns=["origin-file"], include_origin_file=True)
    return entities.groupBy(_codec()).count()


def sql_view_counts(spark, sf_dir):
    osm_tables.register_osm(spark)
    view = "entities_of_sql_view_counts"
    paths = json.dumps(entity_files(spark, sf_dir))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} USING {osm_tables.FORMAT} "
        f"OPTIONS (paths '{paths}', `exclude-tags` 'true', `columns` 'entity_type,id')"
    )
    return spark.sql(f"SELECT entity_type, count(*) AS n FROM {view} GROUP BY entity_type")


SHAPES = {
    "default": {},
    "node, tags as map, no metadata": {
        "types": {"node"},
        "tags_as_map": True,
        "exclude_metadata": True,
    },
    "way, nodes as ids": {"types": {"way"}, "way_nodes_as_id_list": True},
    "relation, no tags": {"types": {"relation"}, "exclude_tags": True},
}


def schema_shapes(spark, sf_dir):
    shapes = None
    for name, settings in SHAPES.items():
        entities = read(spark, sf_dir, **settings)
        fields = entities.schema.fields
        filled = entities.agg(*[F.count(f.name).alias(f.name) for f in fields])
        shape = filled.select(
            F.lit(name).alias("option_set"),
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(f.name).alias("column_name"),
                            F.lit(f.dataType.simpleString()).alias("data_type"),
                            F.col(f.name).alias("filled"),
                        )
                        for f in fields
                    ]
                )
            ),
        )
        shapes = shape if shapes is None else shapes.unionByName(shape)
    return shapes


def prune_id_only(spark, sf_dir):
    return read(spark, sf_dir, columns=["id"]).agg(F.count("*").alias("n"), _id_check())


def exclude_metadata(spark, sf_dir):
    columns = ["entity_type", "id", "tags", "nodes", "members"]
    return read(spark, sf_dir, exclude_metadata=True, columns=columns).select(
        "entity_type",
        "id",
        _length("tags", "n_tags"),
        _length("nodes", "n_nodes"),
        _length("members", "n_members"),
    )


def exclude_tags(spark, sf_dir):
    columns = ["entity_type", "id", "changeset", "nodes", "members"]
    return read(spark, sf_dir, exclude_tags=True, columns=columns).select(
        "entity_type", "id", "changeset", _length("nodes", "n_nodes"), _length("members", "n_members")
    )


def tags_array(spark, sf_dir):
    entities = read(spark, sf_dir, columns=["entity_type", "id", "tags"])
    tags = entities.select("entity_type", "id", F.posexplode("tags").alias("pos", "tag"))
    return tags.select(
        "entity_type", "id", F.col("pos").cast("long").alias("pos"), "tag.key", "tag.value"
    )


def tags_map_lookup(spark, sf_dir):
    entities = read(spark, sf_dir, columns=["entity_type", "id", "tags"], tags_as_map=True)
    return entities.select(
        "entity_type",
        "id",
        F.try_element_at("tags", F.lit("highway")).alias("highway"),
        F.try_element_at("tags", F.lit("name")).alias("name"),
        F.try_element_at("tags", F.lit("status")).alias("status"),
    )


def node_coords(spark, sf_dir):
    nodes = read(spark, sf_dir, types={"node"}, columns=["id", "latitude", "longitude"])
    return nodes.select("id", _e7("latitude"), _e7("longitude"))


def way_nodes_indexed(spark, sf_dir):
    ways = read(spark, sf_dir, types={"way"}, columns=["id", "nodes"])
    refs = ways.select("id", F.inline("nodes"))
    return refs.select("id", F.col("index").cast("long").alias("index"), F.col("nodeId").alias("node_id"))


def way_nodes_ids(spark, sf_dir):
    ways = read(
        spark, sf_dir, types={"way"}, columns=["id", "nodes"], way_nodes_as_id_list=True
    )
    return ways.select(
        "id",
        _length("nodes", "n_refs"),
        F.get("nodes", F.lit(0)).alias("first_ref"),
        F.get("nodes", F.array_size("nodes") - 1).alias("last_ref"),
    )


def relation_members(spark, sf_dir):
    relations = read(spark, sf_dir, types={"relation"}, columns=["id", "members"])
    members = relations.select("id", F.posexplode("members").alias("pos", "member"))
    return members.select("id", F.col("pos").cast("long").alias("pos"), "member.*")


METADATA = ["entity_type", "id", "version", "timestamp", "changeset", "uid", "user_sid"]


def metadata_columns(spark, sf_dir):
    return read(spark, sf_dir, columns=METADATA)


def types_node(spark, sf_dir):
    nodes = read(spark, sf_dir, types={"node"}, columns=["entity_type", "id", "changeset", "latitude"])
    return nodes.select("entity_type", "id", "changeset", _e7("latitude"))


def types_way(spark, sf_dir):
    ways = read(spark, sf_dir, types={"way"}, columns=["entity_type", "id", "changeset", "nodes"])
    return ways.select("entity_type", "id", "changeset", _length("nodes", "n_nodes"))


def types_relation(spark, sf_dir):
    relations = read(spark, sf_dir, types={"relation"}, columns=["entity_type", "id", "changeset", "members"])
    return relations.select("entity_type", "id", "changeset", _length("members", "n_members"))


def types_node_way(spark, sf_dir):
    columns = ["entity_type", "id", "changeset", "latitude", "nodes"]
    entities = read(spark, sf_dir, types={"node", "way"}, columns=columns)
    return entities.select(
        "entity_type", "id", "changeset", _e7("latitude"), _length("nodes", "n_nodes")
    )


def filter_entity_type(spark, sf_dir):
    osm_tables.register_osm(spark)
    source = spark.read.format(osm_tables.FORMAT).option("columns", "entity_type,id,nodes")
    entities = source.load(entity_files(spark, sf_dir))
    ways = entities.filter(F.col("entity_type") == "Way")
    return ways.select("entity_type", "id", _length("nodes", "n_nodes"))


SELECTIONS = {
    "AllEntities": None,
    "NodesOnly": {"node"},
    "WaysOnly": {"way"},
    "RelationsOnly": {"relation"},
}


def full_scan(spark, sf_dir):
    """Every column of every selected entity, drawn into one row per selection: sizes, contents and their order."""

    def content_sum(entities, column, alias, value):
        if column not in entities.columns:
            return F.lit(None).cast("long").alias(alias)
        each = F.transform(column, lambda x, i: (i + 1) * value(x).cast("long"))
        return F.sum(F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)).alias(alias)

    def size_sum(entities, column, alias):
        size = F.sum(F.array_size(column)) if column in entities.columns else F.lit(None)
        return size.cast("long").alias(alias)

    def number_sum(entities, column, alias):
        known = column in entities.columns
        return (F.sum(_e7(column) % ID_MODULUS) if known else F.lit(None).cast("long")).alias(alias)

    scans = None
    for name, types in SELECTIONS.items():
        entities = read(spark, sf_dir, types=types)
        scan = entities.agg(
            F.lit(name).alias("selection"),
            F.count("entity_type").alias("n"),
            _id_check(),
            F.sum("version").alias("versions"),
            F.sum(F.col("timestamp") % ID_MODULUS).alias("timestamp_check"),
            F.sum(F.col("changeset") % ID_MODULUS).alias("changeset_check"),
            F.sum("uid").alias("uid_check"),
            F.sum(F.length("user_sid")).alias("user_letters"),
            size_sum(entities, "tags", "n_tags"),
            number_sum(entities, "latitude", "lat_check"),
            number_sum(entities, "longitude", "lon_check"),
            size_sum(entities, "nodes", "n_refs"),
            size_sum(entities, "members", "n_members"),
            content_sum(entities, "tags", "tag_check", lambda x: 7 * F.length(x["key"]) + 13 * F.length(x["value"])),
            content_sum(entities, "nodes", "ref_check", lambda x: x["nodeId"] % 1009),
            content_sum(
                entities, "members", "member_check",
                lambda x: x["member_id"] % 1009 + F.length(x["role"]) + 3 * F.length(x["type"]),
            ),
        )
        scans = scan if scans is None else scans.unionByName(scan)
    return scans


def data_source_options(spark, sf_dir):
    """Options built in steps, passed to the data source as text and read back there."""
    osm_tables.register_osm(spark)
    options = (
        osm_tables.OsmReadOptions()
        .with_type("node")
        .with_type("RELATION")
        .with_partitions(2)
        .with_tags_as_map()
        .with_exclude_metadata()
        .with_include_origin_file()
        .with_paths(*entity_files(spark, sf_dir))
    )
    source = spark.read.format(osm_tables.FORMAT).options(**options.to_options())
    entities = source.option("columns", "entity_type,id,origin-file,tags,members").load()
    return entities.select(
        "entity_type",
        "id",
        _codec(),
        F.try_element_at("tags", F.lit("línea")).alias("linea"),
        F.try_element_at("tags", F.lit("segment")).alias("segment"),
        _length("members", "n_members"),
    )


def indexed_scan(spark, sf_dir):
    """`scan_all` by a stored index: no range is searched."""
    return osm_tables.read_indexed(stored_zones(spark, sf_dir), columns=["entity_type", "id"])


def skipped_scan(spark, sf_dir):
    """Late ways, of which most blobs can hold none: only the others are opened."""
    where = osm_tables.Where(ids=(_FIRST_WAY, None), times=(_FIRST_TIME, None))
    columns = ["entity_type", "id", "timestamp", "nodes"]
    ways = osm_tables.read_indexed(stored_zones(spark, sf_dir), columns=columns, where=where, types={"way"})
    return ways.select("entity_type", "id", "timestamp", _length("nodes", "n_nodes"))


def tag_filter(spark, sf_dir):
    """Nodes with a key, within a box: other nodes are not built, blocks without the key not looked at."""
    south, west, north, east = (x / 1e7 for x in _BOX)
    where = osm_tables.Where(keys={"línea"}, box=(south, west, north, east))
    nodes = read(spark, sf_dir, where=where)
    return nodes.select("entity_type", "id", "user_sid", F.array_size("tags").cast("long").alias("n_tags"), _e7("latitude"), _e7("longitude"))


def zone_totals(spark, sf_dir):
    """What the zone maps say of all blobs together."""
    zones = stored_zones(spark, sf_dir)
    return zones.agg(
        *(F.sum(f"n_{kind}").alias(f"n_{kind}") for kind in ("nodes", "ways", "relations")),
        F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"),
        F.round(F.min("min_latitude") * 1e7).cast("long").alias("south"), F.round(F.max("max_latitude") * 1e7).cast("long").alias("north"),
        F.round(F.min("min_longitude") * 1e7).cast("long").alias("west"), F.round(F.max("max_longitude") * 1e7).cast("long").alias("east"),
        F.min("min_timestamp").alias("first"), F.max("max_timestamp").alias("last"),
    )


def way_lines(spark, sf_dir):
    """Ways with their length in whole metres and their box."""
    columns = ["entity_type", "id", "version", "timestamp", "latitude", "longitude", "nodes"]
    lines = osm_tables.way_lines(read(spark, sf_dir, types={"node", "way"}, columns=columns))
    box = (F.round(F.col(c) * 1e7).cast("long").alias(c) for c in ("south", "west", "north", "east"))
    return lines.select("id", "n_refs", "n_missing", F.round("length").cast("long").alias("metres"), *box)


def relation_closure(spark, sf_dir):
    """All that relations hold, through relations in them."""
    return osm_tables.relation_closure(read(spark, sf_dir, types={"relation"}, columns=["entity_type", "id", "members"]))


def relation_groups(spark, sf_dir):
    """Relations that hang together by holding one another."""
    relations = read(spark, sf_dir, types={"relation"}, columns=["entity_type", "id", "members"])
    held = relations.select(F.col("id").alias("a"), F.explode("members").alias("x")).where("x.type = 'Relation'")
    edges = held.select("a", F.col("x.member_id").alias("b")).unionByName(relations.select(F.col("id").alias("a"), F.col("id").alias("b")))
    return osm_tables.components(edges)


def way_components(spark, sf_dir):
    """Ways that hang together by shared nodes."""
    return osm_tables.way_components(read(spark, sf_dir, types={"way"}, columns=["entity_type", "id", "nodes"]))


def relation_rings(spark, sf_dir):
    """Ways of relations, stitched end to end."""
    columns = ["entity_type", "id", "nodes", "members"]
    rings = osm_tables.relation_rings(read(spark, sf_dir, types={"way", "relation"}, columns=columns))
    return rings.select("id", "ring", "kind", "n_ways", F.concat_ws(",", "ways").alias("ways"))


def nodes_in_boxes(spark, sf_dir):
    """How many nodes lie in each of many boxes, one for each supplier."""
    nodes = read(spark, sf_dir, types={"node"}, columns=["entity_type", "id", "latitude", "longitude"])
    key = F.col("s_suppkey")
    south, west, size = (key * 7919) % 170 - 85.5, (key * 104_729) % 360 - 180.5, 0.25 + key % 13
    boxes = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("box"), south.alias("south"), west.alias("west"), (south + size).alias("north"),
        F.when(west + size > 180, west + size - 360).otherwise(west + size).alias("east"),
    )
    return osm_tables.nodes_in_boxes(nodes, boxes, {"id_check": F.col("id") % ID_MODULUS})


def _extracts(spark, sf_dir):
    """Two overlapping extracts: the files' entities without some, and the same later, with some edited."""
    entities = read(spark, sf_dir, exclude_tags=True)
    edited = (F.col("id") % 5 == 0) & F.col("version").isNotNull()
    after = entities.withColumn("changeset", F.when(edited, F.col("changeset") + 1).otherwise(F.col("changeset")))
    after = after.withColumn("version", F.when(edited, F.col("version") + 1).otherwise(F.col("version")))
    return entities.where("id % 7 <> 0"), after.where("id % 11 <> 0")


def latest_entities(spark, sf_dir):
    """Two extracts as one, each entity in its latest state."""
    before, after = _extracts(spark, sf_dir)
    latest = osm_tables.latest_entities(before.unionByName(after))
    sizes = [F.coalesce(F.array_size(c), F.lit(-1)).cast("long").alias(n) for c, n in (("nodes", "n_nodes"), ("members", "n_members"))]
    return latest.select("entity_type", "id", "version", "timestamp", "changeset", *sizes)


def extract_diff(spark, sf_dir):
    """What changed from one extract to the next."""
    return osm_tables.extract_diff(*_extracts(spark, sf_dir))


def tag_rollup(spark, sf_dir):
    """Tags, values and users by kind and key, merged from the sketches of each file; numbers above 500 are estimates and left out."""
    columns = ["entity_type", "uid", "tags"]
    sketches = [osm_tables.tag_sketches(osm_tables.read_osm(spark, f, columns=columns)) for f in entity_files(spark, sf_dir)]
    few = [F.when(F.col(c) <= 500, F.col(c)).alias(c) for c in ("n_values", "n_users")]
    return osm_tables.tag_rollup(*sketches).select("entity_type", "key", "n", *few)


def heavy_tags(spark, sf_dir):
    """Tags that make up a hundredth of the tags of their kind."""
    return osm_tables.heavy_tags(read(spark, sf_dir, columns=["entity_type", "tags"]))


_QUERIES: tuple[Query, ...] = (
    entity_counts,
    scan_all,
    scan_multi_path,
    blob_index_stats,
    scan_partitions,
    data_blob_counts,
    scan_raw_vs_zlib,
    dense_vs_plain_nodes,
    block_scaling,
    origin_file_counts,
    sql_view_counts,
    schema_shapes,
    prune_id_only,
    exclude_metadata,
    exclude_tags,
    tags_array,
    tags_map_lookup,
    node_coords,
    way_nodes_indexed,
    way_nodes_ids,
    relation_members,
    metadata_columns,
    types_node,
    types_way,
    types_relation,
    types_node_way,
    filter_entity_type,
    full_scan,
    data_source_options,
    indexed_scan,
    skipped_scan,
    tag_filter,
    zone_totals,
    way_lines,
    relation_closure,
    relation_groups,
    way_components,
    relation_rings,
    nodes_in_boxes,
    latest_entities,
    extract_diff,
    tag_rollup,
    heavy_tags,
)


def entry(spark: SparkSession) -> DataFrame:
    return entity_counts(spark, "/root/testdata/sf0.001")


def _training_data():
    """The queries of the optional training-data subpackage; None where it has been removed."""
    try:
        from osm_tables.llm import queries as module
    except ModuleNotFoundError as error:
        if error.name not in {"osm_tables.llm", "corpus_pipeline"}:
            raise
        return None
    return module


def queries() -> dict[str, Query]:
    own = {query.__name__: query for query in _QUERIES}
    more = _training_data()
    return own | more.queries() if more else own


# What the files hold, stated over the tables: one row per entity, and one per tag, way node and
# member. ``codec_key`` decides the file's codec.
_ENTITIES = """
WITH RECURSIVE node AS (
    SELECT 'Node' AS entity_type, l_orderkey * 8 + l_linenumber AS id, l_orderkey AS codec_key,
           l_orderkey % 8 = 3 AS plain,
           NOT (l_orderkey % 8 = 3 AND l_linenumber = 2) AS has_info,
           1 + l_linenumber % 3 AS version,
           date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 86400000
               + l_linenumber * 1000 AS "timestamp",
           l_partkey AS changeset, l_suppkey % 1000003 AS uid,
           'usér-' || l_returnflag || l_linestatus AS user_sid,
           l_partkey % 5 = 0 AS tagged,
           'crossing-' || l_returnflag AS highway, l_linestatus AS linea,
           (l_partkey * 15485863 + l_orderkey * 7919) % 1700000001 - 850000000 AS lat_e7,
           (l_suppkey * 32452843 + l_orderkey * 104729 + l_linenumber) % 3600000001 - 1800000000
               AS lon_e7
    FROM lineitem
), way AS (
    SELECT 'Way' AS entity_type, o_orderkey AS id, o_orderkey AS codec_key,
           o_orderkey % 11 <> 0 AS has_info, 1 AS version,
           date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400000
               + o_custkey % 1000 AS "timestamp",
           o_custkey AS changeset, o_orderkey % 1000003 AS uid, o_orderpriority AS user_sid,
           o_orderkey % 7 <> 0 AS tagged, o_orderstatus AS status, o_orderpriority AS priority,
           o_orderkey % 9 AS n_different, o_orderkey % 9 >= 4 AND o_orderkey % 2 = 0 AS closed,
           o_orderkey % 9 + CASE WHEN o_orderkey % 9 >= 4 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END
               AS n_nodes
    FROM orders
), way_node AS (
    SELECT id, pos - 1 AS "index", id * 8 + (pos * 5) % 8 AS node_id
    FROM (SELECT id, unnest(range(1, n_different + 1)) AS pos FROM way)
    UNION ALL
    SELECT id, n_different, id * 8 + 5 FROM way WHERE closed
), relation AS (
    SELECT 'Relation' AS entity_type, c_custkey AS codec_key, TRUE AS has_info,
           CASE WHEN c_custkey % 10 = 3 THEN -c_custkey ELSE c_custkey END AS id,
           2 AS version, 1577836800000 + c_custkey * 1000 AS "timestamp",
           c_custkey + 100 AS changeset, c_nationkey AS uid, c_mktsegment AS user_sid,
           c_name AS name, c_mktsegment AS segment, c_custkey % 6 AS n_members
    FROM customer
), member AS (
    SELECT id, pos, codec_key * 3 - pos * 1000 AS member_id,
           CASE WHEN (codec_key + pos) % 4 = 0 THEN '' ELSE segment || '-' || pos END AS role,
           ['Node', 'Way', 'Relation'][CAST((codec_key + pos) % 3 AS INT) + 1] AS type
    FROM (SELECT id, codec_key, segment, unnest(range(0, n_members)) AS pos FROM relation)
), entity AS (
    SELECT entity_type, id, codec_key, has_info, version, "timestamp", changeset, uid, user_sid FROM node
    UNION ALL
    SELECT entity_type, id, codec_key, has_info, version, "timestamp", changeset, uid, user_sid FROM way
    UNION ALL
    SELECT entity_type, id, codec_key, has_info, version, "timestamp", changeset, uid, user_sid
    FROM relation
), metadata AS (
    SELECT entity_type, id,
           CAST(CASE WHEN has_info THEN version END AS INT) AS version,
           CASE WHEN has_info THEN "timestamp" END AS "timestamp",
           CASE WHEN has_info THEN changeset END AS changeset,
           CAST(CASE WHEN has_info THEN uid END AS INT) AS uid,
           CASE WHEN has_info THEN user_sid END AS user_sid
    FROM entity
), codec AS (
    SELECT entity_type, id, CASE WHEN codec_key % 4 = 0 THEN 'raw' ELSE 'zlib' END AS codec FROM entity
), tag AS (
    SELECT entity_type, id, 0 AS pos, 'highway' AS key, highway AS value FROM node WHERE tagged
    UNION ALL
    SELECT entity_type, id, 1, 'línea', linea FROM node WHERE tagged
    UNION ALL
    SELECT entity_type, id, 0, 'status', status FROM way WHERE tagged
    UNION ALL
    SELECT entity_type, id, 1, 'priority', priority FROM way WHERE tagged
    UNION ALL
    SELECT entity_type, id, 0, 'name', name FROM relation
    UNION ALL
    SELECT entity_type, id, 1, 'segment', segment FROM relation
)
"""

_CHECKS = f"count(*) AS n, CAST(sum(id % {ID_MODULUS}) AS BIGINT) AS id_check"

_METADATA_SHAPE = [
    ("version", "int", "has_info"),
    ("timestamp", "bigint", "has_info"),
    ("changeset", "bigint", "has_info"),
    ("uid", "int", "has_info"),
    ("user_sid", "string", "has_info"),
]
_TAG_LIST = "array<struct<key:string,value:string>>"
_NODE_LIST = "array<struct<index:int,nodeId:bigint>>"
_MEMBER_LIST = "array<struct<member_id:bigint,role:string,type:string>>"
_SHAPE_COLUMNS = {
    "default": [
        ("entity_type", "string", "TRUE"),
        ("id", "bigint", "TRUE"),
        *_METADATA_SHAPE,
        ("tags", _TAG_LIST, "tagged"),
        ("latitude", "double", "entity_type = 'Node'"),
        ("longitude", "double", "entity_type = 'Node'"),
        ("nodes", _NODE_LIST, "entity_type = 'Way'"),
        ("members", _MEMBER_LIST, "entity_type = 'Relation'"),
    ],
    "node, tags as map, no metadata": [
        ("entity_type", "string", "entity_type = 'Node'"),
        ("id", "bigint", "entity_type = 'Node'"),
        ("tags", "map<string,string>", "entity_type = 'Node' AND tagged"),
        ("latitude", "double", "entity_type = 'Node'"),
        ("longitude", "double", "entity_type = 'Node'"),
    ],
    "way, nodes as ids": [
        ("entity_type", "string", "entity_type = 'Way'"),
        ("id", "bigint", "entity_type = 'Way'"),
        *[(n, t, f"entity_type = 'Way' AND {c}") for n, t, c in _METADATA_SHAPE],
        ("tags", _TAG_LIST, "entity_type = 'Way' AND tagged"),
        ("nodes", "array<bigint>", "entity_type = 'Way'"),
    ],
    "relation, no tags": [
        ("entity_type", "string", "entity_type = 'Relation'"),
        ("id", "bigint", "entity_type = 'Relation'"),
        *[(n, t, f"entity_type = 'Relation' AND {c}") for n, t, c in _METADATA_SHAPE],
        ("members", _MEMBER_LIST, "entity_type = 'Relation'"),
    ],
}


def _shapes_sql() -> str:
    rows = [
        f"SELECT '{shape}' AS option_set, '{column}' AS column_name, '{data_type}' AS data_type, "
        f"count(*) FILTER ({condition}) AS filled FROM every"
        for shape, columns in _SHAPE_COLUMNS.items()
        for column, data_type, condition in columns
    ]
    every = """, every AS (
        SELECT entity_type, has_info, tagged FROM node
        UNION ALL SELECT entity_type, has_info, tagged FROM way
        UNION ALL SELECT entity_type, has_info, TRUE FROM relation
    ) """
    return every + " UNION ALL ".join(rows)


_SELECTION_TOTALS = f"""
, each AS (
    SELECT entity_type, id, has_info, version, "timestamp", changeset, uid, user_sid,
           CASE WHEN tagged THEN 2 END AS n_tags, lat_e7, lon_e7,
           CAST(NULL AS BIGINT) AS n_refs, CAST(NULL AS BIGINT) AS n_members FROM node
    UNION ALL
    SELECT entity_type, id, has_info, version, "timestamp", changeset, uid, user_sid,
           CASE WHEN tagged THEN 2 END, NULL, NULL, n_nodes, NULL FROM way
    UNION ALL
    SELECT entity_type, id, has_info, version, "timestamp", changeset, uid, user_sid,
           2, NULL, NULL, NULL, n_members FROM relation
), selected AS (
    SELECT 'AllEntities' AS selection, * FROM each
    UNION ALL
    SELECT entity_type || 'sOnly', * FROM each
), inside AS (
    SELECT entity_type, (pos + 1) * (7 * length(key) + 13 * length(value)) AS tag,
           CAST(NULL AS BIGINT) AS ref, CAST(NULL AS BIGINT) AS member FROM tag
    UNION ALL
    SELECT 'Way', NULL, ("index" + 1) * (node_id % 1009), NULL FROM way_node
    UNION ALL
    SELECT 'Relation', NULL, NULL,
           (pos + 1) * (member_id % 1009 + length(role) + 3 * length(type)) FROM member
), contents AS (
    SELECT selection, CAST(sum(tag) AS BIGINT) AS tag_check, CAST(sum(ref) AS BIGINT) AS ref_check,
           CAST(sum(member) AS BIGINT) AS member_check
    FROM (SELECT 'AllEntities' AS selection, * FROM inside
          UNION ALL SELECT entity_type || 'sOnly', * FROM inside)
    GROUP BY selection
)
SELECT * FROM (
SELECT selection, {_CHECKS},
       CAST(sum(version) FILTER (has_info) AS BIGINT) AS versions,
       CAST(sum("timestamp" % {ID_MODULUS}) FILTER (has_info) AS BIGINT) AS timestamp_check,
       CAST(sum(changeset % {ID_MODULUS}) FILTER (has_info) AS BIGINT) AS changeset_check,
       CAST(sum(uid) FILTER (has_info) AS BIGINT) AS uid_check,
       CAST(sum(length(user_sid)) FILTER (has_info) AS BIGINT) AS user_letters,
       CAST(sum(n_tags) AS BIGINT) AS n_tags,
       CAST(sum(lat_e7 % {ID_MODULUS}) AS BIGINT) AS lat_check,
       CAST(sum(lon_e7 % {ID_MODULUS}) AS BIGINT) AS lon_check,
       CAST(sum(n_refs) AS BIGINT) AS n_refs, CAST(sum(n_members) AS BIGINT) AS n_members
FROM selected GROUP BY selection) LEFT JOIN contents USING (selection)"""


# Line items may share an id: the newest counts.
_LINES_SQL = f"""
, newest AS (
    SELECT id, lat_e7, lon_e7 FROM node
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN has_info THEN version ELSE -1 END DESC,
                               CASE WHEN has_info THEN "timestamp" ELSE -1 END DESC, lat_e7 DESC, lon_e7 DESC) = 1
), place AS (
    SELECT w.id, w."index", n.lat_e7 / 1e7 AS lat, n.lon_e7 / 1e7 AS lon, n.lat_e7, n.lon_e7
    FROM way_node w LEFT JOIN newest n ON n.id = w.node_id
), step AS (
    SELECT *, lead(lat) OVER o AS lat2, lead(lon) OVER o AS lon2 FROM place WINDOW o AS (PARTITION BY id ORDER BY "index")
), measured AS (
    SELECT *, CASE WHEN h > 1 THEN 1.0 ELSE h END AS a FROM (
        SELECT *, sin(radians(lat2 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(lat2)) * sin(radians(lon2 - lon) / 2) ** 2 AS h FROM step)
), line AS (
    SELECT id, count(*) AS n_refs, count(*) FILTER (lat IS NULL) AS n_missing,
           CASE WHEN count(lat) > 0 THEN sum(coalesce(2 * {EARTH} * atan2(sqrt(a), sqrt(1 - a)), 0)) END AS metres,
           min(lat_e7) AS south, min(lon_e7) AS west, max(lat_e7) AS north, max(lon_e7) AS east
    FROM measured GROUP BY id
)
SELECT way.id, coalesce(n_refs, 0) AS n_refs, coalesce(n_missing, 0) AS n_missing, CAST(round(metres) AS BIGINT) AS metres,
       south, west, north, east
FROM way LEFT JOIN line USING (id)"""

# Recursion stands in the first WITH, which the entities' own tables follow.
_CLOSURE_SQL = """
, held AS (SELECT DISTINCT id, type AS member_type, member_id FROM member
), reached AS (
    SELECT id, member_id, 1 AS depth FROM held WHERE member_type = 'Relation'
    UNION SELECT r.id, h.member_id, r.depth + 1 FROM reached r JOIN held h ON h.id = r.member_id AND h.member_type = 'Relation' AND r.depth < 40
), holder AS (SELECT id, id AS through, 0 AS depth FROM (SELECT DISTINCT id FROM held) UNION ALL SELECT id, member_id, depth FROM reached)
SELECT holder.id, member_type, member_id, CAST(min(depth) + 1 AS INTEGER) AS depth
FROM holder JOIN held ON held.id = holder.through GROUP BY ALL"""

_GROUPS_SQL = """
, link AS (
    SELECT id AS a, member_id AS b FROM member WHERE type = 'Relation' UNION SELECT member_id, id FROM member WHERE type = 'Relation'
    UNION SELECT id, id FROM relation
), reached AS (
    SELECT a AS id, b AS other FROM link UNION SELECT r.id, l.b FROM reached r JOIN link l ON l.a = r.other
)
SELECT id, min(other) AS component FROM reached GROUP BY id"""

_COMPONENTS_SQL = """
, reached AS (
    SELECT id, id AS other FROM way
    UNION SELECT r.id, y.id FROM reached r JOIN way_node x ON x.id = r.other JOIN way_node y ON y.node_id = x.node_id
)
SELECT id, min(other) AS component FROM reached GROUP BY id"""

# Ways of the files share no node, so a ring has one way; tests have others.
_RINGS_SQL = """
, ends AS (
    SELECT id AS way, min(node_id) FILTER ("index" = 0) AS first, max_by(node_id, "index") AS last FROM way_node GROUP BY id
), own AS (SELECT DISTINCT m.id, way, first, last FROM member m JOIN ends ON way = member_id WHERE type = 'Way')
SELECT id, way AS ring, CASE WHEN first = last THEN 'ring' ELSE 'open' END AS kind, CAST(1 AS BIGINT) AS n_ways,
       CASE WHEN first = last THEN CAST(way AS VARCHAR) ELSE '' END AS ways
FROM own"""

_EXTRACTS_SQL = """
, each AS (
    SELECT m.*, coalesce(w.n_nodes, -1) AS n_nodes, coalesce(r.n_members, -1) AS n_members FROM metadata m
    LEFT JOIN way w ON w.entity_type = m.entity_type AND w.id = m.id LEFT JOIN relation r ON r.entity_type = m.entity_type AND r.id = m.id
), before AS (SELECT * FROM each WHERE id % 7 <> 0
), after AS (
    SELECT * REPLACE (CAST(version + CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS INT) AS version,
                      changeset + CASE WHEN version IS NOT NULL AND id % 5 = 0 THEN 1 ELSE 0 END AS changeset)
    FROM each WHERE id % 11 <> 0
)"""


_USED_TAGS_SQL = ", used_tag AS (" + " UNION ALL ".join(
    f"SELECT entity_type, '{key}' AS key, {column} AS value, CASE WHEN has_info THEN uid END AS uid FROM {table}{where}"
    for table, key, column, where in (
        ("node", "highway", "highway", " WHERE tagged"),
        ("node", "línea", "linea", " WHERE tagged"),
        ("way", "status", "status", " WHERE tagged"),
        ("way", "priority", "priority", " WHERE tagged"),
        ("relation", "name", "name", ""),
        ("relation", "segment", "segment", ""),
    )
) + ")"


def oracle_sql() -> dict[str, str]:
    """For each key in ``queries()``, SQL over the tables with the same result."""
    parts = {
        "entity_counts": 'SELECT entity_type, count(*) AS "count" FROM entity GROUP BY entity_type',
        "scan_all": "SELECT entity_type, id FROM entity",
        "scan_multi_path": f"""
            SELECT entity_type, 2 * count(*) AS n, CAST(2 * sum(id % {ID_MODULUS}) AS BIGINT) AS id_check
            FROM entity GROUP BY entity_type""",
        "blob_index_stats": """
            SELECT codec, entity_type, count(*) AS n, CAST(0 AS BIGINT) AS bad_headers,
                   CAST(0 AS BIGINT) AS bytes_left_out FROM codec GROUP BY codec, entity_type""",
        "scan_partitions": f"SELECT entity_type, {_CHECKS} FROM entity GROUP BY entity_type",
        "data_blob_counts": f"SELECT codec, {_CHECKS} FROM codec GROUP BY codec",
        "scan_raw_vs_zlib": f"SELECT codec, entity_type, {_CHECKS} FROM codec GROUP BY codec, entity_type",
        "dense_vs_plain_nodes": f"""
            SELECT CASE WHEN plain THEN 'plain' ELSE 'dense' END AS layout, count(*) AS n,
                   CAST(sum(lat_e7 % {ID_MODULUS}) AS BIGINT) AS lat_check,
                   CAST(sum(lon_e7 % {ID_MODULUS}) AS BIGINT) AS lon_check
            FROM node GROUP BY plain""",
        "block_scaling": """
            SELECT id, CASE WHEN has_info THEN "timestamp" END AS "timestamp", lat_e7, lon_e7
            FROM node""",
        "origin_file_counts": 'SELECT codec, count(*) AS "count" FROM codec GROUP BY codec',
        "sql_view_counts": "SELECT entity_type, count(*) AS n FROM entity GROUP BY entity_type",
        "schema_shapes": _shapes_sql(),
        "prune_id_only": f"SELECT {_CHECKS} FROM entity",
        "exclude_metadata": """
            SELECT entity_type, id, CAST(CASE WHEN tagged THEN 2 END AS BIGINT) AS n_tags,
                   CAST(NULL AS BIGINT) AS n_nodes, CAST(NULL AS BIGINT) AS n_members FROM node
            UNION ALL
            SELECT entity_type, id, CASE WHEN tagged THEN 2 END, n_nodes, NULL FROM way
            UNION ALL
            SELECT entity_type, id, 2, NULL, n_members FROM relation""",
        "exclude_tags": """
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END AS changeset,
                   CAST(NULL AS BIGINT) AS n_nodes, CAST(NULL AS BIGINT) AS n_members FROM node
            UNION ALL
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END, n_nodes, NULL FROM way
            UNION ALL
            SELECT entity_type, id, changeset, NULL, n_members FROM relation""",
        "tags_array": "SELECT entity_type, id, CAST(pos AS BIGINT) AS pos, key, value FROM tag",
        "tags_map_lookup": """
            SELECT entity_type, id, CASE WHEN tagged THEN highway END AS highway,
                   NULL AS name, NULL AS status FROM node
            UNION ALL
            SELECT entity_type, id, NULL, NULL, CASE WHEN tagged THEN status END FROM way
            UNION ALL
            SELECT entity_type, id, NULL, name, NULL FROM relation""",
        "node_coords": "SELECT id, lat_e7, lon_e7 FROM node",
        "way_nodes_indexed": 'SELECT id, "index", node_id FROM way_node',
        "way_nodes_ids": """
            SELECT id, n_nodes AS n_refs, CASE WHEN n_nodes > 0 THEN id * 8 + 5 END AS first_ref,
                   CASE WHEN closed THEN id * 8 + 5
                        WHEN n_nodes > 0 THEN id * 8 + (n_different * 5) % 8 END AS last_ref
            FROM way""",
        "relation_members": "SELECT id, pos, member_id, role, type FROM member",
        "metadata_columns": "SELECT * FROM metadata",
        "types_node": """
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END AS changeset, lat_e7
            FROM node""",
        "types_way": """
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END AS changeset, n_nodes
            FROM way""",
        "types_relation": "SELECT entity_type, id, changeset, n_members FROM relation",
        "types_node_way": """
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END AS changeset, lat_e7,
                   CAST(NULL AS BIGINT) AS n_nodes FROM node
            UNION ALL
            SELECT entity_type, id, CASE WHEN has_info THEN changeset END, NULL, n_nodes FROM way""",
        "filter_entity_type": "SELECT entity_type, id, n_nodes FROM way",
        "full_scan": _SELECTION_TOTALS,
        "way_lines": _LINES_SQL,
        "relation_closure": _CLOSURE_SQL,
        "relation_groups": _GROUPS_SQL,
        "way_components": _COMPONENTS_SQL,
        "relation_rings": _RINGS_SQL,
        "nodes_in_boxes": f"""
            , box AS (
                SELECT s_suppkey AS box, (s_suppkey * 7919) % 170 - 85.5 AS south, (s_suppkey * 104729) % 360 - 180.5 AS west,
                       0.25 + s_suppkey % 13 AS size FROM supplier
            )
            SELECT box, {_CHECKS} FROM box JOIN node ON lat_e7 BETWEEN south * 1e7 AND (south + size) * 1e7
                 AND (lon_e7 BETWEEN west * 1e7 AND (west + size) * 1e7 OR lon_e7 <= (west + size - 360) * 1e7 AND west + size > 180)
            GROUP BY box""",
        "latest_entities": _EXTRACTS_SQL + """
            SELECT entity_type, id, version, "timestamp", changeset, n_nodes, n_members
            FROM (SELECT * FROM before UNION SELECT * FROM after)
            QUALIFY row_number() OVER (PARTITION BY entity_type, id ORDER BY version DESC NULLS LAST, "timestamp" DESC, changeset DESC) = 1""",
        "extract_diff": _EXTRACTS_SQL + """
            SELECT coalesce(b.entity_type, a.entity_type) AS entity_type, coalesce(b.id, a.id) AS id,
                   CASE WHEN b.id IS NULL THEN 'created' WHEN a.id IS NULL THEN 'deleted' ELSE 'modified' END AS change,
                   b.version AS before_version, a.version AS after_version
            FROM (SELECT entity_type, id, max(version) AS version FROM before GROUP BY ALL) b
                 FULL JOIN (SELECT entity_type, id, max(version) AS version FROM after GROUP BY ALL) a ON a.entity_type = b.entity_type AND a.id = b.id
            WHERE a.id IS NULL OR b.id IS NULL OR a.version IS DISTINCT FROM b.version""",
        "tag_rollup": _USED_TAGS_SQL + """
            SELECT entity_type, key, count(*) AS n,
                   CASE WHEN count(DISTINCT value) <= 500 THEN count(DISTINCT value) END AS n_values,
                   CASE WHEN count(DISTINCT uid) <= 500 THEN count(DISTINCT uid) END AS n_users
            FROM used_tag GROUP BY GROUPING SETS ((entity_type, key), (key))""",
        "heavy_tags": """
            SELECT entity_type, key, value, count(*) AS n FROM tag GROUP BY entity_type, key, value
            QUALIFY count(*) >= 0.01 * sum(count(*)) OVER (PARTITION BY entity_type)""",
        "indexed_scan": "SELECT entity_type, id FROM entity",
        "skipped_scan": f"""
            SELECT entity_type, id, "timestamp", n_nodes FROM way
            WHERE id >= {_FIRST_WAY} AND has_info AND "timestamp" >= {_FIRST_TIME}""",
        "tag_filter": f"""
            SELECT entity_type, id, CASE WHEN has_info THEN user_sid END AS user_sid, CAST(2 AS BIGINT) AS n_tags, lat_e7, lon_e7
            FROM node WHERE tagged AND lat_e7 BETWEEN {_BOX[0]} AND {_BOX[2]} AND lon_e7 BETWEEN {_BOX[1]} AND {_BOX[3]}""",
        "zone_totals": """
            SELECT count(*) FILTER (entity_type = 'Node') AS n_nodes, count(*) FILTER (entity_type = 'Way') AS n_ways,
                   count(*) FILTER (entity_type = 'Relation') AS n_relations, min(id) AS min_id, max(id) AS max_id,
                   (SELECT min(lat_e7) FROM node) AS south, (SELECT max(lat_e7) FROM node) AS north,
                   (SELECT min(lon_e7) FROM node) AS west, (SELECT max(lon_e7) FROM node) AS east,
                   min("timestamp") FILTER (has_info) AS "first", max("timestamp") FILTER (has_info) AS "last"
            FROM entity""",
        "data_source_options": """
            SELECT entity_type, id, CASE WHEN codec_key % 4 = 0 THEN 'raw' ELSE 'zlib' END AS codec,
                   CASE WHEN tagged THEN linea END AS linea, NULL AS segment,
                   CAST(NULL AS BIGINT) AS n_members FROM node
            UNION ALL
            SELECT entity_type, id, CASE WHEN codec_key % 4 = 0 THEN 'raw' ELSE 'zlib' END,
                   NULL, segment, n_members FROM relation""",
    }
    own = {name: _ENTITIES + sql for name, sql in parts.items()}
    more = _training_data()
    return own | more.oracle_sql() if more else own
