import pytest
from pyspark.sql import types as T

from osm_tables import OsmReadOptions, osm_schema
from osm_tables.schema import METADATA, to_arrow_schema

COMMON = ["entity_type", "id"]


@pytest.mark.parametrize(
    ("options", "names"),
    [
        ({}, [*COMMON, *METADATA, "tags", "latitude", "longitude", "nodes", "members"]),
        (
            {"types": {"node"}, "tags_as_map": True, "exclude_metadata": True},
            [*COMMON, "tags", "latitude", "longitude"],
        ),
        ({"types": {"way"}, "way_nodes_as_id_list": True}, [*COMMON, *METADATA, "tags", "nodes"]),
        ({"types": {"relation"}, "exclude_tags": True}, [*COMMON, *METADATA, "members"]),
        (
            {"exclude_metadata": True, "include_origin_file": True},
            [*COMMON, "tags", "latitude", "longitude", "nodes", "members", "origin-file"],
        ),
        ({"exclude_tags": True, "tags_as_map": True, "types": {"way"}}, [*COMMON, *METADATA, "nodes"]),
    ],
)
def test_columns(options, names):
    assert osm_schema(OsmReadOptions(**options)).names == names


def test_types_and_nullability():
    schema = osm_schema(OsmReadOptions())
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "entity_type": "string",
        "id": "bigint",
        "version": "int",
        "timestamp": "bigint",
        "changeset": "bigint",
        "uid": "int",
        "user_sid": "string",
        "tags": "array<struct<key:string,value:string>>",
        "latitude": "double",
        "longitude": "double",
        "nodes": "array<struct<index:int,nodeId:bigint>>",
        "members": "array<struct<member_id:bigint,role:string,type:string>>",
    }
    assert [f.name for f in schema.fields if not f.nullable] == COMMON
    for name, required in (("tags", ["key"]), ("nodes", ["index", "nodeId"]), ("members", ["member_id"])):
        kind = schema[name].dataType
        assert not kind.containsNull
        assert [f.name for f in kind.elementType.fields if not f.nullable] == required


def test_other_shapes():
    schema = osm_schema(OsmReadOptions(tags_as_map=True, way_nodes_as_id_list=True))
    assert schema["tags"].dataType == T.MapType(T.StringType(), T.StringType(), True)
    assert schema["nodes"].dataType == T.ArrayType(T.LongType(), True)


def test_chosen_columns():
    schema = osm_schema(OsmReadOptions(), ["nodes", "id"])
    assert schema.names == ["nodes", "id"]
    with pytest.raises(ValueError, match="latitude"):
        osm_schema(OsmReadOptions(types={"way"}), ["id", "latitude"])


def test_arrow_schema_agrees():
    schema = osm_schema(OsmReadOptions(include_origin_file=True))
    arrow = to_arrow_schema(schema)
    assert arrow.names == schema.names
    assert [f.nullable for f in arrow] == [f.nullable for f in schema.fields]
