"""Column names and the table schema. The schema depends on the options only, never on data."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import types as T

from .options import NODE, RELATION, WAY, OsmReadOptions

# Column names and nested field names.
ENTITY_TYPE = "entity_type"
ID = "id"
VERSION = "version"
TIMESTAMP = "timestamp"
CHANGESET = "changeset"
UID = "uid"
USER_SID = "user_sid"
TAGS = "tags"
TAG_KEY = "key"
TAG_VALUE = "value"
LATITUDE = "latitude"
LONGITUDE = "longitude"
NODES = "nodes"
NODE_INDEX = "index"
NODE_ID = "nodeId"
MEMBERS = "members"
MEMBER_ID = "member_id"
MEMBER_ROLE = "role"
MEMBER_TYPE = "type"
ORIGIN_FILE = "origin-file"

METADATA = (VERSION, TIMESTAMP, CHANGESET, UID, USER_SID)

_TAG_LIST = T.ArrayType(
    T.StructType(
        [T.StructField(TAG_KEY, T.StringType(), False), T.StructField(TAG_VALUE, T.StringType())]
    ),
    containsNull=False,
)
_TAG_MAP = T.MapType(T.StringType(), T.StringType(), valueContainsNull=True)
_NODE_LIST = T.ArrayType(
    T.StructType(
        [T.StructField(NODE_INDEX, T.IntegerType(), False), T.StructField(NODE_ID, T.LongType(), False)]
    ),
    containsNull=False,
)
_NODE_ID_LIST = T.ArrayType(T.LongType(), containsNull=True)
_MEMBER_LIST = T.ArrayType(
    T.StructType(
        [
            T.StructField(MEMBER_ID, T.LongType(), False),
            T.StructField(MEMBER_ROLE, T.StringType()),
            T.StructField(MEMBER_TYPE, T.StringType()),
        ]
    ),
    containsNull=False,
)


def osm_schema(options: OsmReadOptions, columns: Sequence[str] | None = None) -> T.StructType:
    """The schema the options ask for, or the part of it named by ``columns``, in that order."""
    fields = [
        T.StructField(ENTITY_TYPE, T.StringType(), False),
        T.StructField(ID, T.LongType(), False),
    ]
    if not options.exclude_metadata:
        fields += [
            T.StructField(VERSION, T.IntegerType()),
            T.StructField(TIMESTAMP, T.LongType()),
            T.StructField(CHANGESET, T.LongType()),
            T.StructField(UID, T.IntegerType()),
            T.StructField(USER_SID, T.StringType()),
        ]
    if not options.exclude_tags:
        fields.append(T.StructField(TAGS, _TAG_MAP if options.tags_as_map else _TAG_LIST))
    if options.contains_type(NODE):
        fields += [T.StructField(LATITUDE, T.DoubleType()), T.StructField(LONGITUDE, T.DoubleType())]
    if options.contains_type(WAY):
        fields.append(
            T.StructField(NODES, _NODE_ID_LIST if options.way_nodes_as_id_list else _NODE_LIST)
        )
    if options.contains_type(RELATION):
        fields.append(T.StructField(MEMBERS, _MEMBER_LIST))
    if options.include_origin_file:
        fields.append(T.StructField(ORIGIN_FILE, T.StringType()))
    if columns is None:
        return T.StructType(fields)

    by_name = {f.name: f for f in fields}
    unknown = [c for c in columns if c not in by_name]
    if unknown:
        raise ValueError(f"Unknown columns {unknown}; with these options there are {list(by_name)}")
    return T.StructType([by_name[c] for c in columns])


def to_arrow_type(data_type: T.DataType) -> pa.DataType:
    """The Arrow type that Spark reads as ``data_type``, nullability included."""
    if isinstance(data_type, T.ArrayType):
        element = to_arrow_type(data_type.elementType)
        return pa.list_(pa.field("element", element, nullable=data_type.containsNull))
    if isinstance(data_type, T.MapType):
        return pa.map_(to_arrow_type(data_type.keyType), to_arrow_type(data_type.valueType))
    if isinstance(data_type, T.StructType):
        return pa.struct([_arrow_field(f) for f in data_type.fields])
    return {
        T.StringType(): pa.string(),
        T.IntegerType(): pa.int32(),
        T.LongType(): pa.int64(),
        T.DoubleType(): pa.float64(),
    }[data_type]


def to_arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([_arrow_field(f) for f in schema.fields])


def _arrow_field(field: T.StructField) -> pa.Field:
    return pa.field(field.name, to_arrow_type(field.dataType), nullable=field.nullable)
