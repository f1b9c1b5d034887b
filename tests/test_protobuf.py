"""Random entities through the public protobuf library, as a second encoder of the same format."""

import struct
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from micro import multiset, read_rows, write

descriptor_pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
from google.protobuf import descriptor_pool, message_factory  # noqa: E402

# The public message definitions. name: (number, type, label), packed where repeated.
MESSAGES = {
    "Blob": {"raw": (1, "bytes"), "raw_size": (2, "int32"), "zlib_data": (3, "bytes")},
    "BlobHeader": {"type": (1, "string"), "indexdata": (2, "bytes"), "datasize": (3, "int32")},
    "StringTable": {"s": (1, "bytes*")},
    "Info": {
        "version": (1, "int32"),
        "timestamp": (2, "int64"),
        "changeset": (3, "int64"),
        "uid": (4, "int32"),
        "user_sid": (5, "uint32"),
        "visible": (6, "bool"),
    },
    "DenseInfo": {
        "version": (1, "int32*"),
        "timestamp": (2, "sint64*"),
        "changeset": (3, "sint64*"),
        "uid": (4, "sint32*"),
        "user_sid": (5, "sint32*"),
        "visible": (6, "bool*"),
    },
    "Node": {
        "id": (1, "sint64"),
        "keys": (2, "uint32*"),
        "vals": (3, "uint32*"),
        "info": (4, "Info"),
        "lat": (8, "sint64"),
        "lon": (9, "sint64"),
    },
    "DenseNodes": {
        "id": (1, "sint64*"),
        "denseinfo": (5, "DenseInfo"),
        "lat": (8, "sint64*"),
        "lon": (9, "sint64*"),
        "keys_vals": (10, "int32*"),
    },
    "Way": {
        "id": (1, "int64"),
        "keys": (2, "uint32*"),
        "vals": (3, "uint32*"),
        "info": (4, "Info"),
        "refs": (8, "sint64*"),
    },
    "Relation": {
        "id": (1, "int64"),
        "keys": (2, "uint32*"),
        "vals": (3, "uint32*"),
        "info": (4, "Info"),
        "roles_sid": (8, "int32*"),
        "memids": (9, "sint64*"),
        "types": (10, "int32*"),
    },
    "PrimitiveGroup": {
        "nodes": (1, "Node*"),
        "dense": (2, "DenseNodes"),
        "ways": (3, "Way*"),
        "relations": (4, "Relation*"),
    },
    "PrimitiveBlock": {
        "stringtable": (1, "StringTable"),
        "primitivegroup": (2, "PrimitiveGroup*"),
        "granularity": (17, "int32"),
        "date_granularity": (18, "int32"),
        "lat_offset": (19, "int64"),
        "lon_offset": (20, "int64"),
    },
}


def message_classes(packed: bool):
    Field = descriptor_pb2.FieldDescriptorProto
    package = "packed" if packed else "unpacked"
    file = descriptor_pb2.FileDescriptorProto(name=f"{package}.proto", package=package, syntax="proto2")
    for name, fields in MESSAGES.items():
        message = file.message_type.add(name=name)
        for field_name, (number, kind) in fields.items():
            repeated, kind = kind.endswith("*"), kind.rstrip("*")
            field = message.field.add(name=field_name, number=number)
            field.label = Field.LABEL_REPEATED if repeated else Field.LABEL_OPTIONAL
            if kind in MESSAGES:
                field.type, field.type_name = Field.TYPE_MESSAGE, f".{package}.{kind}"
            else:
                field.type = Field.Type.Value(f"TYPE_{kind.upper()}")
                if repeated and kind != "bytes":
                    field.options.packed = packed
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return {
        name: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{package}.{name}"))
        for name in MESSAGES
    }


CLASSES = {packed: message_classes(packed) for packed in (True, False)}

INT32, INT64 = st.integers(-(2**31), 2**31 - 1), st.integers(-(2**63), 2**63 - 1)
IDS = st.integers(-(2**61), 2**61)
TEXT = st.text(max_size=5)
TAGS = st.lists(st.tuples(TEXT.filter(bool), TEXT), max_size=3)
INFO = st.fixed_dictionaries(
    {
        "version": INT32,
        "timestamp": st.integers(-(2**50), 2**50),
        "changeset": IDS,
        "uid": st.integers(-(2**30), 2**30 - 1),
        "user": TEXT,
    }
)
LOCATION = st.tuples(*[st.integers(-1_800_000_000, 1_800_000_000)] * 2)
NODES = st.lists(st.tuples(IDS, LOCATION, TAGS, st.none() | INFO), max_size=6)
DENSE = st.lists(st.tuples(IDS, LOCATION, TAGS, INFO), max_size=6)
WAYS = st.lists(st.tuples(INT64, st.lists(IDS, max_size=6), TAGS, st.none() | INFO), max_size=4)
MEMBER = st.tuples(IDS, TEXT, st.integers(0, 2))
RELATIONS = st.lists(st.tuples(INT64, st.lists(MEMBER, max_size=4), TAGS, st.none() | INFO), max_size=4)
BLOCK = st.fixed_dictionaries(
    {
        "nodes": NODES,
        "dense": st.lists(st.tuples(DENSE, st.booleans()), max_size=3),
        "ways": WAYS,
        "relations": RELATIONS,
        "scaling": st.none()
        | st.tuples(st.integers(1, 1000), st.integers(1, 1000), st.integers(-(10**9), 10**9)),
        "compressed": st.booleans(),
        "packed": st.booleans(),
    }
)


def differences(values):
    return [b - a for a, b in zip([0, *values], values)]


class Encoder:
    def __init__(self, content):
        self.content = content
        self.types = CLASSES[content["packed"]]
        self.strings = [""]

    def string(self, text):
        if text not in self.strings:
            self.strings.append(text)
        return self.strings.index(text)

    def info(self, target, info):
        if info is not None:
            for name in ("version", "timestamp", "changeset", "uid"):
                setattr(target.info, name, info[name])
            target.info.user_sid = self.string(info["user"])

    def tags(self, target, tags):
        target.keys.extend(self.string(k) for k, _ in tags)
        target.vals.extend(self.string(v) for _, v in tags)

    def encode(self) -> bytes:
        content = self.content
        block = self.types["PrimitiveBlock"]()
        if content["scaling"]:
            block.granularity, block.date_granularity, block.lat_offset = content["scaling"]
            block.lon_offset = -block.lat_offset
        group = block.primitivegroup.add()
        for id, (lat, lon), tags, info in content["nodes"]:
            node = group.nodes.add(id=id, lat=lat, lon=lon)
            self.tags(node, tags)
            self.info(node, info)
        for rows, with_info in content["dense"]:
            self.dense(block.primitivegroup.add().dense, rows, with_info)
        group = block.primitivegroup.add()
        for id, refs, tags, info in content["ways"]:
            way = group.ways.add(id=id, refs=differences(refs))
            self.tags(way, tags)
            self.info(way, info)
        for id, members, tags, info in content["relations"]:
            relation = group.relations.add(id=id)
            relation.memids.extend(differences([m[0] for m in members]))
            relation.roles_sid.extend(self.string(m[1]) for m in members)
            relation.types.extend(m[2] for m in members)
            self.tags(relation, tags)
            self.info(relation, info)
        block.stringtable.s.extend(s.encode() for s in self.strings)
        body = block.SerializeToString()
        blob = self.types["Blob"]()
        if content["compressed"]:
            blob.raw_size, blob.zlib_data = len(body), zlib.compress(body)
        else:
            blob.raw = body
        payload = blob.SerializeToString()
        header = self.types["BlobHeader"](type="OSMData", datasize=len(payload)).SerializeToString()
        return struct.pack(">I", len(header)) + header + payload

    def dense(self, dense, rows, with_info):
        dense.id.extend(differences([r[0] for r in rows]))
        dense.lat.extend(differences([r[1][0] for r in rows]))
        dense.lon.extend(differences([r[1][1] for r in rows]))
        if any(r[2] for r in rows):
            for _, _, tags, _ in rows:
                for k, v in tags:
                    dense.keys_vals.extend((self.string(k), self.string(v)))
                dense.keys_vals.append(0)
        if with_info:
            info = dense.denseinfo
            info.version.extend(r[3]["version"] for r in rows)
            for name in ("timestamp", "changeset", "uid"):
                getattr(info, name).extend(differences([r[3][name] for r in rows]))
            info.user_sid.extend(differences([self.string(r[3]["user"]) for r in rows]))


def expected_rows(content):
    granularity, date_granularity, offset = content["scaling"] or (100, 1000, 0)

    def row(kind, id, tags, info, **rest):
        info = info or {}
        timestamp = info.get("timestamp")
        return {
            "entity_type": kind,
            "id": id,
            "version": info.get("version"),
            "timestamp": None if timestamp is None else timestamp * date_granularity,
            "changeset": info.get("changeset"),
            "uid": info.get("uid"),
            "user_sid": info.get("user"),
            "tags": [{"key": k, "value": v} for k, v in tags] or None,
            "latitude": None,
            "longitude": None,
            "nodes": None,
            "members": None,
            **rest,
        }

    def place(location):
        lat, lon = location
        return {
            "latitude": (offset + granularity * lat) * 0.000000001,
            "longitude": (-offset + granularity * lon) * 0.000000001,
        }

    for id, location, tags, info in content["nodes"]:
        yield row("Node", id, tags, info, **place(location))
    for rows, with_info in content["dense"]:
        for id, location, tags, info in rows:
            yield row("Node", id, tags, info if with_info else None, **place(location))
    for id, refs, tags, info in content["ways"]:
        nodes = [{"index": i, "nodeId": r} for i, r in enumerate(refs)]
        yield row("Way", id, tags, info, nodes=nodes)
    kinds = ["Node", "Way", "Relation"]
    for id, members, tags, info in content["relations"]:
        members = [{"member_id": m, "role": r, "type": kinds[t]} for m, r, t in members]
        yield row("Relation", id, tags, info, members=members)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BLOCK, max_size=4), st.integers(1, 9))
def test_random_entities(tmp_path, contents, partitions):
    path = write(tmp_path / "random.pbf", *[Encoder(c).encode() for c in contents])
    expected = multiset(r for c in contents for r in expected_rows(c))
    assert multiset(read_rows(path)) == expected
    assert multiset(read_rows(path, partitions=partitions)) == expected
