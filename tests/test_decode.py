"""Blocks to rows, on hand-made files."""

import struct
import zlib

import pytest
from micro import (
    HEADER,
    block,
    data,
    deltas,
    dense,
    node,
    read_rows,
    relation,
    way,
    write,
)

from osm_fixtures.writer import blob, header_blob, put, put_list, uvarint, zz
from osm_tables.sources import decode

METADATA = ["version", "timestamp", "changeset", "uid", "user_sid"]


@pytest.fixture
def rows_of(tmp_path):
    def read(*groups, strings=("",), scaling=None, columns=None, **settings):
        path = write(tmp_path / "micro.pbf", HEADER, data(block(strings, *groups, **(scaling or {}))))
        return read_rows(path, columns, **settings)

    return read


def pick(rows, *names):
    return [tuple(r[n] for n in names) for r in rows]


def test_empty_files(tmp_path):
    assert read_rows(write(tmp_path / "empty.pbf")) == []
    assert read_rows(write(tmp_path / "header_only.pbf", HEADER)) == []
    assert read_rows(write(tmp_path / "no_rows.pbf", HEADER, data(block([""])))) == []
    assert read_rows(write(tmp_path / "no_rows.pbf", HEADER, data(block([""], b"", dense([]))))) == []


def test_literal_bytes(tmp_path):
    """Bytes worked out by hand, apart from any encoder."""
    one_way = bytes.fromhex(
        "1a0c"  # way, 12 bytes
        "0805"  # id 5
        "120101"  # keys: string 1
        "1a0102"  # values: string 2
        "42020601"  # refs +3, -1
    )
    two_dense_nodes = bytes.fromhex(
        "1213"  # dense nodes, 19 bytes
        "0a021402"  # ids +10, +1
        "4203c80101"  # latitudes +100, -1
        "4a020202"  # longitudes +1, +1
        "520401020000"  # first node: string 1 = string 2; second: none
    )
    strings = bytes.fromhex("0a08" "0a00" "0a016b" "0a0176")  # "", "k", "v"
    groups = b"\x12" + bytes([len(two_dense_nodes)]) + two_dense_nodes
    groups += b"\x12" + bytes([len(one_way)]) + one_way
    payload = strings + groups
    message = b"\x0a" + bytes([len(payload)]) + payload
    header = b"\x0a\x07OSMData\x18" + bytes([len(message)])
    path = write(tmp_path / "literal.pbf", struct.pack(">I", len(header)) + header + message)
    rows = read_rows(path, ["entity_type", "id", "tags", "latitude", "longitude", "nodes"])
    tag = {"key": "k", "value": "v"}
    assert rows == [
        {
            "entity_type": "Node",
            "id": 10,
            "tags": [tag],
            "latitude": 10000 * 1e-9,
            "longitude": 100 * 1e-9,
            "nodes": None,
        },
        {
            "entity_type": "Node",
            "id": 11,
            "tags": None,
            "latitude": 9900 * 1e-9,
            "longitude": 200 * 1e-9,
            "nodes": None,
        },
        {
            "entity_type": "Way",
            "id": 5,
            "tags": [tag],
            "latitude": None,
            "longitude": None,
            "nodes": [{"index": 0, "nodeId": 3}, {"index": 1, "nodeId": 2}],
        },
    ]


def test_dense_tags(rows_of):
    rows = rows_of(dense([1, 2, 3], tags=[0, 1, 2, 3, 4, 0, 0]), strings=["", "a", "b", "c", "d"])
    tags = [{"key": "a", "value": "b"}, {"key": "c", "value": "d"}]
    assert pick(rows, "id", "tags") == [(1, None), (2, tags), (3, None)]


def test_dense_tag_with_empty_value(rows_of):
    """String 0 in the place of a value is a value."""
    rows = rows_of(dense([1, 2, 3], tags=[1, 0, 0, 0, 1, 0, 1, 2, 0]), strings=["", "a", "b"])
    a, b = {"key": "a", "value": ""}, {"key": "a", "value": "b"}
    assert pick(rows, "id", "tags") == [(1, [a]), (2, None), (3, [a, b])]


@pytest.mark.parametrize("tags", [[0], [0, 0, 0], [1, 2, 0, 0, 1, 2], [0, 1]])
def test_dense_tags_that_do_not_fit(rows_of, tags):
    with pytest.raises(ValueError):
        rows_of(dense([1, 2], tags=tags), strings=["", "a", "b"])


def test_dense_without_tags(rows_of):
    assert pick(rows_of(dense([1, 2])), "tags") == [(None,), (None,)]


def test_no_info(rows_of):
    rows = rows_of(dense([1]), node(2), way(3, [1]), relation(4, [(1, 0, 0)]))
    assert pick(rows, *METADATA) == [(None,) * 5] * 4


def test_partial_info(rows_of):
    info = put(4, put(1, 3) + put(5, 1))
    dense_info = put_list(2, deltas([5, 7]))
    rows = rows_of(dense([1, 2], info=dense_info), node(3, rest=info), node(4), strings=["", "me"])
    by_id = {r["id"]: tuple(r[n] for n in METADATA) for r in rows}
    assert by_id == {
        1: (None, 5000, None, None, None),
        2: (None, 7000, None, None, None),
        3: (3, None, None, None, "me"),
        4: (None,) * 5,
    }


def test_full_info(rows_of):
    info = put(1, 2) + put(2, 1_600_000_000) + put(3, 2**40) + put(4, 77) + put(5, 1)
    dense_info = (
        put_list(1, [4, 2])
        + put_list(2, deltas([1_600_000_000, 1_500_000_000]))
        + put_list(3, deltas([2**40, 3]))
        + put_list(4, deltas([9, 8]))
        + put_list(5, deltas([2, 1]))
    )
    rows = rows_of(
        dense([1, 2], info=dense_info),
        way(3, [1], rest=put(4, info)),
        relation(4, rest=put(4, info)),
        strings=["", "ann", "bob"],
    )
    by_id = {r["id"]: tuple(r[n] for n in METADATA) for r in rows}
    from_info = (2, 1_600_000_000_000, 2**40, 77, "ann")
    assert by_id == {
        1: (4, 1_600_000_000_000, 2**40, 9, "bob"),
        2: (2, 1_500_000_000_000, 3, 8, "ann"),
        3: from_info,
        4: from_info,
    }


def test_negative_numbers_in_info(rows_of):
    info = put(4, put(1, -1) + put(2, -5) + put(3, -1) + put(4, -1))
    rows = rows_of(node(1, rest=info), columns=METADATA)
    assert pick(rows, *METADATA) == [(-1, -5000, -1, -1, None)]


def test_dense_messages_are_independent(rows_of):
    """Deltas start again, and one message may have parts that the other lacks."""
    first = dense([10, 20], [1, 2], [3, 4], tags=[1, 2, 0, 0], info=put_list(1, [5, 6]))
    second = dense([1, 2], [1, 1], [1, 1])
    expected = [(10, 5), (20, 6), (1, None), (2, None)]
    assert pick(rows_of(first, second, strings=["", "a", "b"]), "id", "version") == expected
    assert pick(rows_of(first + second, strings=["", "a", "b"]), "id", "version") == expected


def test_dense_messages_do_not_share_columns(rows_of):
    """Columns that are too short in one message and too long in the next do not add up."""
    good = dense([1, 2], tags=[1, 2, 0, 0])
    for first, second in (
        (dense([1, 2], [5]), dense([1], [5, 6])),
        (dense([1, 2], tags=[0]), dense([1], tags=[0, 0])),
        (dense([1, 2], tags=[0, 1]), dense([1], tags=[2, 0])),
        (dense([1, 2], info=put_list(1, [1])), dense([1], info=put_list(1, [1, 1]))),
        (dense([]), dense([], tags=[0])),
    ):
        with pytest.raises(ValueError, match="differ in length"):
            rows_of(good, first, second, good, strings=["", "a", "b"])


def test_repeated_tag_keys(rows_of):
    tags = put_list(2, [1, 1]) + put_list(3, [2, 3])
    rows = rows_of(way(1, [1], rest=tags), strings=["", "a", "x", "y"])
    assert rows[0]["tags"] == [{"key": "a", "value": "x"}, {"key": "a", "value": "y"}]
    with pytest.raises(ValueError, match="same tag key"):
        rows_of(way(1, [1], rest=tags), strings=["", "a", "x", "y"], tags_as_map=True)


def test_equal_keys_with_different_string_numbers(rows_of):
    tags = put_list(2, [1, 2]) + put_list(3, [3, 3])
    with pytest.raises(ValueError, match="same tag key"):
        rows_of(way(1, [1], rest=tags), strings=["", "a", "a", "x"], tags_as_map=True)


def test_map_tags(rows_of):
    tags = put_list(2, [1, 2]) + put_list(3, [2, 1])
    rows = rows_of(
        way(1, [1], rest=tags), way(2, [1]), dense([3, 4], tags=[0, 1, 1, 0]),
        strings=["", "a", "b"], tags_as_map=True,
    )
    by_id = {r["id"]: None if r["tags"] is None else dict(r["tags"]) for r in rows}
    assert by_id == {1: {"a": "b", "b": "a"}, 2: None, 3: None, 4: {"a": "a"}}


def test_ways(rows_of):
    rows = rows_of(way(1, [1, 2, 3, 1]), way(2), way(3, [9]))
    ids = [[n["nodeId"] for n in r["nodes"]] for r in rows]
    assert ids == [[1, 2, 3, 1], [], [9]]
    assert [[n["index"] for n in r["nodes"]] for r in rows] == [[0, 1, 2, 3], [], [0]]
    rows = rows_of(way(1, [1, 2, 3, 1]), way(2), way(3, [9]), way_nodes_as_id_list=True)
    assert [r["nodes"] for r in rows] == ids


def test_relations(rows_of):
    rows = rows_of(
        relation(1, [(5, 1, 0), (-7, 0, 1), (5, 2, 2)]), relation(2), strings=["", "outer", "inner"]
    )
    members = [
        {"member_id": 5, "role": "outer", "type": "Node"},
        {"member_id": -7, "role": "", "type": "Way"},
        {"member_id": 5, "role": "inner", "type": "Relation"},
    ]
    assert pick(rows, "id", "members") == [(1, members), (2, [])]


def test_columns_of_other_kinds_are_null(rows_of):
    rows = rows_of(dense([1]), node(2), way(3, [1]), relation(4))
    by_id = {r["id"]: (r["latitude"], r["nodes"], r["members"]) for r in rows}
    way_nodes = [{"index": 0, "nodeId": 1}]
    assert by_id == {1: (0, None, None), 2: (0, None, None), 3: (None, way_nodes, None), 4: (None, None, [])}


LARGE = [-(2**62), 2**62, -1, 0, 2**33, -(2**33), 2**63 - 1, -(2**63)]


def test_large_and_negative_ids(rows_of):
    def wrap(values):
        out = []
        for a, b in zip([0, *values], values):
            d = (b - a + 2**63) % 2**64 - 2**63
            out.append(zz(d))
        return out

    message = put_list(1, wrap(LARGE)) + put_list(8, [0] * 8) + put_list(9, [0] * 8)
    rows = rows_of(
        put(2, message),
        *[node(i) for i in LARGE],
        *[put(3, put(1, i) + put_list(8, wrap(LARGE))) for i in LARGE],
    )
    assert [r["id"] for r in rows] == LARGE * 3
    assert [n["nodeId"] for n in rows[-1]["nodes"]] == LARGE


def test_scaling(rows_of):
    scaling = {"granularity": 1000, "lat_offset": 5, "lon_offset": -7, "date_granularity": 1}
    info = put_list(2, deltas([1234]))
    rows = rows_of(
        dense([1], [123_456], [-654_321], info=info), node(2, 123_456, -654_321), scaling=scaling
    )
    lat, lon = (5 + 1000 * 123_456) * 1e-9, (-7 + 1000 * -654_321) * 1e-9
    # Plain nodes are decoded before dense ones.
    by_id = {r["id"]: (r["latitude"], r["longitude"], r["timestamp"]) for r in rows}
    assert by_id == {1: (lat, lon, 1234), 2: (lat, lon, None)}


def test_extreme_coordinates(rows_of):
    rows = rows_of(dense([1, 2], [900_000_000, -900_000_000], [-1_800_000_000, 1_800_000_000]))
    degrees = [(r["latitude"], r["longitude"]) for r in rows]
    assert degrees == [(pytest.approx(90), pytest.approx(-180)), (pytest.approx(-90), pytest.approx(180))]


def test_text(rows_of):
    strings = ["", "ключ", "価値", "🗺", "役割"]
    tags = put_list(2, [1]) + put_list(3, [2]) + put(4, put(5, 3))
    (row,) = rows_of(relation(1, [(1, 4, 0)], rest=tags), strings=strings)
    assert row["tags"] == [{"key": "ключ", "value": "価値"}]
    assert row["user_sid"] == "🗺"
    assert row["members"][0]["role"] == "役割"


def test_broken_text_is_replaced(rows_of):
    (row,) = rows_of(way(1, [1], rest=put_list(2, [1]) + put_list(3, [1])), strings=["", b"a\xff"])
    assert row["tags"] == [{"key": "a�", "value": "a�"}]


def test_long_strings(rows_of):
    texts = ["x" * n for n in (127, 128, 16_383, 16_384, 100_000)]
    tags = put_list(2, [1, 2, 3, 4, 5]) + put_list(3, [5, 4, 3, 2, 1])
    (row,) = rows_of(way(1, [1], rest=tags), strings=["", *texts])
    assert [t["key"] for t in row["tags"]] == texts


def test_string_number_out_of_range(rows_of):
    with pytest.raises(Exception, match="out of bounds"):
        rows_of(way(1, [1], rest=put_list(2, [9]) + put_list(3, [0])))


def test_unknown_member_type(rows_of):
    with pytest.raises(Exception, match="out of bounds"):
        rows_of(relation(1, [(1, 0, 3)]))


@pytest.mark.parametrize("chunked", [False, True])
def test_unpacked_numbers(rows_of, chunked):
    """Repeated numbers one by one, or in several packed pieces, mean the same as in one piece."""

    def spread(number, values):
        if chunked:
            half = len(values) // 2
            return put_list(number, values[:half]) + put(number, values[half]) + put_list(number, values[half + 1 :])
        return b"".join(put(number, v) for v in values)

    refs, ids = [5, 2, 9, 2], [1, 2, 300]
    one_way = put(3, put(1, 1) + spread(2, [1, 2]) + spread(3, [2, 1]) + spread(8, deltas(refs)))
    nodes = spread(1, deltas(ids)) + spread(8, deltas(ids)) + spread(9, deltas(ids))
    rows = rows_of(put(2, nodes), one_way, way(7, [4]), strings=["", "a", "b"])
    assert [r["id"] for r in rows] == [1, 2, 300, 1, 7]
    assert [n["nodeId"] for n in rows[3]["nodes"]] == refs
    assert rows[3]["tags"] == [{"key": "a", "value": "b"}, {"key": "b", "value": "a"}]
    assert [n["nodeId"] for n in rows[4]["nodes"]] == [4]


def test_last_value_of_a_single_field_wins(rows_of):
    rows = rows_of(put(3, put(1, 1) + put(1, 2) + put(4, put(1, 1)) + put(4, put(1, 9))))
    assert pick(rows, "id", "version") == [(2, 9)]


def test_unknown_fields_are_stepped_over(rows_of):
    extra = put(15, 1) + put(200, b"bytes") + uvarint(201 * 8 + 1) + b"8 bytes!" + uvarint(202 * 8 + 5) + b"4by."
    strange_group = extra + put(5, b"a changeset") + way(1, [1, 2], rest=extra)
    rows = rows_of(strange_group, extra, node(2, 1, 1, rest=extra))
    assert sorted(r["id"] for r in rows) == [1, 2]


def test_groups_with_unusual_fields(rows_of):
    high = uvarint(14 * 8 + 1) + b"\xff" * 8 + put(20_000, 1)
    fields = [way(1, [1]), high, put(14, 2**63), put(14, b""), way(2, [1]), put(14, b"x" * 20_000), way(3)]
    for rotation in range(len(fields)):
        group = b"".join(fields[rotation:] + fields[:rotation])
        assert sorted(r["id"] for r in rows_of(group)) == [1, 2, 3]
    assert [r["id"] for r in rows_of(b"".join(way(i, range(3000)) for i in range(4)))] == [0, 1, 2, 3]


def test_fields_with_another_wire_type_are_unknown(rows_of):
    rows = rows_of(way(1, [5], rest=put(1, b"id?") + put(4, 7) + uvarint(8 * 8 + 5) + b"\x01\x02\x03\x04"))
    assert pick(rows, "id", "version") == [(1, None)]
    assert [n["nodeId"] for n in rows[0]["nodes"]] == [5]


def test_wrong_size_hint(tmp_path):
    for hint in (0, 1, 2**31 - 1, -5):
        message = put(2, hint) + put(3, zlib.compress(block([""], dense([1, 2]))))
        header = put(1, "OSMData") + put(3, len(message))
        path = write(tmp_path / "z.pbf", struct.pack(">I", len(header)) + header + message)
        assert [r["id"] for r in read_rows(path)] == [1, 2]


def test_fields_in_any_order(tmp_path):
    """Scaling and strings may follow the groups that use them."""
    message = put(8, zz(7)) + put(9, zz(8)) + put(3, b"\x01") + put(2, b"\x01") + put(1, zz(1))
    late = put(17, 1) + put(2, put(1, message)) + put(19, 3) + put(1, put(1, "") + put(1, "s"))
    (row,) = read_rows(write(tmp_path / "late.pbf", data(late)))
    assert (row["latitude"], row["longitude"]) == ((3 + 7) * 1e-9, 8 * 1e-9)
    assert row["tags"] == [{"key": "s", "value": "s"}]


GROUPS = (dense([1, 2]), node(3), way(4, [1]), relation(5))


@pytest.mark.parametrize(
    ("types", "ids"),
    [
        ({"node"}, {1, 2, 3}),
        ({"way"}, {4}),
        ({"relation"}, {5}),
        ({"way", "Relation"}, {4, 5}),
        (None, {1, 2, 3, 4, 5}),
    ],
)
def test_types(rows_of, types, ids):
    assert {r["id"] for r in rows_of(*GROUPS, types=types)} == ids
    assert {r["id"] for r in rows_of(b"".join(GROUPS), types=types)} == ids


def test_unwanted_kinds_are_not_decoded(rows_of):
    broken = put(3, b"\xff\xff")
    with pytest.raises(ValueError):
        rows_of(dense([1]), broken)
    assert len(rows_of(dense([1]), broken, types={"node"})) == 1


@pytest.mark.parametrize("columns", [["entity_type"], ["id"], ["tags"], ["nodes"], ["members", "uid"]])
def test_chosen_columns_agree_with_all(rows_of, columns):
    everything = rows_of(*GROUPS)
    chosen = rows_of(*GROUPS, columns=columns)
    assert [tuple(r.values()) for r in chosen] == pick(everything, *columns)


@pytest.mark.parametrize(
    "group",
    [
        put(3, put(2, b"")),  # no id
        put(1, put(1, 2)),  # no coordinates
        put(3, put(1, 1) + put_list(2, [1])),  # keys without values
        put(4, put(1, 1) + put_list(9, [2])),  # members without roles
        put(2, put_list(1, [2, 2]) + put_list(8, [2]) + put_list(9, [2])),
        put(3, put(1, 1) + put(8, b"\x80")),  # list ends inside a number
        put(3, put(1, 1) + b"\x42\x05\x01"),  # field longer than its message
        put(3, put(1, 1) + b"\x43"),  # start of a group, which proto3 lacks
        b"\x1a\x7f\x08\x01",  # entity longer than its group
        b"\x1a",
        put(3, b"\x08" + b"\x80" * 10 + b"\x01"),  # number longer than 10 bytes
    ],
)
def test_broken_entities(rows_of, group):
    with pytest.raises(ValueError):
        rows_of(group, strings=["", "a"])


def test_raw_and_zlib_agree(tmp_path):
    body = block(["", "a"], *GROUPS)
    raw = write(tmp_path / "raw.pbf", HEADER, data(body, "raw"))
    compressed = write(tmp_path / "zlib.pbf", HEADER, data(body, "zlib"))
    assert read_rows(raw) == read_rows(compressed)


def test_zlib_without_its_size(tmp_path):
    message = put(3, zlib.compress(block([""], dense(list(range(5000))))))
    header = put(1, "OSMData") + put(3, len(message))
    path = write(tmp_path / "z.pbf", struct.pack(">I", len(header)) + header + message)
    assert [r["id"] for r in read_rows(path)] == list(range(5000))


@pytest.mark.parametrize(
    ("number", "codec"), [(4, "lzma"), (5, "bzip2"), (6, "lz4"), (7, "zstd"), (9, "field 9")]
)
def test_other_codecs_are_refused_by_name(tmp_path, number, codec):
    message = put(2, 100) + put(number, b"????")
    header = put(1, "OSMData") + put(3, len(message))
    path = write(tmp_path / "codec.pbf", HEADER, struct.pack(">I", len(header)) + header + message)
    with pytest.raises(ValueError, match=rf"codec\.pbf: blob at offset {len(HEADER)}: .*{codec}"):
        read_rows(path)


def test_corrupt_zlib(tmp_path):
    message = put(3, b"not zlib")
    header = put(1, "OSMData") + put(3, len(message))
    with pytest.raises(ValueError, match="offset 0"):
        read_rows(write(tmp_path / "bad.pbf", struct.pack(">I", len(header)) + header + message))


def test_header_features(tmp_path):
    body = data(block([""], dense([1])))
    assert len(read_rows(write(tmp_path / "h.pbf", header_blob("HistoricalInformation"), body))) == 1
    with pytest.raises(ValueError, match="Newer"):
        read_rows(write(tmp_path / "h.pbf", header_blob("OsmSchema-V0.6", "Newer"), body))


def test_unknown_blob_is_skipped(tmp_path):
    body = data(block([""], dense([1])))
    path = write(tmp_path / "unknown_blob.pbf", HEADER, body, blob("Foo", b"\xff\xff", "raw"), body)
    assert [r["id"] for r in read_rows(path)] == [1, 1]


def test_batches_with_much_text_are_cut(tmp_path, monkeypatch):
    """Few long strings used by many entities would overflow one Arrow column."""
    tags = put_list(2, [1]) + put_list(3, [2])
    groups = [way(i, [i, i + 1], rest=tags if i % 3 else b"") for i in range(50)]
    path = write(tmp_path / "text.pbf", data(block(["", "k", "v" * 100], *groups, dense([1, 2]))))
    whole = read_rows(path)
    monkeypatch.setattr(decode, "MAX_BATCH_ROWS", 7)
    assert read_rows(path) == whole
    monkeypatch.setattr(decode, "MAX_BATCH_TEXT", 250)
    assert read_rows(path) == whole
    assert read_rows(path, tags_as_map=True) == [
        {**r, "tags": r["tags"] and [(t["key"], t["value"]) for t in r["tags"]]} for r in whole
    ]
