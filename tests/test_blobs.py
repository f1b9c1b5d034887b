"""Finding blobs from the middle of a file."""

import struct

import pytest
from micro import HEADER, block, data, dense, multiset, read_rows, size, way, write

from osm_fixtures.writer import blob, put
from osm_tables.sources import blobs
from osm_tables.sources.blobs import blobs_from, blobs_of_range
from osm_tables.sources.files import ReadAhead

CHUNKS = [1, 64, 4096, 2**22]


def offsets(path, chunk=4096):
    with ReadAhead(path, size(path), chunk) as source:
        return [b.offset for b in blobs_from(source, 0)]


def offsets_by_ranges(path, cuts, chunk=4096):
    found = []
    bounds = [0, *cuts, size(path)]
    for start, stop in zip(bounds, bounds[1:]):
        with ReadAhead(path, size(path), chunk) as source:
            found += [b.offset for b in blobs_of_range(source, start, stop)]
    return found


def some_blocks(n, codec="zlib"):
    return [
        data(block(["", f"name {i}"], dense([i * 10 + k for k in range(i % 5 + 1)])), codec)
        for i in range(n)
    ]


@pytest.fixture(params=[blobs._REACH, 700])
def reach(request, monkeypatch):
    """How far back a range looks first; files here are small, so a short reach stands for large files."""
    monkeypatch.setattr(blobs, "_REACH", request.param)


@pytest.fixture(params=["raw", "zlib"])
def plain_file(tmp_path, request):
    return write(tmp_path / "plain.pbf", HEADER, *some_blocks(12, request.param))


def test_every_pair_of_cuts(plain_file, reach):
    expected, end = offsets(plain_file), size(plain_file)
    for first in range(1, end, 7):
        for second in range(first + 1, end, 31):
            assert offsets_by_ranges(plain_file, [first, second]) == expected


@pytest.mark.parametrize("chunk", CHUNKS)
def test_read_ahead_does_not_matter(plain_file, chunk, reach):
    expected = offsets(plain_file)
    assert offsets(plain_file, chunk) == expected
    cuts = list(range(50, size(plain_file), 50))
    assert offsets_by_ranges(plain_file, cuts, chunk) == expected


def test_one_byte_ranges(plain_file, reach):
    cuts = list(range(1, size(plain_file)))
    assert offsets_by_ranges(plain_file, cuts) == offsets(plain_file)


def test_other_blob_types_and_header_layouts(tmp_path):
    """Blobs that no range can start at are still read, by the range before."""
    odd_case = blob("osmdata", block([""], dense([1])), "raw")
    payload = put(1, block([""], dense([2])))
    late_type = put(3, len(payload)) + put(1, "OSMData")
    indexed = put(1, "OSMData") + put(2, b"index") + put(3, len(payload))
    odd_headers = b"".join(
        struct.pack(">I", len(h)) + h + payload for h in (late_type, indexed, late_type)
    )
    path = write(
        tmp_path / "odd.pbf",
        HEADER,
        *some_blocks(2),
        blob("Foo", b"anything", "raw"),
        odd_case,
        odd_headers,
        *some_blocks(2),
        odd_headers,
    )
    expected = offsets(path)
    assert len(expected) == 1 + 2 + 1 + 1 + 3 + 2 + 3
    for cut in range(1, size(path)):
        assert offsets_by_ranges(path, [cut]) == expected
    assert offsets_by_ranges(path, range(1, size(path), 13)) == expected
    rows = read_rows(path)
    assert sum(r["id"] == 2 for r in rows) == 6
    for partitions in (2, 3, 9):
        assert multiset(read_rows(path, partitions=partitions)) == multiset(rows)


def test_blob_type_inside_a_string(tmp_path, reach):
    """The text of a raw block may look like a header, but no chain of blobs follows from it."""
    look_alike = struct.pack(">I", 13) + put(1, "OSMData") + put(3, 20)
    texts = ["", "OSMData", b"\x00\x00\x00\x0d\x0a\x07OSMData\x18\x14", look_alike]
    blocks = [data(block(texts, dense([i]))) for i in range(6)]
    path = write(tmp_path / "osmdata_string.pbf", HEADER, *blocks)
    expected = offsets(path)
    for cut in range(1, size(path)):
        assert offsets_by_ranges(path, [cut]) == expected


@pytest.fixture
def file_in_a_file(tmp_path):
    """A raw block whose last string is a run of whole blobs, so that a false chain rejoins the file."""
    inner = b"".join(some_blocks(3, "raw"))
    groups = put(2, dense([7])) + put(2, way(1, [7, 7]))
    payload = groups + put(1, put(1, "") + put(1, inner))
    return write(tmp_path / "nested.pbf", HEADER, *some_blocks(2), data(payload), *some_blocks(2))


def test_false_chains_do_not_mislead(file_in_a_file, monkeypatch):
    """Wherever a file is cut; the reach is that of its largest blob."""
    expected = offsets(file_in_a_file)
    assert len(expected) == 6
    largest = max(b - a for a, b in zip(expected, [*expected[1:], size(file_in_a_file)]))
    for reach in (blobs._REACH, largest + 1):
        monkeypatch.setattr(blobs, "_REACH", reach)
        for cut in range(1, size(file_in_a_file)):
            assert offsets_by_ranges(file_in_a_file, [cut]) == expected
        for step in (2, 17, 50, 333):
            assert offsets_by_ranges(file_in_a_file, range(1, size(file_in_a_file), step)) == expected
    assert len(read_rows(file_in_a_file)) == 1 + 2 + 3 + 2


def test_only_the_stretch_before_a_range_is_read(tmp_path, monkeypatch):
    path = write(tmp_path / "long.pbf", HEADER, *some_blocks(300))
    expected = offsets(path)
    monkeypatch.setattr(blobs, "_REACH", 2000)
    fetched = []
    real = ReadAhead._fetch
    monkeypatch.setattr(ReadAhead, "_fetch", lambda self, at, n: fetched.append((at, n)) or real(self, at, n))
    start = expected[250] + 1
    with ReadAhead(path, size(path), 64) as source:
        assert blobs.first_blob_at(source, start) == expected[251]
    assert min(at for at, _ in fetched) >= start - 2000


def truncated(tmp_path, keep):
    whole = b"".join([HEADER, *some_blocks(4)])
    return write(tmp_path / "cut.pbf", whole[:keep])


def test_truncated_anywhere(tmp_path):
    whole = b"".join([HEADER, *some_blocks(4)])
    ends = set(offsets(write(tmp_path / "whole.pbf", whole))) | {len(whole)}
    for keep in range(1, len(whole)):
        path = truncated(tmp_path, keep)
        for partitions in (1, 3):
            if keep in ends:
                read_rows(path, partitions=partitions)
            else:
                with pytest.raises((EOFError, ValueError)):
                    read_rows(path, partitions=partitions)
                with pytest.raises((EOFError, ValueError)):
                    offsets_by_ranges(path, [keep // 3, keep // 2])
