"""Small hand-made files, and reading a file without Spark."""

from __future__ import annotations

import os
from collections import Counter

from osm_fixtures.writer import blob, header_blob, put, put_list, zz
from osm_tables.options import OsmReadOptions
from osm_tables.schema import osm_schema
from osm_tables.sources.reader import entity_decoder, file_set, scan_range


def block(strings, *groups, **scaling) -> bytes:
    numbers = {"granularity": 17, "date_granularity": 18, "lat_offset": 19, "lon_offset": 20}
    table = put(1, b"".join(put(1, s) for s in strings))
    return table + b"".join(put(2, g) for g in groups) + b"".join(
        put(numbers[name], value) for name, value in scaling.items()
    )


def deltas(values):
    return [zz(b - a) for a, b in zip([0, *values], values)]


def dense(ids, lats=None, lons=None, tags=None, info=b""):
    lats, lons = lats or [0] * len(ids), lons or [0] * len(ids)
    message = put_list(1, deltas(ids)) + (put(5, info) if info else b"")
    message += put_list(8, deltas(lats)) + put_list(9, deltas(lons))
    return put(2, message + (b"" if tags is None else put_list(10, tags)))


def node(id, lat=0, lon=0, rest=b""):
    return put(1, put(1, zz(id)) + rest + put(8, zz(lat)) + put(9, zz(lon)))


def way(id, refs=(), rest=b""):
    return put(3, put(1, id) + rest + (put_list(8, deltas(list(refs))) if refs else b""))


def relation(id, members=(), rest=b""):
    """Members are (id, role string number, type number)."""
    message = put(1, id) + rest
    if members:
        message += put_list(8, [m[1] for m in members])
        message += put_list(9, deltas([m[0] for m in members]))
        message += put_list(10, [m[2] for m in members])
    return put(4, message)


def data(block_bytes: bytes, codec: str = "raw") -> bytes:
    return blob("OSMData", block_bytes, codec)


def write(path, *blobs: bytes) -> str:
    with open(path, "wb") as f:
        f.write(b"".join(blobs) if blobs else b"")
    return str(path)


HEADER = header_blob("OsmSchema-V0.6", "DenseNodes")


def read_rows(path: str, columns=None, partitions: int = 1, **settings) -> list[dict]:
    """All rows of a file, range by range, without a Spark session."""
    options = OsmReadOptions(**settings)
    decode = entity_decoder(osm_schema(options, columns), options.selected_types)
    files = file_set([path], partitions, 2**27, 2**22, 1)
    rows = []
    for task_no in range(files.plan.n_tasks):
        for part in files.plan.ranges_of(task_no):
            for batch in scan_range(files, part, decode):
                batch.validate(full=True)
                rows += batch.to_pylist()
    return rows


def multiset(rows) -> Counter:
    return Counter(repr(row) for row in rows)


def size(path: str) -> int:
    return os.path.getsize(path)
