"""Writing entity blocks, blobs and files."""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Row kinds of the writer's input.
DENSE_NODE, PLAIN_NODE, WAY, RELATION = 0, 1, 2, 3


def uvarint(n: int) -> bytes:
    n &= 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def zz(n: int) -> int:
    return 2 * n if n >= 0 else -2 * n - 1


def put(number: int, value: int | bytes | str) -> bytes:
    """One field: a varint for an integer, length-delimited for bytes and text."""
    if isinstance(value, int):
        return uvarint(number * 8) + uvarint(value)
    if isinstance(value, str):
        value = value.encode()
    return uvarint(number * 8 + 2) + uvarint(len(value)) + value


def put_list(number: int, values) -> bytes:
    return put(number, b"".join(map(uvarint, values)))


class Pieces(NamedTuple):
    """Bytes of many items, end to end, and how many each of them has."""

    data: np.ndarray
    sizes: np.ndarray


def zigzag(values: np.ndarray) -> np.ndarray:
    return np.where(values >= 0, values * 2, values * -2 - 1)


def varints(values: np.ndarray) -> Pieces:
    rest = np.asarray(values, np.int64).astype(np.uint64)
    # As many bytes as the greatest number takes; most arrays have small ones only.
    most = max(1, -(-int(rest.max(initial=0)).bit_length() // 7))
    used = np.ones(len(rest), np.int64)
    if most == 1:
        return Pieces(rest.astype(np.uint8), used)
    groups = np.empty((len(rest), most), np.uint8)
    for k in range(most):
        groups[:, k] = rest.astype(np.uint8) & 127
        rest = rest >> np.uint64(7)
        more = rest > 0
        groups[:, k] |= more.view(np.uint8) << 7
        used += more
    return Pieces(groups[np.arange(most) < used[:, None]], used)


def put_array(number: int, values: np.ndarray, delta: bool = False, signed: bool = False) -> bytes:
    """A packed field from an int64 array, optionally as zigzag numbers and as differences."""
    values = np.asarray(values, np.int64)
    if delta:
        values = np.diff(values, prepend=np.int64(0))
    return put(number, varints(zigzag(values) if signed else values).data.tobytes())


def joined(*parts: Pieces) -> Pieces:
    """For every item its bytes from all ``parts``, one after another."""
    sizes = np.sum([p.sizes for p in parts], axis=0)
    data = np.empty(int(sizes.sum()), np.uint8)
    at = np.cumsum(sizes) - sizes
    for part in parts:
        within = np.arange(len(part.data)) - np.repeat(np.cumsum(part.sizes) - part.sizes, part.sizes)
        data[np.repeat(at, part.sizes) + within] = part.data
        at = at + part.sizes
    return Pieces(data, sizes)


def _only(pieces: Pieces, present: np.ndarray | None) -> Pieces:
    if present is None:
        return pieces
    return Pieces(pieces.data[np.repeat(present, pieces.sizes)], np.where(present, pieces.sizes, 0))


def _keys(number: int, n: int) -> Pieces:
    return varints(np.full(n, number))


def number_field(number: int, values: np.ndarray) -> Pieces:
    return joined(_keys(number * 8, len(values)), varints(values))


def bytes_field(number: int, content: Pieces, present: np.ndarray | None = None) -> Pieces:
    """``content`` as a field of every item, or of those that are ``present``."""
    return _only(joined(_keys(number * 8 + 2, len(content.sizes)), varints(content.sizes), content), present)


def per_row(pieces: Pieces, counts: np.ndarray) -> Pieces:
    """Items put together to rows of ``counts`` items."""
    ends = np.concatenate(([0], np.cumsum(pieces.sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    return Pieces(pieces.data, np.diff(ends))


def blob(blob_type: str, block: bytes, codec: str) -> bytes:
    if codec == "zlib":
        message = put(2, len(block)) + put(3, zlib.compress(block, 6))
    else:
        message = put(1, block)
    header = put(1, blob_type) + put(3, len(message))
    return struct.pack(">I", len(header)) + header + message


def header_blob(*features: str) -> bytes:
    return blob("OSMHeader", b"".join(put(4, f) for f in features), "zlib")


class _Strings:
    def __init__(self):
        self.ids = {"": 0}

    def __getitem__(self, text: str) -> int:
        return self.ids.setdefault(text, len(self.ids))

    def ids_of(self, texts) -> np.ndarray:
        """Ids of a column of texts; only different ones are looked up."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        coded = texts.dictionary_encode()
        own = np.array([self[t] for t in coded.dictionary.to_pylist()], np.int64)
        return own[coded.indices.to_numpy(zero_copy_only=False)] if len(texts) else np.zeros(0, np.int64)

    def encode(self) -> bytes:
        return put(1, b"".join(put(1, s) for s in self.ids))


def block(rows: pa.Table, granularity: int, lat_offset: int, lon_offset: int, date_granularity: int) -> bytes:
    """One block: its rows grouped by kind. Coordinates arrive in units of 1e-7 degrees."""
    strings = _Strings()
    groups = b""
    for kind, write in _WRITERS.items():
        of_kind = rows.filter(pc.equal(rows["kind"], kind))
        if of_kind.num_rows:
            groups += put(2, write(of_kind, strings, granularity, (lat_offset, lon_offset), date_granularity))
    scaling = put(17, granularity) + put(18, date_granularity) + put(19, lat_offset) + put(20, lon_offset)
    return strings.encode() + groups + scaling


def _dense(rows: pa.Table, strings: _Strings, granularity: int, offsets: tuple[int, int], date_granularity: int) -> bytes:
    def column(name):
        return rows[name].to_numpy()

    users = strings.ids_of(rows["user"])
    info = (
        put_array(1, column("version"))
        + put_array(2, column("timestamp") // date_granularity, delta=True, signed=True)
        + put_array(3, column("changeset"), delta=True, signed=True)
        + put_array(4, column("uid"), delta=True, signed=True)
        + put_array(5, users, delta=True, signed=True)
    )
    # After each node's keys and values, which alternate, a zero.
    (keys, counts), (values, _) = (_lists(rows[c]) for c in ("keys", "values"))
    ends = np.cumsum(2 * counts + 1)
    pairs = np.zeros(int(ends[-1]), np.int64)
    used = np.ones(len(pairs), bool)
    used[ends - 1] = False
    at = np.flatnonzero(used)
    pairs[at[0::2]], pairs[at[1::2]] = strings.ids_of(keys), strings.ids_of(values)
    dense = put_array(1, column("id"), delta=True, signed=True) + put(5, info)
    for number, name, offset in zip((8, 9), ("lat_e7", "lon_e7"), offsets):
        units = (column(name) * 100 - offset) // granularity
        dense += put_array(number, units, delta=True, signed=True)
    return put(2, dense + put_array(10, pairs))


def _lists(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of all lists, and how many each list has."""
    lists = column.combine_chunks()
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _differences(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.diff(values, prepend=np.int64(0))
    first = (np.cumsum(counts) - counts)[counts > 0]
    out[first] = values[first]
    return zigzag(out)


def _common(rows: pa.Table, strings: _Strings, date_granularity: int) -> Pieces:
    """Tags and info of entities that are messages of their own."""

    def column(name):
        return rows[name].to_numpy()

    parts = []
    for number, name in ((2, "keys"), (3, "values")):
        texts, counts = _lists(rows[name])
        parts.append(bytes_field(number, per_row(varints(strings.ids_of(texts)), counts), counts > 0))
    info = joined(
        number_field(1, column("version")),
        number_field(2, column("timestamp") // date_granularity),
        number_field(3, column("changeset")),
        number_field(4, column("uid")),
        number_field(5, strings.ids_of(rows["user"])),
    )
    return joined(*parts, bytes_field(4, info, column("has_info").astype(bool)))


def _nodes(rows: pa.Table, strings: _Strings, granularity: int, offsets: tuple[int, int], date_granularity: int) -> bytes:
    lat, lon = ((rows[n].to_numpy() * 100 - offset) // granularity for n, offset in zip(("lat_e7", "lon_e7"), offsets))
    message = joined(
        number_field(1, zigzag(rows["id"].to_numpy())),
        _common(rows, strings, date_granularity),
        number_field(8, zigzag(lat)),
        number_field(9, zigzag(lon)),
    )
    return bytes_field(1, message).data.tobytes()


def _ways(rows: pa.Table, strings: _Strings, granularity: int, offsets: tuple[int, int], date_granularity: int) -> bytes:
    refs, counts = _lists(rows["refs"])
    refs = per_row(varints(_differences(refs.to_numpy(zero_copy_only=False), counts)), counts)
    message = joined(number_field(1, rows["id"].to_numpy()), _common(rows, strings, date_granularity), bytes_field(8, refs))
    return bytes_field(3, message).data.tobytes()


def _relations(rows: pa.Table, strings: _Strings, granularity: int, offsets: tuple[int, int], date_granularity: int) -> bytes:
    members, counts = _lists(rows["members"])
    ids, types = (members.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("id", "type"))
    message = joined(
        number_field(1, rows["id"].to_numpy()),
        _common(rows, strings, date_granularity),
        bytes_field(8, per_row(varints(strings.ids_of(members.field("role"))), counts)),
        bytes_field(9, per_row(varints(_differences(ids, counts)), counts)),
        bytes_field(10, per_row(varints(types), counts)),
    )
    return bytes_field(4, message).data.tobytes()


_WRITERS = {DENSE_NODE: _dense, PLAIN_NODE: _nodes, WAY: _ways, RELATION: _relations}
