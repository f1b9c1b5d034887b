"""One data blob to Arrow record batches, one batch per kind of entity in it.

Only what the wanted columns need is decoded: unwanted kinds are stepped over before their contents
are looked at, and so are unwanted fields of wanted kinds.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .. import schema as S
from ..options import ENTITY_TYPES, NODE, RELATION, WAY, OsmReadOptions
from ..predicates import Where
from .blobs import MAX_BLOB_BYTES
from .columns import Bytes, Messages, offsets_of, running_sum, zigzag
from .wire import BYTES, VARINT, fields, signed, varint

# Payload fields of a blob, and the features a reader must know to read a file.
RAW, RAW_SIZE, ZLIB = 1, 2, 3
OTHER_CODECS = {4: "lzma", 5: "bzip2", 6: "lz4", 7: "zstd"}
KNOWN_FEATURES = {"OsmSchema-V0.6", "DenseNodes", "HistoricalInformation"}

# Entity group fields, and the scaling of blocks that do not say otherwise.
GROUP_NODES, GROUP_DENSE, GROUP_WAYS, GROUP_RELATIONS = 1, 2, 3, 4
DEFAULT_GRANULARITY = 100
DEFAULT_DATE_GRANULARITY = 1000
NANODEGREE = 0.000000001

# The entities of one kind in a block become one batch, which is cut where it would grow beyond this:
# Arrow's string offsets can address 2 GiB, and a batch is held by Python and by Spark.
MAX_BATCH_ROWS = 100_000
MAX_BATCH_TEXT = 512 * 1024 * 1024

Column = Callable[[int, int], pa.Array]


def payloads(blob) -> Iterator[bytes | memoryview]:
    """The uncompressed contents of a blob message. A codec that cannot be read is an error."""
    raw_size = 0
    for number, wire, start, stop in fields(blob, 0, len(blob)):
        if number == RAW and wire == BYTES:
            yield blob[start:stop]
        elif number == RAW_SIZE and wire == VARINT:
            raw_size = signed(varint(blob, start, stop)[0], 32)
        elif number == ZLIB and wire == BYTES:
            # The stated size is only a hint; a wrong one costs time, not memory or rows.
            yield zlib.decompress(blob[start:stop], bufsize=min(max(raw_size, 4096), MAX_BLOB_BYTES))
        elif wire == BYTES:
            codec = OTHER_CODECS.get(number, f"field {number}")
            raise ValueError(f"blob compression {codec} is not supported")


def check_header(blob) -> None:
    """Reject a file whose header demands a feature that this decoder does not know."""
    for block in payloads(blob):
        for number, wire, start, stop in fields(block, 0, len(block)):
            if number == 4 and wire == BYTES:
                feature = bytes(block[start:stop]).decode("utf-8", "replace")
                if feature not in KNOWN_FEATURES:
                    raise ValueError(f"required feature {feature!r} is not supported")


def decode_blob(
    blob, origin: str, schema: pa.Schema, types: frozenset[str], last_wins: bool = False, where: Where | None = None
) -> Iterator[pa.RecordBatch]:
    """The entities of a blob; ``last_wins`` lets a map keep the last of an entity's equal tag keys.

    With ``where``, what its conditions look at is decoded first, and the rest of matching entities only.
    """
    for block in payloads(blob):
        yield from _Block(block, types, last_wins).batches(schema, origin, where)


def count_blob(blob, types: frozenset[str]) -> Counter[str]:
    """How many entities of every kind a blob holds; nothing else of them is decoded."""
    return sum((_Block(block, types).counts() for block in payloads(blob)), Counter())


class _Block:
    """A primitive block: shared strings and scaling, and where its entities lie."""

    def __init__(self, block, types: frozenset[str], last_wins: bool = False):
        self.last_wins = last_wins
        self.granularity, self.date_granularity = DEFAULT_GRANULARITY, DEFAULT_DATE_GRANULARITY
        self.lat_offset = self.lon_offset = 0
        self._strings = None
        self._table = (0, 0)
        self.types = types
        groups = []
        self._raw = bytes(block)
        size = len(self._raw)
        for number, wire, start, stop in fields(self._raw, 0, size):
            if number == 1 and wire == BYTES:
                self._table = (start, stop)
            elif number == 2 and wire == BYTES:
                groups.append((start, stop))
            elif wire == VARINT and 17 <= number <= 20:
                value = signed(varint(self._raw, start, stop)[0])
                if number == 17:
                    self.granularity = value
                elif number == 18:
                    self.date_granularity = value
                elif number == 19:
                    self.lat_offset = value
                else:
                    self.lon_offset = value
        self.content = Bytes(self._raw)
        self.entities = self._entities(groups)

    def _field_starts(self, pos: int, stop: int) -> np.ndarray:
        """Where every field of a group or string table starts.

        Nothing else takes a step per field, so it takes for granted what nearly always holds, bytes
        fields with small numbers, and looks at their keys afterwards.
        """
        raw, found, first = self._raw, [], pos
        add, last = found.append, stop - 2
        while pos < last:
            add(pos)
            length = raw[pos + 1]
            if length < 0x80:
                pos += length + 2
            elif raw[pos + 2] < 0x80:
                pos += length - 0x80 + (raw[pos + 2] << 7) + 3
            else:
                try:
                    length, after = varint(raw, pos + 1, stop)
                except ValueError:
                    break
                pos = after + length
        if pos == last and raw[pos + 1] == 0:
            add(pos)
            pos += 2
        starts = np.array(found, np.int64)
        if pos == stop and (self.content.data[starts] & 0x87 == BYTES).all():
            return starts
        ends = [first] + [end for _, _, _, end in fields(raw, first, stop)]
        return np.array(ends[:-1], np.int64)

    def _entities(self, groups: list[tuple[int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """(starts, stops) of the messages of every wanted kind, over all groups."""
        if not groups:
            return {}
        at = np.concatenate([self._field_starts(a, b) for a, b in groups])
        keys, found = self.content.data[at], {}
        for kind in _KINDS:
            where = at[keys == kind * 8 + BYTES]
            if len(where) and _KINDS[kind][0] in self.types:
                lengths, starts = self.content.varints_at(where + 1)
                found[kind] = (starts, starts + lengths.astype(np.int64))
        return found

    def strings(self) -> pa.Array:
        if self._strings is None:
            at = self._field_starts(*self._table)
            at = at[self.content.data[at] == 1 * 8 + BYTES]
            lengths, starts = self.content.varints_at(at + 1)
            offsets = offsets_of(lengths.astype(np.int64))
            shift = np.repeat(starts - offsets[:-1], np.diff(offsets))
            text = self.content.data[np.arange(offsets[-1]) + shift]
            buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)]
            self._strings = pa.Array.from_buffers(pa.string(), len(at), buffers)
            try:
                self._strings.validate(full=True)
            except pa.ArrowInvalid:
                binary = pa.Array.from_buffers(pa.binary(), len(at), buffers).to_pylist()
                self._strings = pa.array([b.decode("utf-8", "replace") for b in binary], pa.string())
        return self._strings

    def text(self, ids: np.ndarray) -> pa.Array:
        return self.strings().take(pa.array(ids, pa.int64()))

    def text_bytes(self, ids: np.ndarray) -> np.ndarray:
        return pc.binary_length(self.strings()).to_numpy().astype(np.int64)[ids]

    def longest_text(self) -> int:
        return pc.max(pc.binary_length(self.strings())).as_py() or 0

    def counts(self) -> Counter[str]:
        counts = Counter()
        for number, (starts, stops) in self.entities.items():
            entity_type = _KINDS[number][0]
            if number == GROUP_DENSE:
                counts[entity_type] += Messages(self.content, starts, stops).count(1)
            else:
                counts[entity_type] += len(starts)
        return counts

    def batches(self, schema: pa.Schema, origin: str, where: Where | None = None) -> Iterator[pa.RecordBatch]:
        known = None
        if where and where.keys:
            known = pc.is_in(self.strings(), pa.array(sorted(where.keys), pa.string())).to_numpy(zero_copy_only=False)
            if not known.any():
                return
        for number, (starts, stops) in self.entities.items():
            entity_type, read = _KINDS[number]
            messages = Messages(self.content, starts, stops)
            rows = _Rows(self, schema, entity_type, origin)
            if where and where.columns:
                first = _Rows(self, _schema_of(where), entity_type, origin)
                read(self, messages, first)
                keep = where.matches(first.n, first.arrays, known)
                if not keep.any():
                    continue
                if number == GROUP_DENSE:
                    rows.keep = keep
                else:
                    starts, stops = starts[keep], stops[keep]
                    messages = Messages(self.content, starts, stops)
            if rows.wants(*_ENTITY_COLUMNS):
                read(self, messages, rows)
            elif rows.keep is not None:
                rows.n = int(rows.keep.sum())
            else:
                rows.n = messages.count(1) if number == GROUP_DENSE else len(starts)
            yield from rows.batches()


def _schema_of(where: Where) -> pa.Schema:
    return S.to_arrow_schema(S.osm_schema(OsmReadOptions(), where.columns))


class _Rows:
    """Columns of the entities of one kind, each built for any stretch of rows.

    ``arrays`` has the numbers that columns are built from, of all entities; with ``keep``, columns are
    built of those entities only.
    """

    def __init__(self, block: _Block, schema: pa.Schema, entity_type: str, origin: str):
        self.block = block
        self.schema = schema
        self.n = 0
        self.columns: dict[str, Column] = {
            S.ENTITY_TYPE: lambda a, b: pa.repeat(pa.scalar(entity_type), b - a),
            S.ORIGIN_FILE: lambda a, b: pa.repeat(pa.scalar(origin), b - a),
        }
        self._text_cost = 0
        self.keep: np.ndarray | None = None
        self.arrays: dict[str, tuple] = {}

    def _kept(self, values: np.ndarray | None) -> np.ndarray | None:
        return values if values is None or self.keep is None else values[self.keep]

    def wants(self, *names: str) -> bool:
        return any(n in self.schema.names for n in names)

    def type_of(self, name: str) -> pa.DataType:
        return self.schema.field(name).type

    def numbers(self, name: str, values: np.ndarray, dtype, present: np.ndarray | None = None) -> None:
        values = values.astype(dtype)
        self.arrays[name] = values, present
        values, present = self._kept(values), self._kept(present)
        missing = None if present is None or present.all() else ~present
        self.columns[name] = lambda a, b: pa.array(
            values[a:b], mask=None if missing is None else missing[a:b]
        )

    def ids(self, values: np.ndarray) -> None:
        self.n = len(values) if self.keep is None else int(self.keep.sum())
        self.numbers(S.ID, values, np.int64)

    def text(self, name: str, ids: np.ndarray, present: np.ndarray | None = None) -> None:
        ids, present = self._kept(ids), self._kept(present)

        def column(a, b):
            mask = None if present is None else ~present[a:b]
            return self.block.strings().take(pa.array(ids[a:b], mask=mask))

        self.columns[name] = column
        self.charge(ids if present is None else np.where(present, ids, 0), np.ones(self.n, np.int64))

    def lists(self, name: str, counts: np.ndarray, elements: Column) -> None:
        """A list column; ``elements`` builds the element array of a stretch of elements."""
        offsets = offsets_of(counts)
        self.columns[name] = lambda a, b: pa.ListArray.from_arrays(
            pa.array(offsets[a : b + 1] - offsets[a], pa.int32()),
            elements(offsets[a], offsets[b]),
            type=self.type_of(name),
        )

    def tags(self, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> None:
        """Tags as a list or a map, whichever the schema has; null for an entity without tags."""
        self.arrays[S.TAGS] = keys, counts
        if self.keep is not None:
            inside = np.repeat(self.keep, counts)
            keys, values, counts = keys[inside], values[inside], counts[self.keep]
        offsets, text, kind = offsets_of(counts), self.block.text, self.type_of(S.TAGS)
        if pa.types.is_map(kind):
            keys, values, counts = self._distinct_keys(keys, values, counts)
            offsets = offsets_of(counts)

        def column(a, b):
            bounds = pa.array(offsets[a : b + 1] - offsets[a], pa.int32())
            untagged = pa.array(counts[a:b] == 0)
            names, contents = (text(ids[offsets[a] : offsets[b]]) for ids in (keys, values))
            if pa.types.is_map(kind):
                return pa.MapArray.from_arrays(bounds, names, contents, type=kind, mask=untagged)
            pairs = _structs(kind.value_type, names, contents)
            return pa.ListArray.from_arrays(bounds, pairs, type=kind, mask=untagged)

        self.columns[S.TAGS] = column
        self.charge(keys, counts)
        self.charge(values, counts)

    def _distinct_keys(
        self, keys: np.ndarray, values: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # The string table may hold the same text twice.
        distinct = self.block.strings().dictionary_encode().indices.to_numpy().astype(np.int64)
        entity = np.repeat(np.arange(self.n), counts)
        pairs = entity * len(distinct) + distinct[keys]
        different, first = np.unique(pairs, return_index=True)
        if len(different) == len(pairs):
            return keys, values, counts
        if not self.block.last_wins:
            raise ValueError(
                "an entity has the same tag key twice, which a map cannot hold; "
                "read tags as a list, or set mapKeyDedupPolicy to LAST_WIN"
            )
        # As Spark builds maps: a key stays where it came first, with the value that came last.
        last = len(pairs) - 1 - np.unique(pairs[::-1], return_index=True)[1]
        in_order = np.argsort(first)
        kept = first[in_order]
        return keys[kept], values[last[in_order]], np.bincount(entity[kept], minlength=self.n)

    def charge(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Account for the text that every row will hold, unless it cannot come near the limit."""
        if len(ids) * self.block.longest_text() > MAX_BATCH_TEXT // 8:
            ends = offsets_of(self.block.text_bytes(ids))
            self._text_cost = self._text_cost + np.diff(ends[offsets_of(counts)])

    def batches(self) -> Iterator[pa.RecordBatch]:
        cuts = {0, self.n, *range(0, self.n, MAX_BATCH_ROWS)}
        total = np.cumsum(self._text_cost)
        if total[-1] > MAX_BATCH_TEXT:
            cuts.update((np.flatnonzero(np.diff(total // MAX_BATCH_TEXT)) + 1).tolist())
        for a, b in pairwise(sorted(cuts)):
            arrays = [
                self.columns[f.name](a, b) if f.name in self.columns else pa.nulls(b - a, f.type)
                for f in self.schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _structs(kind: pa.StructType, *arrays: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(arrays), fields=list(kind))


def _same_counts(first: np.ndarray, *others: np.ndarray) -> None:
    if any((o != first).any() for o in others):
        raise ValueError("parallel fields differ in length")


def _coordinates(block: _Block, rows: _Rows, lat: np.ndarray, lon: np.ndarray) -> None:
    rows.numbers(S.LATITUDE, (block.lat_offset + block.granularity * lat) * NANODEGREE, np.float64)
    rows.numbers(S.LONGITUDE, (block.lon_offset + block.granularity * lon) * NANODEGREE, np.float64)


# Metadata message fields: column, field number, type, and whether the dense form is zigzag deltas.
_METADATA = (
    (S.VERSION, 1, np.int32, False),
    (S.TIMESTAMP, 2, np.int64, True),
    (S.CHANGESET, 3, np.int64, True),
    (S.UID, 4, np.int32, True),
    (S.USER_SID, 5, np.int64, True),
)


def _metadata_column(block: _Block, rows: _Rows, name, values, dtype, present=None) -> None:
    if name == S.USER_SID:
        rows.text(name, values, present)
    else:
        if name == S.TIMESTAMP:
            values = values * block.date_granularity
        rows.numbers(name, values, dtype, present)


def _read_dense(block: _Block, messages: Messages, rows: _Rows) -> None:
    """Dense messages: each holds columns of nodes, ``sizes`` of them, and may lack optional columns."""
    ids, sizes = messages.repeated(1)
    rows.ids(running_sum(zigzag(ids), sizes))
    if rows.wants(S.LATITUDE, S.LONGITUDE):
        (lat, lat_counts), (lon, lon_counts) = messages.repeated(8), messages.repeated(9)
        _same_counts(sizes, lat_counts, lon_counts)
        lat, lon = running_sum(zigzag(lat), sizes), running_sum(zigzag(lon), sizes)
        _coordinates(block, rows, lat, lon)
    if rows.wants(*S.METADATA):
        info = messages.submessages(5)
        for name, number, dtype, is_delta in _METADATA:
            if rows.wants(name):
                values, counts = info.repeated(number)
                _same_counts(sizes[counts > 0], counts[counts > 0])
                values = running_sum(zigzag(values), counts) if is_delta else values.view(np.int64)
                values, present = _spread(values, counts > 0, sizes)
                _metadata_column(block, rows, name, values, dtype, present)
    if rows.wants(S.TAGS):
        keys_values, lengths = messages.repeated(10)
        has = lengths > 0
        keys, values, counts = _dense_tags(keys_values.view(np.int64), lengths[has], sizes[has])
        rows.tags(keys, values, _spread(counts, has, sizes)[0])


def _spread(values: np.ndarray, has: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes' values, 0 in the messages that have none, and which nodes have one."""
    present = np.repeat(has, sizes)
    if not has.all():
        known, values = values, np.zeros(len(present), np.int64)
        values[present] = known
    return values, present


def _dense_tags(
    ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, values and tag counts of nodes. A message lists the pairs of every node, each node closed
    by a 0; ``ids`` has ``lengths`` numbers for the ``sizes`` nodes of each message."""
    closing = np.flatnonzero(ids == 0)
    if (np.diff(closing, prepend=-1) % 2 == 0).any():
        # A 0 that stands where a value belongs is the empty string, not the end of a node.
        closing, pos = [], 0
        for at in np.flatnonzero(ids == 0).tolist():
            if at >= pos and (at - pos) % 2 == 0:
                closing.append(at)
                pos = at + 1
        closing = np.array(closing, np.int64)
    ends, nodes = np.cumsum(lengths), np.cumsum(sizes)
    _same_counts(nodes, np.searchsorted(closing, ends))
    if (nodes == 0).any() or (closing[nodes - 1] != ends - 1).any():
        raise ValueError("parallel fields differ in length")
    pairs = np.delete(ids, closing).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1], (np.diff(closing, prepend=-1) - 1) // 2


def _read_common(block: _Block, messages: Messages, rows: _Rows, zigzag_id: bool) -> None:
    ids, present = messages.scalar(1)
    if not present.all():
        raise ValueError("entity without an id")
    rows.ids(zigzag(ids) if zigzag_id else ids.view(np.int64))
    if rows.wants(*S.METADATA):
        info = messages.submessages(4)
        for name, number, dtype, _ in _METADATA:
            if rows.wants(name):
                values, present = info.scalar(number)
                _metadata_column(block, rows, name, values.view(np.int64), dtype, present)
    if rows.wants(S.TAGS):
        keys, counts = messages.repeated(2)
        values, value_counts = messages.repeated(3)
        _same_counts(counts, value_counts)
        rows.tags(keys.view(np.int64), values.view(np.int64), counts)


def _read_nodes(block: _Block, messages: Messages, rows: _Rows) -> None:
    _read_common(block, messages, rows, zigzag_id=True)
    if rows.wants(S.LATITUDE, S.LONGITUDE):
        (lat, has_lat), (lon, has_lon) = messages.scalar(8), messages.scalar(9)
        if not (has_lat.all() and has_lon.all()):
            raise ValueError("node without coordinates")
        _coordinates(block, rows, zigzag(lat), zigzag(lon))


def _read_ways(block: _Block, messages: Messages, rows: _Rows) -> None:
    _read_common(block, messages, rows, zigzag_id=False)
    if rows.wants(S.NODES):
        deltas, counts = messages.repeated(8)
        refs = running_sum(zigzag(deltas), counts)
        element = rows.type_of(S.NODES).value_type
        if pa.types.is_struct(element):
            index = np.arange(len(refs)) - np.repeat(offsets_of(counts)[:-1], counts)
            index = index.astype(np.int32)
            rows.lists(
                S.NODES, counts, lambda a, b: _structs(element, pa.array(index[a:b]), pa.array(refs[a:b]))
            )
        else:
            rows.lists(S.NODES, counts, lambda a, b: pa.array(refs[a:b]))


def _read_relations(block: _Block, messages: Messages, rows: _Rows) -> None:
    _read_common(block, messages, rows, zigzag_id=False)
    if rows.wants(S.MEMBERS):
        roles, role_counts = messages.repeated(8)
        deltas, counts = messages.repeated(9)
        kinds, kind_counts = messages.repeated(10)
        _same_counts(counts, role_counts, kind_counts)
        ids = running_sum(zigzag(deltas), counts)
        roles, kinds = roles.view(np.int64), kinds.view(np.int64)
        element = rows.type_of(S.MEMBERS).value_type
        names = pa.array(ENTITY_TYPES)
        rows.lists(
            S.MEMBERS,
            counts,
            lambda a, b: _structs(
                element, pa.array(ids[a:b]), block.text(roles[a:b]), names.take(pa.array(kinds[a:b]))
            ),
        )
        rows.charge(roles, counts)


_ENTITY_COLUMNS = (S.ID, *S.METADATA, S.TAGS, S.LATITUDE, S.LONGITUDE, S.NODES, S.MEMBERS)
_KINDS = {
    GROUP_NODES: (NODE, _read_nodes),
    GROUP_DENSE: (NODE, _read_dense),
    GROUP_WAYS: (WAY, _read_ways),
    GROUP_RELATIONS: (RELATION, _read_relations),
}
