"""Columnar protobuf parsing: whole arrays of messages and numbers at a time, with NumPy."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from .wire import BYTES, FIXED32, FIXED64, VARINT

# Zero bytes after the data, so that a varint read at its very end stays inside the array.
PADDING = 16
# For fewer positions a search for each is cheaper than ranks for all bytes of a block.
FEW = 256


class Bytes:
    """The bytes of a block, with numbers read from many places at a time."""

    def __init__(self, content):
        self.length = len(content)
        self.data = np.zeros(-(-(self.length + PADDING) // 64) * 64, np.uint8)
        self.data[: self.length] = np.frombuffer(content, np.uint8)
        self._words = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))

    @cached_property
    def last_bytes(self) -> np.ndarray:
        """Where bytes stand that can end a number."""
        return np.flatnonzero(self.data[: self.length] < 0x80)

    @cached_property
    def _ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Those bytes as bits, 64 to a number, and how many there are before each 64."""
        bits = np.packbits(self.data < 0x80, bitorder="little").view("<u8")
        return bits, offsets_of(np.bitwise_count(bits))

    def _last_bytes_before(self, pos: np.ndarray) -> np.ndarray:
        if len(pos) < FEW:
            return np.searchsorted(self.last_bytes, pos)
        bits, before = self._ranks
        word, low = pos >> 6, (np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(bits[word] & low)

    def varints_at(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The varint at every position, and the positions after them."""
        byte = self.data[pos]
        if (byte < 0x80).all():
            return byte.astype(np.uint64), pos + 1
        # Eight bytes at once. The lowest top bit that is clear marks the last byte of the number.
        values = self._words[pos]
        mask = ~values
        mask &= _TOP_BITS
        long = np.flatnonzero(mask == 0)
        spare = mask - np.uint64(1)
        mask ^= spare
        values &= mask
        values &= ~_TOP_BITS
        for bits, low in _JOIN:
            np.bitwise_and(values, ~low, out=spare)
            spare >>= bits
            values &= low
            values |= spare
        after = pos + (np.bitwise_count(mask) >> 3)
        if long.size:
            values[long], after[long] = self._long_varints(pos[long], values[long])
        return values, after

    def _long_varints(self, pos, values):
        """Numbers of nine and ten bytes, whose first 56 bits are in ``values``."""
        ninth, tenth = self.data[pos + 8], self.data[pos + 9]
        two_more = ninth >= 0x80
        if (two_more & (tenth >= 0x80)).any():
            raise ValueError("malformed varint")
        values = values | (ninth & 0x7F).astype(np.uint64) << np.uint64(56)
        values |= np.where(two_more, tenth, 0).astype(np.uint64) << np.uint64(63)
        return values, pos + 9 + two_more

    def count_varints(self, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many varints fill each byte range, and which last byte is the first one's."""
        last = self.last_bytes
        at, to = self._last_bytes_before(starts), self._last_bytes_before(stops)
        filled = starts < stops
        if (to[filled] == 0).any() or (last[to[filled] - 1] != stops[filled] - 1).any():
            raise ValueError("packed field ends inside a number")
        return to - at, at

    def varints_in(self, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All varints of byte ranges that hold nothing else, and how many each range has."""
        counts, at = self.count_varints(starts, stops)
        ends = np.cumsum(counts)
        if len(counts) == 0 or ends[-1] == 0:
            return np.empty(0, np.uint64), counts
        # A number starts after the one before it, or with its range.
        before = np.arange(-1, ends[-1] - 1) + np.repeat(at - (ends - counts), counts)
        first = self.last_bytes[before] + 1
        filled = counts > 0
        first[(ends - counts)[filled]] = starts[filled]
        return self.varints_at(first)[0], counts


_TOP_BITS = np.uint64(0x8080808080808080)
# Steps that close the gaps between 7-bit groups: how far to shift, and the bits that stay in place.
_JOIN = tuple(
    (np.uint64(bits), np.uint64(low))
    for bits, low in ((1, 0x007F007F007F007F), (2, 0x00003FFF00003FFF), (4, 0x000000000FFFFFFF))
)


def zigzag(values: np.ndarray) -> np.ndarray:
    """sint32/sint64 numbers from their unsigned varints."""
    return (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)


def offsets_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def running_sum(deltas: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Cumulative sums that start again at every group of ``counts`` numbers."""
    if len(counts) == 1:
        return np.cumsum(deltas)
    total = offsets_of(deltas)
    starts = offsets_of(counts)[:-1]
    return total[1:] - np.repeat(total[starts], counts)


class Messages:
    """The fields of many messages of one kind.

    All messages are read in step: round k reads the k-th field of every message that has one, so the
    number of rounds is the field count of a message, not the number of messages. Every field
    occurrence is kept as a byte range, which makes packed and unpacked repeated fields look alike.
    ``owner`` says which row a message belongs to, for sub-messages that some rows lack.
    """

    def __init__(self, content: Bytes, starts, stops, owner=None, n_rows=None):
        self._content = content
        self.n_rows = len(starts) if n_rows is None else n_rows
        starts, stops = np.asarray(starts, np.int64), np.asarray(stops, np.int64)
        owner = np.arange(len(starts)) if owner is None else owner
        rounds = []
        live = np.flatnonzero(starts < stops)
        pos = starts[live]
        while live.size:
            ends = stops[live]
            keys, pos = content.varints_at(pos)
            pos, after = self._extent(content, keys & np.uint64(7), pos, ends)
            rounds.append((owner[live], keys.view(np.int64), pos, after))
            keep = after < ends
            live, pos = live[keep], after[keep]
        columns = zip(*rounds) if rounds else [[np.empty(0, np.int64)]] * 4
        self._owner, self._key, self._start, self._stop = map(np.concatenate, columns)

    @staticmethod
    def _extent(content, wire, pos, ends):
        """Where every field's payload starts and stops."""
        is_bytes = wire == BYTES
        if (is_bytes | (wire == VARINT)).all():
            if (pos >= ends).any():
                raise ValueError("field does not fit its message")
            values, past = content.varints_at(pos)
            lengths = np.where(is_bytes, values, 0)
            if (lengths > content.length).any():
                raise ValueError("field does not fit its message")
            start, after = np.where(is_bytes, past, pos), past + lengths.astype(np.int64)
        else:
            # Fixed-width fields, which the format does not use, are stepped over.
            widths = np.select([wire == FIXED64, wire == FIXED32], [8, 4], 0)
            start, after = pos.copy(), pos + widths
            rest = np.flatnonzero(widths == 0)
            if not (is_bytes | (wire == VARINT))[rest].all():
                raise ValueError("wire type is not supported")
            start[rest], after[rest] = Messages._extent(content, wire[rest], pos[rest], ends[rest])
        if (after > ends).any():
            raise ValueError("field does not fit its message")
        return start, after

    def spans(self, number: int, *wires: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, stop) of every occurrence of a field, by row and then by position."""
        wanted = self._key == number * 8 + wires[0]
        for wire in wires[1:]:
            wanted |= self._key == number * 8 + wire
        where = np.flatnonzero(wanted)
        rows = self._owner[where]
        if len(rows) > 1 and (rows[1:] <= rows[:-1]).any():
            where = where[np.argsort(rows, kind="stable")]
        return self._owner[where], self._start[where], self._stop[where]

    def repeated(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a repeated field for all rows in a row, and how many each row has."""
        rows, starts, stops = self.spans(number, BYTES, VARINT)
        values, found = self._content.varints_in(starts, stops)
        if len(found) == self.n_rows and (rows[1:] > rows[:-1]).all():
            return values, found
        counts = np.zeros(self.n_rows, np.int64)
        np.add.at(counts, rows, found)
        return values, counts

    def count(self, number: int) -> int:
        """How many numbers a repeated field holds in all rows together."""
        _, starts, stops = self.spans(number, BYTES, VARINT)
        return int(self._content.count_varints(starts, stops)[0].sum())

    def scalar(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """A single field as (values, present) per row; the last occurrence wins."""
        rows, starts, _ = self.spans(number, VARINT)
        values = np.zeros(self.n_rows, np.uint64)
        present = np.zeros(self.n_rows, bool)
        if len(rows):
            values[rows] = self._content.varints_at(starts)[0]
            present[rows] = True
        return values, present

    def submessages(self, number: int) -> Messages:
        rows, starts, stops = self.spans(number, BYTES)
        return Messages(self._content, starts, stops, owner=rows, n_rows=self.n_rows)
