"""Protobuf fields as byte ranges, for the few messages that are read one at a time."""

from __future__ import annotations

from collections.abc import Iterator

# Protobuf wire types.
VARINT = 0
FIXED64 = 1
BYTES = 2
FIXED32 = 5


def varint(data, pos: int, end: int) -> tuple[int, int]:
    """The unsigned varint at ``pos`` and the position after it."""
    value = shift = 0
    while pos < end and shift < 70:
        byte = data[pos]
        pos += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value & 0xFFFFFFFFFFFFFFFF, pos
        shift += 7
    raise ValueError("malformed varint")


def signed(value: int, bits: int = 64) -> int:
    """An int32/int64 field from its unsigned varint."""
    value &= (1 << bits) - 1
    return value - (1 << bits) if value >> (bits - 1) else value


def fields(data, pos: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(number, wire type, start, stop) of every field; bytes fields exclude their length."""
    while pos < end:
        key, pos = varint(data, pos, end)
        wire = key & 7
        if wire == BYTES:
            length, pos = varint(data, pos, end)
            stop = pos + length
        elif wire == VARINT:
            _, stop = varint(data, pos, end)
        elif wire == FIXED64:
            stop = pos + 8
        elif wire == FIXED32:
            stop = pos + 4
        else:
            raise ValueError(f"wire type {wire} is not supported")
        if stop > end or key < 8:
            raise ValueError("field does not fit its message")
        yield key >> 3, wire, pos, stop
        pos = stop
