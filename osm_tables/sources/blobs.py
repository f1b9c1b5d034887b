"""Finding the blobs of a file, from its first byte or from the middle.

A file is a chain of blobs: 4-byte big-endian header length, header, payload. A range of a file owns
the blobs that begin in it. A task that starts in the middle must find the first of them although
bytes inside an uncompressed blob can imitate blobs, even whole chains of them.

It looks at the stretch before its range that is as long as the largest blob may be, so that a true
blob must begin there, and takes everything in it that reads as the header of a data blob. One of
these is true, so if all their chains lead to the same place at or after the start of the range, that
place is right. If they disagree, the stretch before is taken as well, at worst back to the first
byte of the file, which is certain. So every task finds its blobs alone, however a file is cut, with
no pass over the file and no word from its neighbours.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

from .files import Buffered, ReadAhead
from .wire import BYTES, VARINT, fields, signed, varint

# Blob types, and the limits the file format sets.
DATA_BLOB = "OSMData"
HEADER_BLOB = "OSMHeader"
MAX_HEADER_BYTES = 64 * 1024
MAX_BLOB_BYTES = 32 * 1024 * 1024

_NAME = DATA_BLOB.encode()
# From a header's length field to the type's name: 4 bytes, then the type's tag and length, and
# before these, in files that write the size first, a tag and up to five bytes.
_NAME_AT = range(6, 13)
_REACH = 4 + MAX_HEADER_BYTES + MAX_BLOB_BYTES


class Blob(NamedTuple):
    offset: int
    data_offset: int
    datasize: int
    blob_type: str

    @property
    def end(self) -> int:
        return self.data_offset + self.datasize


def read_blob_header(source: ReadAhead | Buffered, offset: int) -> Blob:
    (length,) = struct.unpack(">i", source.read(offset, 4))
    if not 0 <= length <= MAX_HEADER_BYTES:
        raise ValueError(f"{source.location}: bad blob header length {length} at offset {offset}")
    header = source.read(offset + 4, length)
    blob_type = datasize = None
    try:
        for number, wire, start, stop in fields(header, 0, length):
            if number == 1 and wire == BYTES:
                blob_type = bytes(header[start:stop]).decode("utf-8")
            elif number == 3 and wire == VARINT:
                datasize = signed(varint(header, start, stop)[0], 32)
    except ValueError as e:
        raise ValueError(f"{source.location}: bad blob header at offset {offset}: {e}") from e
    if blob_type is None or datasize is None or datasize < 0:
        raise ValueError(f"{source.location}: bad blob header at offset {offset}: field missing")
    return Blob(offset, offset + 4 + length, datasize, blob_type)


def blobs_from(source: ReadAhead | Buffered, pos: int, stop: int | None = None) -> Iterator[Blob]:
    """The chain of blobs from a known blob start to another, or to the end of the file."""
    stop = source.size if stop is None else stop
    while pos < stop:
        blob = read_blob_header(source, pos)
        if blob.end > source.size:
            raise EOFError(
                f"{source.location}: truncated, the blob at offset {pos} ends at {blob.end} "
                f"but the file ends at {source.size}"
            )
        yield blob
        pos = blob.end


def _candidates(source: Buffered, start: int, stop: int) -> Iterator[Blob]:
    """Everything that begins in ``[start, stop)`` and reads as the header of a data blob."""
    seen = set()
    at = source.find(_NAME, start)
    while 0 <= at < stop + _NAME_AT[-1]:
        for back in _NAME_AT:
            offset = at - back
            if start <= offset < stop and offset not in seen:
                try:
                    blob = read_blob_header(source, offset)
                except (ValueError, EOFError):
                    continue
                if blob.blob_type == DATA_BLOB and blob.datasize <= MAX_BLOB_BYTES:
                    seen.add(offset)
                    yield blob
        at = source.find(_NAME, at + 1)


def _landing(source: Buffered, blob: Blob, start: int, known: dict[int, int | None]) -> int | None:
    """Where the chain from a blob first reaches ``start``; None if it breaks off before or there."""
    path, found = [blob.offset], None
    while True:
        if blob.end > source.size:
            break
        if blob.end == source.size:
            found = blob.end
            break
        if blob.end in known:
            found = known[blob.end]
            break
        try:
            following = read_blob_header(source, blob.end)
        except (ValueError, EOFError):
            break
        if following.offset >= start:
            found = following.offset
            break
        blob = following
        path.append(blob.offset)
    known.update(dict.fromkeys(path, found))
    return found


def first_blob_at(source: ReadAhead, start: int) -> int:
    """Offset of the first blob that begins at or after ``start``, or the file's end."""
    stop = min(start, source.size)
    while stop - _REACH > 0:
        begin = stop - _REACH
        nearby = source.buffered(begin, start + _REACH // 64)
        known: dict[int, int | None] = {}
        found = {_landing(nearby, blob, start, known) for blob in _candidates(nearby, begin, stop)} - {None}
        if len(found) == 1:
            return found.pop()
        stop = begin
    if start <= 0:
        return 0
    return next((blob.end for blob in blobs_from(source, 0, start) if blob.end >= start), source.size)


def blobs_of_range(source: ReadAhead, start: int, stop: int) -> Iterator[Blob]:
    """The blobs that begin in ``[start, stop)``; the ranges of a plan share out every blob."""
    return blobs_from(source, first_blob_at(source, start), stop)
