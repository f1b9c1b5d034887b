"""Opening files by path or URI on the driver and in tasks, through Arrow's file systems."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from urllib.parse import quote, unquote

from pyarrow import fs

_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.\-]*):(/.*)$", re.DOTALL)
# Schemes that Hadoop spells differently from Arrow.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
# Hadoop's names of access settings, and Arrow's.
S3_SETTINGS = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}


def to_location(path: str, default_fs: str | None = None) -> str:
    """A location every task can open: relative paths made absolute, URI text made legal.

    ``default_fs`` is the cluster's default file system, which paths without a scheme belong to.
    """
    match = _URI.match(path)
    if match is None:
        if default_fs and not default_fs.startswith("file:"):
            return to_location(default_fs.rstrip("/") + "/" + path.lstrip("/"))
        return os.path.abspath(path)
    scheme, rest = match.groups()
    if not rest.startswith("//"):
        rest = "//" + rest
    # '%' stays as it is: the caller may have quoted already.
    return f"{_SCHEMES.get(scheme.lower(), scheme)}:{quote(rest, safe='/%:@?&=+$,;~!*()[]')}"


def s3_settings(hadoop: Mapping[str, str | None]) -> dict[str, str]:
    """Arrow's form of the access settings among Hadoop's; names ignore case, as options do."""
    given = {k.lower(): v for k, v in hadoop.items() if v}
    return {ours: given[name] for name, ours in S3_SETTINGS.items() if name in given}


def file_system(location: str, s3: Mapping[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """The file system of a location and the path in it; ``s3`` are settings for S3 locations."""
    if s3 and location.startswith("s3://"):
        return fs.S3FileSystem(**s3), unquote(location[len("s3://") :])
    return fs.FileSystem.from_uri(location)


def file_sizes(locations: Sequence[str], s3: Mapping[str, str] | None = None) -> list[int]:
    """Length of each file. One listing request per file system, issued in parallel by Arrow."""
    systems: dict[str, tuple[fs.FileSystem, list[int], list[str]]] = {}
    for i, location in enumerate(locations):
        root = "/".join(location.split("/")[:3]) if "://" in location else ""
        if root in systems:
            system = systems[root][0]
            path = location if root == "" else file_system(location, s3)[1]
        else:
            system, path = file_system(location, s3)
            systems[root] = (system, [], [])
        systems[root][1].append(i)
        systems[root][2].append(path)
    sizes = [0] * len(locations)
    for system, places, paths in systems.values():
        for i, info in zip(places, system.get_file_info(paths)):
            if info.type != fs.FileType.File:
                raise FileNotFoundError(f"Not a file: {locations[i]}")
            sizes[i] = info.size
    return sizes


class Buffered:
    """Part of a file in memory; what lies outside is read from the file."""

    def __init__(self, source: ReadAhead, start: int, data: bytes):
        self.location, self.size = source.location, source.size
        self._source, self._start, self._data = source, start, data

    def read(self, offset: int, length: int) -> memoryview:
        at = offset - self._start
        if 0 <= at and at + length <= len(self._data):
            return memoryview(self._data)[at : at + length]
        return self._source.read(offset, length)

    def find(self, pattern: bytes, start: int) -> int:
        """Offset of the first match at or after ``start`` in the buffer, or -1."""
        at = self._data.find(pattern, max(0, start - self._start))
        return at if at < 0 else at + self._start


class ReadAhead:
    """Byte ranges of one open file, mostly read in order, served from a window of it.

    The bytes after the window, up to ``until``, are fetched while the caller works on the window, so
    that decoding does not wait for remote storage.
    """

    def __init__(
        self, location: str, size: int, chunk_bytes: int, until: int = 0, s3: Mapping[str, str] | None = None
    ):
        self.location = location
        self.size = size
        self._chunk_bytes = chunk_bytes
        self._until = min(until, size)
        system, path = file_system(location, s3)
        self._file = system.open_input_file(path)
        self._start = 0
        self._window = memoryview(b"")
        self._fetcher = ThreadPoolExecutor(1) if until else None
        self._next: Future | None = None
        self._last: int | None = None

    def only_until(self, stop: int) -> None:
        """From now on nothing beyond ``stop`` is fetched unless it is asked for."""
        self._until = self._last = min(stop, self.size)

    def __enter__(self) -> ReadAhead:
        return self

    def __exit__(self, *exc) -> None:
        if self._fetcher is not None:
            self._fetcher.shutdown(cancel_futures=True)
        self._file.close()

    def read(self, offset: int, length: int) -> memoryview:
        """Exactly ``length`` bytes, or an error: a short read never passes as end of file."""
        at = offset - self._start
        if 0 <= at and at + length <= len(self._window):
            return self._window[at : at + length]
        if offset + length > self.size:
            raise EOFError(
                f"{self.location}: truncated, {length} bytes wanted at offset {offset} "
                f"but the file ends at {self.size}"
            )
        self._move_window(offset, length)
        return self._window[:length]

    def buffered(self, start: int, stop: int) -> Buffered:
        """The bytes from ``start`` to ``stop`` or the file's end, in memory."""
        return Buffered(self, start, self._fetch(start, min(stop, self.size) - start))

    def _fetch(self, offset: int, length: int) -> bytes:
        data = self._file.read_at(length, offset)
        if len(data) < length:
            raise EOFError(f"{self.location}: truncated, short read at offset {offset}")
        return data

    def _move_window(self, offset: int, length: int) -> None:
        parts, fetched = [], 0
        if self._next is not None and self._start <= offset <= self._start + len(self._window):
            # The window goes on: what is left of it, and what came after it in the meantime.
            parts = [self._window[offset - self._start :], self._next.result()]
            fetched = sum(map(len, parts))
        if fetched < length or not parts:
            ahead = offset + self._chunk_bytes if self._last is None else min(offset + self._chunk_bytes, self._last)
            end = min(max(offset + length, ahead), self.size)
            parts.append(self._fetch(offset + fetched, end - offset - fetched))
        self._start = offset
        self._window = memoryview(parts[0] if len(parts) == 1 else b"".join(parts))
        self._next = None
        end = offset + len(self._window)
        if end < self._until:
            ahead = min(self._chunk_bytes, self._until - end)
            self._next = self._fetcher.submit(self._fetch, end, ahead)
