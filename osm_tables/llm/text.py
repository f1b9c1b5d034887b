"""Words of many texts at once, as 64-bit hashes, with NumPy.

Words are runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 these bytes occur in no other
character, so bytes can be worked on without decoding. Two different words share a hash with a
probability of about ``n * n / 2**65`` among ``n`` words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes that are looked at together; longer only where a single text or word is longer.
SEGMENT = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_ODD), -1, 2**64))
    up, down = np.full(size, _ODD), np.full(size + 1, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, and where each text begins and the last ends; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text alone."""
    begin = 0
    while begin < len(at) - 1:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
        yield begin, end
        begin = end


def _bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = at[:-1][at[1:] > at[:-1]]
    begins[inner] = solid[inner]
    last = at[1:][at[1:] > at[:-1]] - 1
    ends[last] = solid[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, at: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts in order, and the number of words of each text.

    ``fold`` lower-cases A-Z. A text of many megabytes is worked through in segments that end
    between words, so only its hashes are held whole.
    """
    if len(data) > 4 * SEGMENT and len(at) == 2:
        hashes, begin = [], 0
        while begin < len(data):
            end = min(len(data), begin + SEGMENT)
            while end < len(data):  # to the next byte between words
                gap = np.flatnonzero(_SPACE[data[end : end + SEGMENT]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(len(data), end + SEGMENT)
            hashes.append(_segment_hashes(data[begin:end], np.array([0, end - begin]), fold)[0])
            begin = end
        out = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        return out, np.array([len(out)])
    return _segment_hashes(data, at, fold)


def _segment_hashes(data, at, fold):
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    begins, ends = _bounds(data, at)
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_FOLD[data] if fold else data] * up[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[begins]) * down[begins])
    return hashes, np.diff(np.searchsorted(begins, at))


def per_text(values: np.ndarray, counts: np.ndarray, reduce=np.add, empty=0) -> np.ndarray:
    """``reduce`` over each text's run of ``values``; ``empty`` where a text has none."""
    out = np.full(len(counts), empty, values.dtype)
    full = counts > 0
    if full.any():
        out[full] = reduce.reduceat(values, (np.cumsum(counts) - counts)[full])
    return out
