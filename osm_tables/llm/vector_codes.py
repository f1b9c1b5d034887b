"""Vectors as short codes: one byte for each part, the nearest entry of that part's codebook.

The nearest entry is found by slicing and intersecting. For each dimension of a part the entries' coordinates are
kept sorted, and after each of them the mask (bits of 64-bit words, one for each entry) of the entries so far. The
distance to one entry is the first radius; no nearer entry can lie further off in any one dimension, so in each
dimension the entries within the radius are one range of the sorted coordinates, two masks apart. The masks of all
dimensions, ANDed, leave the candidates, which always hold the nearest; only their distances are computed. All
arithmetic is on integers, so results do not depend on how rows are dealt out.

Odd rows: vectors that are null or hold null, NaN or infinite components are dropped; a null id or label is kept (ids
order null last, labels count null as one label); repeated rows are rows of their own; with fewer rows than entries
the codebooks are as short; an empty table gives no rows. Vectors of different lengths, a length that the parts do not
divide, or components beyond `LIMIT` after scaling (their squares would not fit 64 bits) are errors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from osm_tables.llm.shared import OUT_ROWS, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: The largest scaled component.
LIMIT = 1 << 28
#: So many different labels at most are sent to all tasks (some 24 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 100_000


class Codebook:
    """The entries of one part, ready to be searched."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, width = entries.shape
        bits = np.zeros((count, -(-count // 64)), np.uint64)
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.sort(entries, axis=0).T.copy()
        self.masks = np.zeros((width, count + 1, bits.shape[1]), np.uint64)
        for d in range(width):
            self.masks[d, 1:] = np.bitwise_or.accumulate(bits[self.order[:, d]], axis=0)
        # The first guess is made along the dimension in which the entries lie furthest apart.
        spread = entries.max(axis=0) - entries.min(axis=0) if count else np.zeros(width)
        self.widest = int(np.argmax(spread)) if width else -1

    def guess(self, points: np.ndarray) -> np.ndarray:
        if self.widest < 0:
            return np.zeros(len(points), np.int64)
        along, x = self.coordinates[self.widest], points[:, self.widest]
        right = np.clip(np.searchsorted(along, x), 0, len(along) - 1)
        left = np.maximum(right - 1, 0)
        nearer = np.where(np.abs(along[left] - x) <= np.abs(along[right] - x), left, right)
        return self.order[nearer, self.widest]

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that are within ``radius`` in every dimension."""
        found = np.repeat(self.masks[0, -1:] if len(self.masks) else self._all(), len(points), axis=0)
        for d, along in enumerate(self.coordinates):
            low = np.searchsorted(along, points[:, d] - radius, "left")
            high = np.searchsorted(along, points[:, d] + radius, "right")
            found &= self.masks[d, high] & ~self.masks[d, low]
        return found

    def _all(self) -> np.ndarray:
        count = len(self.entries)
        words = [(1 << min(64, count - 64 * w)) - 1 for w in range(-(-count // 64))]
        return np.array([words], np.uint64)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every point (ties: the lowest) and its squared distance."""
        first = ((points - self.entries[self.guess(points)]) ** 2).sum(axis=1)
        masks = self.candidates(points, np.ceil(np.sqrt(first.astype(np.float64))).astype(np.int64) + 1)
        best, error = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        for j, entry in enumerate(self.entries):
            at = np.flatnonzero(masks[:, j // 64] >> np.uint64(j % 64) & np.uint64(1))
            far = ((points[at] - entry) ** 2).sum(axis=1)
            nearer = far < error[at]
            at = at[nearer]
            best[at], error[at] = j, far[nearer]
        return best, error


@dataclass
class Compressed:
    """``rows``: id, label, code and error of every kept vector; ``codebooks``: parts x entries x width."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in order, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def finite(vector: str):
    """That a vector is there and all its components are numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def _scaled(vector: str, scale: int):
    def whole(x):
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        # A float beyond the range of longs is told by its own size.
        fits = F.abs(x.cast("double")) <= LIMIT / scale
        return F.when(fits, y).otherwise(F.raise_error(F.lit(f"a component times {scale} exceeds {LIMIT}"))).cast("int")

    return F.transform(vector, whole)


def _points(column: pa.Array, width: int) -> np.ndarray:
    if not np.all(np.diff(column.offsets.to_numpy()) == width):
        raise ValueError(f"vectors must all have {width} components")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _parts(points: np.ndarray, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each part of the points, with the nearest entries and squared distances."""
    width = books.shape[2]
    for p, entries in enumerate(books):
        part = points[:, p * width : (p + 1) * width]
        yield p, part, *Codebook(entries).nearest(part)


def _next_books(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every entry to the mean of its parts, rounded down."""
    parts, entries, width = books.shape

    def sums(batches):
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            points = _points(batch.column(0), parts * width)
            for p, part, best, _ in _parts(points, books):
                np.add.at(total[p], best, part)
                count[p] += np.bincount(best, minlength=entries)
        flat = total.reshape(parts * entries, width)
        used = np.flatnonzero(count.ravel())
        yield pa.RecordBatch.from_pydict(
            {"entry": pa.array(used, pa.int32()), "n": pa.array(count.ravel()[used]), "total": pa.array(flat[used].tolist(), pa.list_(pa.int64()))}
        )

    found = kept.select("vector").mapInArrow(sums, "entry int, n long, total array<long>")
    by_component = found.select("entry", "n", F.posexplode("total").alias("at", "value")) if width else None
    new = books.copy().reshape(parts * entries, width)
    if by_component is not None:  # parts x entries x width rows, whatever the table
        for r in by_component.groupBy("entry", "at").agg(F.sum("value").alias("s"), F.sum("n").alias("n")).collect():
            new[r["entry"], r["at"]] = r["s"] // r["n"]
    return new.reshape(books.shape)


def _type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def compress(
    df: DataFrame, id_column: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Compressed:
    """Codes of all vectors of ``df``; ids and labels keep their types, other columns do not come along.

    ``rows`` has ``id``, ``label``, ``code`` (two hex digits for each part) and ``error`` (the squared distance of
    the scaled vector from what its code stands for). Codebooks start as the parts of the vectors with the smallest
    ids (ties: the smaller vector) and are moved ``rounds`` times. Driver and tasks hold the codebooks, whose size
    is parameters only; the scaled vectors are written once and read in every round.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a part's code is one byte: 1 to 256 entries")
    kept = written(
        df.where(finite(vector)).select(
            F.col(id_column).alias("id"), F.col(label).alias("label"), _scaled(vector, scale).alias("vector")
        ),
        "vectors",
    )
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    length = len(first[0]["vector"]) if first else 0
    if length % parts or any(len(r["vector"]) != length for r in first):
        raise ValueError(f"vectors must all have one length, which {parts} parts divide")
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, length // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if first else 0):
        books = _next_books(kept, books)

    def encode(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, OUT_ROWS):
                piece = batch.slice(begin, OUT_ROWS)
                points = _points(piece.column(2), length)
                codes, errors = np.zeros((len(points), parts), np.uint8), np.zeros(len(points), np.int64)
                for p, _, best, error in _parts(points, books):
                    codes[:, p], errors = best, errors + error
                said = [c.tobytes().hex() for c in codes]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(said, pa.string()), pa.array(errors)], ["id", "label", "code", "error"])

    out = StructType([
        StructField("id", _type(kept, "id")), StructField("label", _type(kept, "label")),
        StructField("code", StringType()), StructField("error", LongType()),
    ])
    return Compressed(kept.mapInArrow(encode, out), books)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` of `compress` with ``label_error``, the sum of ``error`` over the rows of the same label."""
    rows = written(rows, "codes")
    by_label = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    few = by_label.count() <= BROADCAST_LABELS
    sums = by_label.select(F.col("label").alias("same"), "label_error")
    return rows.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("same"))).drop("same")
