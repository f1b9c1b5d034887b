"""Sums over the nodes in each of many boxes, without a row for each node in a box.

A box holds what lies below and left of its upper right corner, less what lies so of two others, and more what lies
so of the fourth. What lies so of a corner is summed in three parts: the map is cut into strips of latitude
(rows) and, apart from that, of longitude (columns). A corner's own row is compared with it in one task, its own column,
as far as it lies in rows before, in another, and of all cells in rows and columns before there are sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .. import schema as S
from ..plans.tables import written

#: Places and corners in a strip, about: one task holds a strip at a time. There are as many cells as strips squared.
STRIP = 1 << 18
#: So many places and corners for each strip are looked at to say where strips begin; that decides no sum.
SAMPLED = 100
#: Nodes that a task deals out at once.
CHUNK = 1 << 19

_WHOLE = {"tinyint", "smallint", "int", "bigint"}
_ROWS, _COLUMNS = 0, 1


def sums_in_boxes(nodes: DataFrame, boxes: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """``box, n`` and a sum over its nodes for each of ``totals``, of ``boxes`` (box, south, west, north, east) that hold any.

    Boxes do not cross the 180th meridian; those of the same ``box`` are summed together. Totals are whole numbers, of which
    null counts as 0 and whose amounts must have a sum over all nodes that fits a bigint.

    Each node is dealt out twice and each box in four corners, however many nodes a box holds. Nodes of one
    place are summed as they are dealt out, and strips are cut within a latitude or longitude too, so neither makes a strip long;
    only boxes that are all alike meet in one task.
    """
    if wrong := [f"{c}: {t}" for c, t in nodes.select(*(c.alias(n) for n, c in totals.items())).dtypes if t not in _WHOLE]:
        raise TypeError(f"totals must be whole numbers: {', '.join(wrong)}")
    names = [f"v{i}" for i in range(len(totals) + 1)]
    values = [F.lit(1).cast("long"), *(F.coalesce(c.cast("long"), F.lit(0)) for c in totals.values())]
    places = written(nodes.select(F.col(S.LATITUDE).alias("y"), F.col(S.LONGITUDE).alias("x"), *(v.alias(n) for v, n in zip(values, names))), "box-nodes")
    ends = boxes.where("west <= east").select("box", *(F.col(c).cast("double").alias(c) for c in ("south", "west", "north", "east")))
    box = StructField("box", ends.schema["box"].dataType)
    corners = written(ends.mapInArrow(_corners, StructType([box]).add("y", "long").add("x", "long").add("sign", "long")), "box-corners")

    n, *amounts = places.agg(F.count("*"), *(F.try_sum(F.abs(v)) for v in names)).first()
    if n and None in amounts:
        raise OverflowError("the sum of a total over all nodes does not fit a bigint")
    rows, columns = _bounds_of(places, corners, n + corners.count())

    dealt = places.mapInArrow(_dealt(rows, columns, names), "axis int, strip int, a array<bigint>, b array<bigint>, " + ", ".join(f"{v} array<bigint>" for v in names))
    placed = corners.mapInArrow(_placed(rows, columns), StructType([*corners.schema]).add("row", "integer").add("col", "integer"))
    asked = placed.select(F.lit(_ROWS).alias("axis"), F.col("row").alias("strip"), "box", "sign", F.col("y").alias("a"), F.col("x").alias("b")).unionByName(
        # Of its column, the rows before its own.
        placed.select(F.lit(_COLUMNS).alias("axis"), F.col("col").alias("strip"), "box", "sign", (F.col("row") - 1).cast("long").alias("a"), F.col("x").alias("b"))
    )
    found = StructType([box]).add("row", "integer").add("col", "integer")
    for v in names:
        found = found.add(v, "long")
    met = written(dealt.groupBy("axis", "strip").cogroup(asked.groupBy("axis", "strip")).applyInArrow(_met(names), found), "box-sums")

    sums = met.where("row IS NULL").select("box", *names)
    if len(rows) and len(columns):
        before = _before(met.where("row IS NOT NULL").drop("box"), len(rows) + 1, len(columns) + 1, names)
        sums = sums.unionByName(placed.join(before, ["row", "col"]).select("box", *((F.col("sign") * F.col(v)).alias(v) for v in names)))
    summed = sums.groupBy("box").agg(*(F.sum(v).alias(v) for v in names)).where(F.col(names[0]) > 0)
    return summed.select("box", *(F.col(v).alias(name) for v, name in zip(names, ["n", *totals])))


def _before(cells: DataFrame, n_rows: int, n_columns: int, names: list[str]) -> DataFrame:
    """For every cell the sums of those in rows and columns before its own."""
    every = cells.sparkSession.range(n_rows * n_columns).selectExpr(f"cast(id div {n_columns} AS int) AS row", f"cast(id % {n_columns} AS int) AS col")
    grid = every.join(cells, ["row", "col"], "left")
    for along, by in (("row", "col"), ("col", "row")):
        others = Window.partitionBy(along).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        grid = grid.select("row", "col", *(F.coalesce(F.sum(v).over(others), F.lit(0)).alias(v) for v in names))
    return grid


def _bounds_of(places: DataFrame, corners: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where rows and where columns begin, but for the first."""
    strips = max(1, -(-n // STRIP))
    y, x = np.zeros((2, 0), np.int64)
    if strips > 1:
        of_places, of_corners = (df.select("y", "x").sample(min(1.0, SAMPLED * strips / n), 0).collect() for df in (places, corners))
        y, x = np.concatenate((_ranks(np.array(of_places, float).reshape(-1, 2)), np.array(of_corners, np.int64).reshape(-1, 2))).T
    return _bounds(y, x, strips), _bounds(x, y, strips)


def _bounds(a: np.ndarray, b: np.ndarray, strips: int) -> np.ndarray:
    keys = np.sort(_pairs(a, b))
    return np.unique(keys[np.arange(1, strips) * len(keys) // strips]) if len(keys) else keys


def _ranks(degrees: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of ``degrees`` as Spark has it, NaN last; none lies between a number's and the next one's."""
    bits = (np.where(np.isnan(degrees), np.nan, degrees) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of numbers as bytes, in the order of ``a``, then ``b``."""
    pairs = np.empty((len(a), 2), ">i8")
    pairs[:, 0], pairs[:, 1] = a, b
    pairs.view(np.uint8)[:, ::8] ^= 128  # negative ones first
    return pairs.view("S16").ravel()


def _corners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The corners of boxes, in ranks; what a corner stands for lies at most as high and as far right."""
    for batch in batches:
        south, west, north, east = (_ranks(batch[c].to_numpy(zero_copy_only=False)) for c in ("south", "west", "north", "east"))
        for y, x, sign in ((north, east, 1), (south - 1, east, -1), (north, west - 1, -1), (south - 1, west - 1, 1)):
            yield pa.RecordBatch.from_arrays([batch["box"], pa.array(y), pa.array(x), pa.array(np.full(len(y), sign))], ["box", "y", "x", "sign"])


def _placed(rows: np.ndarray, columns: np.ndarray) -> Callable:
    """A function that adds the row and the column of corners."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, x = (batch[c].to_numpy(zero_copy_only=False) for c in ("y", "x"))
            for name, bounds, pairs in (("row", rows, _pairs(y, x)), ("col", columns, _pairs(x, y))):
                batch = batch.append_column(name, pa.array(np.searchsorted(bounds, pairs, side="right").astype(np.int32)))
            yield batch

    return place


def _dealt(rows: np.ndarray, columns: np.ndarray, names: list[str]) -> Callable:
    """A function that deals places out to their row as ``y, x`` and to their column as row, ``x``."""

    def strips(axis, a, b, values, cuts):
        used = np.flatnonzero(np.diff(cuts))
        offsets = pa.array(np.append(cuts[used], cuts[-1]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (a, b, *values)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(used), axis, np.int32)), pa.array(used.astype(np.int32)), *lists], ["axis", "strip", "a", "b", *names])

    def cuts(pairs, bounds):
        return np.concatenate(([0], np.searchsorted(pairs, bounds), [len(pairs)]))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            y, x, *values = (chunk[c].to_numpy() for c in ("y", "x", *names))
            y, x = _ranks(y), _ranks(x)
            pairs = _pairs(y, x)
            order = np.argsort(pairs)
            pairs = pairs[order]
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))  # of each place
            y, x = y[order[first]], x[order[first]]
            values = [np.add.reduceat(v[order], first) for v in values]
            by_row = cuts(pairs[first], rows)
            yield strips(_ROWS, y, x, values, by_row)
            row = np.repeat(np.arange(len(by_row) - 1), np.diff(by_row))
            pairs = _pairs(x, y)
            order = np.argsort(pairs)
            yield strips(_COLUMNS, row[order], x[order], [v[order] for v in values], cuts(pairs[order], columns))

    return deal


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    waiting, n = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            n += batch.num_rows
        if n >= CHUNK:
            yield pa.Table.from_batches(waiting)
            waiting, n = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _met(names: list[str]) -> Callable:
    """A function that sums the places of a strip below its corners, and those of a column by row (``row, col``, no box)."""

    def meet(key: tuple[pa.Scalar, ...], places: pa.Table, corners: pa.Table) -> pa.Table:
        axis, strip = (k.as_py() for k in key)
        a, b, *values = (pc.list_flatten(places[c]).to_numpy() for c in ("a", "b", *names))
        sums = sums_below(a, b, np.array(values), corners["a"].to_numpy(), corners["b"].to_numpy()) * corners["sign"].to_numpy()
        own = np.unique(a) if axis == _COLUMNS else a[:0]
        cells = np.zeros((len(names), len(own)), np.int64)
        if len(own):
            for of_cells, v in zip(cells, values):
                np.add.at(of_cells, np.searchsorted(own, a), v)
        box = corners["box"].combine_chunks()
        nothing = pa.nulls(len(box), pa.int32())
        columns = {
            "box": pa.concat_arrays([box, pa.nulls(len(own), box.type)]),
            "row": pa.concat_arrays([nothing, pa.array(own.astype(np.int32))]),
            "col": pa.concat_arrays([nothing, pa.array(np.full(len(own), strip, np.int32))]),
        }
        return pa.table(columns | {name: np.concatenate(v) for name, *v in zip(names, sums, cells)})

    return meet


def sums_below(a: np.ndarray, b: np.ndarray, values: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """For each corner, the sums of ``values`` (a row for each) of points with ``a <= at_a`` and ``b <= at_b``.

    Points lie in the order of ``a``, of which a corner has the first few. Bit by bit of the rank of ``b``, those
    without it go before those with it, each in their order; a corner whose rank has the bit takes all its points without it.
    """
    levels, level = np.unique(at_b, return_inverse=True)
    rank, limit = np.searchsorted(levels, b), level + 1  # b <= levels[k] for ranks up to k
    order = np.argsort(a, kind="stable")
    start, stop = np.zeros(len(at_a), np.int64), np.searchsorted(a[order], at_a, side="right")
    found = np.zeros((len(values), len(at_a)), np.int64)
    for bit in reversed(range(len(levels).bit_length())):
        rank, values = rank[order], values[:, order]
        has, wants = (rank >> bit & 1).astype(bool), (limit >> bit & 1).astype(bool)
        before = np.append(0, np.cumsum(~has))
        for own, v in zip(found, values):
            sums = np.append(0, np.cumsum(np.where(has, 0, v)))
            own += np.where(wants, sums[stop] - sums[start], 0)
        start, stop = (np.where(wants, before[-1] + i - before[i], before[i]) for i in (start, stop))
        order = np.concatenate((np.flatnonzero(~has), np.flatnonzero(has)))
    return found
