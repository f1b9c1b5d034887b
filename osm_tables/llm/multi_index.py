"""Nearest rows by inner product, through an inverted multi-index.

Vectors are cut into two halves, and each half has a codebook of its own, fitted by k-means to a bounded sample
(`SAMPLE` rows, those with the smallest hashed ids; every row is indexed). A row lies in the cell of its two nearest
centroids. What a cell can offer to a query is the sum of two numbers, one from each half: the inner product with the
centroid, and `slack` times the query's length times the radius of the centroid's rows. A heap walks the pairs of
centroids by falling sum, from the best.

A search has two rounds. In the first, each query opens cells until they hold `OPENED` rows, and the entries of these
cells are reranked; the k-th best score is the query's floor. In the second it opens all further cells whose offer
reaches the floor. So no number of candidates is fixed: with ``slack=1`` the offer is a bound (Cauchy-Schwarz) and
results are exact; smaller values skip cells whose rows would all have to point the query's way.

Entries lie in pages of about `PAGE` rows: small neighbouring cells share one, a large cell (such as that of a vector
that a third of the rows repeat) is dealt out by hash over as many as it needs. A query goes once to each page in which it
opens a cell, with the list of these cells; pages meet their queries in chunks of `CHUNK`, and each meeting passes on
the `k` best of each query at most, and none below its floor.

Scores are sums of products in double precision in the order of the components, so that equal vectors score equally
wherever they lie, and ties go to the smaller id. The query's own row, told by its id, is no candidate.

Odd rows: a null id, a null or zero vector, or one with null, NaN or infinite components takes no part; repeated rows
are candidates of their own; query rows that share an id are answered as one, with the best of all their vectors; a
query with fewer than k candidates gets them all; an empty table gives no rows. Vectors of different lengths are an
error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from osm_tables.llm.shared import cut, groups, written
from osm_tables.llm.vector_codes import finite

NEAREST, SLACK = 20, 0.4
#: Rows that the codebooks are fitted to, rounds of fitting, rows of a cell aimed at, and centroids of a half at most.
SAMPLE, FITTED, CELL, CENTROIDS = 32_768, 8, 128, 256
#: Rows that a query's first cells hold together; rows of a page; queries that meet a page at once.
OPENED, PAGE, CHUNK = 400, 4096, 512


@dataclass
class Index:
    """Codebooks, radii, and where each cell's rows are: bounded by parameters, whatever the table."""

    halves: list[np.ndarray]  # centroids x width, for each half
    radii: list[np.ndarray]
    counts: np.ndarray  # rows of each cell
    first_page: np.ndarray  # of each cell
    pages: np.ndarray  # that the cell is dealt over
    entries: DataFrame  # page, cell, id, vector

    @property
    def split(self) -> int:
        return self.halves[0].shape[1]


def _fit(points: np.ndarray, count: int) -> np.ndarray:
    """k-means, begun at rows spread over the sample; a centroid without rows stays where it is."""
    points = np.unique(points, axis=0)
    count = min(count, len(points))
    centres = points[np.random.default_rng(11).permutation(len(points))[:count]]
    for _ in range(FITTED):
        at = _nearest(points, centres)
        n = np.bincount(at, minlength=count)
        total = np.zeros_like(centres)
        np.add.at(total, at, points)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if not np.all(np.diff(column.offsets.to_numpy()) == width):
        raise ValueError(f"vectors must all have {width} components")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def build(kept: DataFrame) -> Index | None:
    """Every row of ``kept`` (id, vector) in its cell and page; None if there are no rows."""
    sample = kept.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().column(0).combine_chunks()
    if not len(sample):
        return None
    width = len(sample[0])
    points, split = _matrix(sample, width), width // 2
    most = int(min(CENTROIDS, max(1, np.ceil(np.sqrt(kept.count() / CELL)))))
    halves = [_fit(points[:, :split], most), _fit(points[:, split:], most)]
    across = len(halves[1])

    def place(batches):
        for batch in batches:
            points = _matrix(batch.column(1), width)
            near = [_nearest(points[:, :split], halves[0]), _nearest(points[:, split:], halves[1])]
            off = [np.linalg.norm(p - h[n], axis=1) for p, h, n in zip((points[:, :split], points[:, split:]), halves, near, strict=True)]
            cell = pa.array(near[0] * across + near[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cell, pa.array(off[0]), pa.array(off[1])],
                                             ["id", "vector", "cell", "off0", "off1"])

    schema = f"id {kept.schema['id'].dataType.simpleString()}, vector {kept.schema['vector'].dataType.simpleString()}, cell int, off0 double, off1 double"
    placed = written(kept.mapInArrow(place, schema), "placed")
    found = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("off0").alias("off0"), F.max("off1").alias("off1")).toArrow()
    cells = found.column("cell").to_numpy()  # as many as there are cells at most
    radii = [np.zeros(len(halves[0])), np.zeros(across)]
    np.maximum.at(radii[0], cells // across, found.column("off0").to_numpy())
    np.maximum.at(radii[1], cells % across, found.column("off1").to_numpy())
    counts = np.zeros(len(halves[0]) * across, np.int64)
    counts[cells] = found.column("n").to_numpy()
    first_page, pages = _pages(counts)
    in_page = _lookup("cell", first_page) + F.pmod(F.xxhash64("id"), _lookup("cell", pages)).cast("int")
    return Index(halves, radii, counts, first_page, pages, placed.select(in_page.alias("page"), "cell", "id", "vector"))


def _lookup(column: str, values: np.ndarray) -> Column:
    return F.element_at(F.lit(values.tolist()).cast("array<int>"), F.col(column) + 1)


def _pages(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, pages = np.zeros(len(counts), np.int32), np.ones(len(counts), np.int32)
    page, held = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > PAGE:
            page, held = page + 1, 0
        first[cell], pages[cell] = page, max(1, -(-n // PAGE))
        held += n
        if pages[cell] > 1:
            page, held = page + int(pages[cell]), 0
    return first, pages


class Walk:
    """The cells of an index from the most to the least promising for one query."""

    def __init__(self, index: Index, query: np.ndarray, slack: float):
        parts = query[: index.split], query[index.split :]
        length = float(np.sqrt((query * query).sum()))
        offers = [h @ q + slack * np.sqrt((q * q).sum()) * r for h, q, r in zip(index.halves, parts, index.radii, strict=True)]
        self.order = [np.argsort(-o, kind="stable").tolist() for o in offers]
        self.offers = [np.sort(-o, kind="stable").tolist() for o in offers]
        self.across, self.margin = len(index.halves[1]), 1e-9 * max(1.0, length)

    def __iter__(self) -> Iterator[tuple[float, int]]:
        a, b = self.offers
        heap = [(a[0] + b[0], 0, 0)]
        while heap:
            offer, i, j = heapq.heappop(heap)
            yield -offer, self.order[0][i] * self.across + self.order[1][j]
            if j + 1 < len(b):  # a pair is reached along its row, and each row from the row before
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def opened(index: Index, query: np.ndarray, slack: float, floor: float | None) -> list[int]:
    """The cells with rows that a query opens: first (no floor) or thereafter."""
    held, out = 0, []
    counts, walk = index.counts, Walk(index, query, slack)
    for offer, cell in walk:
        if floor is not None and offer < floor - walk.margin:
            break
        first = held < OPENED
        held += int(counts[cell])
        if floor is None and not first:
            break
        if first == (floor is None) and counts[cell]:
            out.append(cell)
    return out


def _probes(index: Index, queries: DataFrame, slack: float) -> DataFrame:
    """``page, query, vector, floor, cells``: queries (with column ``floor``) at each page in which they open cells."""
    bare = Index(index.halves, index.radii, index.counts, index.first_page, index.pages, None)
    shared = queries.sparkSession.sparkContext.broadcast(bare)
    width = sum(h.shape[1] for h in index.halves)

    def walk(batches):
        index = shared.value
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            for i, floor in enumerate(batch.column(2).to_pylist()):
                at: dict[int, list[int]] = {}
                for cell in opened(index, vectors[i], slack, floor):
                    for page in range(index.first_page[cell], index.first_page[cell] + index.pages[cell]):
                        at.setdefault(int(page), []).append(cell)
                if at:
                    same = pa.array(np.full(len(at), i))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(at), pa.int32()), batch.column(0).take(same), batch.column(1).take(same), batch.column(2).take(same),
                         pa.array(list(at.values()), pa.list_(pa.int32()))], ["page", "query", "vector", "floor", "cells"])

    kind = queries.schema
    schema = f"page int, query {kind['id'].dataType.simpleString()}, vector {kind['vector'].dataType.simpleString()}, floor double, cells array<int>"
    return queries.select("id", "vector", "floor").mapInArrow(walk, schema)


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, each summed in the order of its components."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d] * right[:, d]
    return total


def _met(probes: pa.Table, page: pa.Table, k: int, width: int) -> pa.Table:
    """The k best of each query among the entries of the cells that it opened in a page, no one below its floor."""
    order = page.sort_by("cell")
    cells, ids = order.column("cell").to_numpy(), order.column("id").combine_chunks()
    names = ids.to_numpy(zero_copy_only=False)
    entries, queries = (_matrix(t.column("vector").combine_chunks(), width) for t in (order, probes))
    own = probes.column("query").to_numpy()
    floors = np.nan_to_num(probes.column("floor").fill_null(-np.inf).to_numpy(), nan=-np.inf)
    near = np.full((len(queries), len(entries)), -np.inf)
    listed = probes.column("cells").combine_chunks()
    rows, wanted = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy())), listed.flatten().to_numpy()
    by_cell = np.argsort(wanted, kind="stable")
    for some in np.split(by_cell, np.flatnonzero(np.diff(wanted[by_cell])) + 1):
        begin, end = np.searchsorted(cells, [wanted[some[0]], wanted[some[0]] + 1])
        near[rows[some], begin:end] = queries[rows[some]] @ entries[begin:end].T
    near[own[:, None] == names[None, :]] = -np.inf
    # Products of matrices may round otherwise than the scores: nothing within the margin is left out.
    margin = 1e-9 * np.maximum(1.0, np.abs(queries).max(axis=1) * max(1.0, np.abs(entries).max(initial=0.0)) * width)
    if near.shape[1] > k:
        floors = np.maximum(floors, -np.partition(-near, k - 1, axis=1)[:, k - 1])
    q, e = np.nonzero((near >= (floors - margin)[:, None]) & (near > -np.inf))
    exact = scores(queries[q], entries[e])
    order = np.lexsort((names[e], -exact, q))
    q, e, exact = q[order], e[order], exact[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    q, e, exact = (x[rank < k] for x in (q, e, exact))
    return pa.table({"query": probes.column("query").take(pa.array(q)), "id": ids.take(pa.array(e)), "score": pa.array(exact)})


def _reranked(index: Index, probes: DataFrame, k: int) -> DataFrame:
    """``query, id, score``: the best of every page and chunk of queries."""
    width = sum(h.shape[1] for h in index.halves)
    kind = index.entries.schema
    id_type, vector_type = kind["id"].dataType.simpleString(), kind["vector"].dataType.simpleString()

    def packed(rows: DataFrame, columns: str, most: int) -> DataFrame:
        """One row for each page (or part of it) with its rows as an Arrow stream."""

        def pack(batches):
            for table in groups(batches, ["page"]):
                page = table.column("page")[0]
                table = table.drop_columns(["page"]).combine_chunks()
                for begin in range(0, table.num_rows, most):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, table.schema) as stream:
                        stream.write_table(table.slice(begin, most).combine_chunks())
                    yield pa.RecordBatch.from_pydict({"page": pa.array([page.as_py()], pa.int32()), columns: pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        return rows.mapInArrow(pack, f"page int, {columns} binary")

    entries = packed(index.entries.repartition("page").sortWithinPartitions("page"), "entries", 2 * PAGE)
    # Queries of a page that all of them come to are dealt over several tasks.
    dealt = probes.repartition("page", F.pmod(F.xxhash64("query"), F.lit(64))).sortWithinPartitions("page")
    met = packed(dealt, "queries", CHUNK).join(entries, "page").select("queries", "entries")

    def rerank(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                read = [pa.ipc.open_stream(batch.column(c)[i].as_buffer()).read_all() for c in (0, 1)]
                yield from cut(_met(*read, k, width))

    return met.mapInArrow(rerank, f"query {id_type}, id {id_type}, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(rows: DataFrame, id_column: str, vector: str, queries: Column, k: int = NEAREST, slack: float = SLACK) -> DataFrame:
    """``query_id, rank, <id_column>, score``: for each row for which ``queries`` holds, its ``k`` nearest other rows.

    Ids may be of any type that orders; other columns of ``rows`` do not come along. Index, cells and both rounds'
    findings are tables in the shared folder, so a lost executor costs no more than a stage.
    """
    spark = rows.sparkSession
    nonzero = F.exists(vector, lambda x: x != 0)
    taking_part = F.col(f"`{id_column}`").isNotNull() & finite(vector) & nonzero
    kept = rows.where(taking_part).select(F.col(f"`{id_column}`").alias("id"), F.col(vector).alias("vector"), queries.alias("asks"))
    index = build(kept.select("id", "vector"))
    out = ["query as query_id", "rank", f"id as `{id_column}`", "score"]
    if index is None:
        kind = kept.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"query {kind}, rank int, id {kind}, score double").selectExpr(*out)
    asked = kept.where("asks").select("id", "vector").distinct()
    first = written(_best(_reranked(index, _probes(index, asked.withColumn("floor", F.lit(None).cast("double")), slack), k), k), "nearest")
    # The k-th best so far; a query that has not found so many opens every cell.
    floors = first.where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").alias("floor"))
    again = asked.join(floors, "id", "left").fillna(float("-inf"), ["floor"])
    more = _reranked(index, _probes(index, again, slack), k)
    return _best(first.drop("rank").unionByName(more), k).selectExpr(*out)
