"""How far sources of a language differ in their words: every pair of sources, and each source's own words.

Counts become levels: terms that a group (one source of one language) holds equally often share one probability there.
A page of terms is written as a matrix of indicator columns, one for each group and level that occurs, with a single
one in each row and group. The product of the transpose with the matrix holds all joint tables of the page at once,
that is, for two groups and two levels the number of terms at both; each entry is then priced once, times its number.
Products have a bounded number of columns and are made in float32, in which sums of ones are exact as long as a page
has fewer than 2**24 terms; probabilities and prices are whole numbers, exact in 64 bits.

Spark deals the work: terms are counted per task and added up by one shuffle, pages gather terms of like frequency
(so that they have few levels), sources are cut into blocks, and a task multiplies one page of two blocks. So no task
holds all sources or all terms, whatever their number, and a source with a third of the rows is only a column.

Odd rows: null text, language or source are empty strings; a document without terms still makes its group occur; a
repeated row is a document of its own; very long texts are counted in slices; ties go by name; an empty table gives no
rows; a language without kept terms has pairs of value 0; a language with one source has no pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from osm_tables.llm.shared import cut, written

#: Fixed: documents that keep a term, parts that probabilities are told in, occurrences given beforehand, ranks.
LEAST_DOCUMENTS, WHOLE, BEFOREHAND, RANKS = 10, 1_000_000_000, 2, 10
#: So many groups (or bands of a language) at most are sent to all tasks (a name and five numbers each); more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


@dataclass(frozen=True)
class Sizes:
    """What bounds the memory of a task; results do not depend on it."""

    page: int = 2048  # terms multiplied at once, as hashed
    block: int = 32  # sources
    columns: int = 1024  # indicator columns of one product
    held: int = 400_000  # different terms of groups that are counted before they are passed on
    slice: int = 1 << 20  # bytes of a text


SIZES = Sizes()

# Letters stay (A-Z in lower case) and so does every byte of other alphabets; the rest of ASCII parts terms.
_FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def term_counts(text: bytes, slice_bytes: int = SIZES.slice) -> Counter:
    """Occurrences of each term, from UTF-8; a long text is taken in slices that end between terms."""
    found: Counter = Counter()
    begin = 0
    while begin < len(text):
        end = min(len(text), begin + slice_bytes)
        while end < len(text) and _FOLD[text[end]] != 0x20:
            end += 1
        found.update(text[begin:end].translate(_FOLD).split())
        begin = end
    return found


def _counted(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences and documents, added up within the task as far as memory allows."""
    held: dict[tuple, dict[bytes, list]] = {}
    size = 0

    def out():
        for (lang, source), found in held.items():
            yield from cut(pa.table({
                "lang": pa.array([lang] * len(found), pa.string()), "source": pa.array([source] * len(found), pa.string()),
                "term": pa.array(list(found), pa.binary()).cast(pa.string()),
                "n": pa.array([x[0] for x in found.values()], pa.int64()), "docs": pa.array([x[1] for x in found.values()], pa.int64()),
            }))

    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        for i, (lang, source) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            group = held.setdefault((lang, source), {})
            size -= len(group)
            for term, n in term_counts(texts[i].as_py(), sizes.slice).items():
                x = group.get(term)
                if x is None:
                    group[term] = [n, 1]
                else:
                    x[0] += n
                    x[1] += 1
            size += len(group)
            if size >= sizes.held:
                yield from out()
                held, size = {}, 0
    yield from out()


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def joint_values(left: np.ndarray, right: np.ndarray, columns: int = SIZES.columns) -> np.ndarray:
    """Sum over rows of the price of every column of ``left`` against every column of ``right``.

    Both are terms x groups, of probabilities; rows are halved until the indicator columns fit one product.
    """
    if len(left) > 1 and max(_levels(left), _levels(right)) > columns:
        half = len(left) // 2
        upper, lower = left[:half], left[half:]
        if left is right:
            return joint_values(upper, upper, columns) + joint_values(lower, lower, columns)
        return joint_values(upper, right[:half], columns) + joint_values(lower, right[half:], columns)
    x, x_group, x_level = _indicators(left)
    y, y_group, y_level = (x, x_group, x_level) if left is right else _indicators(right)
    joint = x.T @ y
    a, b = np.nonzero(joint)
    out = np.zeros(left.shape[1] * right.shape[1], np.int64)
    np.add.at(out, x_group[a] * right.shape[1] + y_group[b], joint[a, b].astype(np.int64) * price(x_level[a], y_level[b]))
    return out.reshape(left.shape[1], right.shape[1])


def _levels(matrix: np.ndarray) -> int:
    ordered = np.sort(matrix, axis=0)
    return int((ordered[1:] != ordered[:-1]).sum()) + matrix.shape[1]


def _indicators(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The one-hot matrix of terms x (group, level), and the group and probability of each of its columns."""
    groups, levels, places = [], [], np.zeros(matrix.shape, np.int64)
    begin = 0
    for g in range(matrix.shape[1]):
        found, at = np.unique(matrix[:, g], return_inverse=True)
        places[:, g] = begin + at
        groups.append(np.full(len(found), g))
        levels.append(found)
        begin += len(found)
    hot = np.zeros((len(matrix), begin), np.float32)
    hot[np.arange(len(matrix))[:, None], places] = 1
    return hot, np.concatenate(groups), np.concatenate(levels)


def _page(cells: pa.Table, block: int, terms: int) -> np.ndarray:
    """Terms x groups of a block: what a group gives to a term it lacks, and then what it gives to those it has."""
    at, slot, p = (cells.column(c).to_numpy()[cells.column("block").to_numpy() == block] for c in ("at", "slot", "p"))
    none = at < 0
    matrix = np.empty((terms, int(none.sum())), np.int64)
    matrix[:, slot[none]] = p[none]
    matrix[at[~none], slot[~none]] = p[~none]
    return matrix


def _multiplied(key: tuple, cells: pa.Table, sizes: Sizes) -> pa.Table:
    """The values of all pairs of groups of two blocks, over one page."""
    lang, low, high = key[0].as_py(), key[3].as_py(), key[4].as_py()
    terms = cells.column("terms")[0].as_py()
    left = _page(cells, low, terms)
    right = left if low == high else _page(cells, high, terms)
    values = joint_values(left, right, sizes.columns)
    a, b = np.indices(values.shape).reshape(2, -1)
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(low * sizes.block + a, pa.int64()),
        "b": pa.array(high * sizes.block + b, pa.int64()), "value": pa.array(values.ravel(), pa.int64()),
    })


def _probability(count: str, total: str, kept: str):
    """What a group with ``total`` occurrences of ``kept`` terms gives to one with ``count``; decimals do not overflow."""
    share = f"cast({count} + {BEFOREHAND} as decimal(20, 0)) * cast({WHOLE} as decimal(10, 0))"
    return F.expr(f"1L + {share} div cast({total} + {BEFOREHAND} * {kept} as decimal(20, 0))")


def _price(p: str, q: str):
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", sizes: Sizes = SIZES) -> DataFrame:
    """``lang, source, part, item, value, rank`` of the whole table; other columns are not looked at.

    Part ``pair`` has one row for every two sources of a language, both ways; its value is the sum over all kept terms
    (those in at least `LEAST_DOCUMENTS` documents of the language) of ``(p - q)**2 // (p + q)``. Part ``term`` has
    the `RANKS` terms in which a source lies furthest above its language. Ranks go by falling value, then by item.
    """
    named = ((text, "text"), (lang, "lang"), (source, "source"))
    docs = df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in named))
    found = docs.mapInArrow(partial(_counted, sizes=sizes), "lang string, source string, term string, n long, docs long")
    # A term of a language has one row for each source: one shuffle serves the sums and the windows over them.
    of_term = Window.partitionBy("lang", "term")
    counts = (
        found.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns({"docs": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term), "first": F.min("source").over(of_term)})
        .where(F.col("docs") >= LEAST_DOCUMENTS)
        .select("lang", "term", "source", "n", "total", (F.col("first") == F.col("source")).alias("lead"))
    )
    counts = written(counts, "term-counts")
    places = written(_placed(counts.where("lead"), sizes.page), "term-places")
    groups = written(_groups(docs, counts), "groups")
    small = groups.count() <= BROADCAST_GROUPS
    near = F.broadcast if small else (lambda x: x)

    priced = counts.join(near(groups), ["lang", "source"]).withColumn("p", _probability("n", "held", "kept"))
    values = _pair_values(priced, places, groups, near, sizes)
    a = groups.select("lang", "source", F.col("slot").alias("a"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("slot").alias("b"))
    pairs = a.join(near(b), "lang").where("a <> b").join(values, ["lang", "a", "b"], "left")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    above = priced.withColumn("q", _probability("total", "all_held", "kept")).where("p > q")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _price("p", "q").alias("value"))
    rank = F.row_number().over(by_value).alias("rank")
    return pairs.select("*", rank).unionByName(above.select("*", rank).where(F.col("rank") <= RANKS))


def _placed(terms: DataFrame, size: int) -> DataFrame:
    """``lang, term, band, page, at, terms``: pages of terms whose frequencies share a power of two."""
    terms = terms.select("lang", "term", F.floor(F.log2("total")).cast("int").alias("band"))
    pages = written(terms.groupBy("lang", "band").agg(F.ceil(F.count("*") / size).cast("int").alias("pages")), "bands")
    pages = F.broadcast(pages) if pages.count() <= BROADCAST_GROUPS else pages
    page = F.pmod(F.xxhash64("term"), F.col("pages")).cast("int").alias("page")
    paged = terms.join(pages, ["lang", "band"]).select("lang", "band", page, "term")
    own = Window.partitionBy("lang", "band", "page")
    return paged.select("*", (F.row_number().over(own.orderBy("term")) - 1).alias("at"), F.count("*").over(own).cast("int").alias("terms"))


def _groups(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Every group that occurs: its number in its language, occurrences of kept terms (its own and its language's)
    and how many terms are kept."""
    seen = docs.select("lang", "source").distinct()
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"), F.count_if("lead").alias("led"))
    of_lang = Window.partitionBy("lang")  # one row for each source
    known = seen.join(held, ["lang", "source"], "left").fillna(0, ["held", "led"])
    return known.select(
        "lang", "source", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("slot"), "held",
        F.sum("held").over(of_lang).alias("all_held"), F.sum("led").over(of_lang).alias("kept"),
    )


def _pair_values(priced: DataFrame, places: DataFrame, groups: DataFrame, near, sizes: Sizes) -> DataFrame:
    """``lang, a, b, value`` for every two groups of a language with kept terms, by their numbers."""
    block = F.floor(F.col("slot") / sizes.block).cast("int")
    cells = priced.join(places, ["lang", "term"]).select("lang", "band", "page", "terms", "slot", "at", "p")
    none = groups.where("kept > 0").withColumn("p", _probability("0L", "held", "kept"))
    pages = places.groupBy("lang", "band", "page").agg(F.max("terms").alias("terms"))
    empty = pages.join(near(none), "lang").select("lang", "band", "page", "terms", "slot", F.lit(-1).alias("at"), "p")
    blocks = groups.groupBy("lang").agg(F.max(block).alias("last"))
    cells = cells.unionByName(empty).join(near(blocks), "lang")
    # Each block meets every block of its language once.
    cells = cells.select("lang", "band", "page", "terms", block.alias("block"), (F.col("slot") % sizes.block).cast("int").alias("slot"), "at", "p",
                         F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    cells = cells.select("lang", "band", "page", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         "terms", "block", "slot", "at", "p")

    def multiplied(key, table):  # as a function with two parameters, which is how Spark tells that it takes the key
        return _multiplied(key, table, sizes)

    found = cells.groupBy("lang", "band", "page", "low", "high").applyInArrow(multiplied, "lang string, a long, b long, value long")
    half = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # A block with itself gives both ways, two blocks give one.
    mirrored = half.where(F.floor(F.col("a") / sizes.block) != F.floor(F.col("b") / sizes.block))
    return half.unionByName(mirrored.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
