"""Near copies: Jaccard similarity of word shingles by a MinHash LSH forest, verified exactly.

A text is the set of its runs of five words (A-Z lower-cased); a shorter text is one run of all its
words. Equal sets are one *class* from the start, so copies never meet each other again.

* **Forest.** Every set gets ``trees * depth`` MinHash values; each tree sorts sets by a sequence of
  ``depth`` of them. The prefix by which sets are looked up is shortened, in all trees together,
  from the full depth until a pair at the threshold shares a prefix in some tree with probability
  ``recall``: ``1 - (1 - t**length)**trees``. Sets that share a prefix are candidates; their
  signatures of one byte a value weed out pairs that are far away.
* **Verification.** Connected candidates form clusters. Within a cluster every pair is counted
  exactly on the shingles themselves. Buckets and clusters of any size are dealt out in blocks: a
  task gets two blocks of at most about ``BLOCK`` sets, so no group is collected whole, and a pair of
  blocks gives a row or two per set, never a row per pair.
* **Classes.** Connected components of the verified links.

Words and shingles are 64-bit hashes; so are sets, as the sum of their mixed shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from osm_tables.llm import shared
from osm_tables.llm.text import flat, mix, per_text, slices, word_hashes

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 6
RECALL = 0.9999
BLOCK = 512
#: Shingles of a block together, about; more blocks are made where texts are long.
BLOCK_SHINGLES = 400_000
#: A set with more than this part of the rows, 1 / HOT, is one of many copies.
HOT = 1000
#: A pair's signatures must agree in this part of the threshold; a pair at the threshold fails by 5 sigma.
_ROUGH = 0.75

_ROLL = mix(np.arange(1, 33, dtype=np.uint64))
_SEEDS = np.random.default_rng(7).integers(1, 2**63, (2, 4096), dtype=np.uint64)


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold is found with probability ``recall``."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError(f"{trees} trees cannot reach a recall of {recall} at a similarity of {threshold}")


def shingles(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted, and their number."""
    hashes, counts = word_hashes(data, at)
    begins = np.cumsum(counts) - counts
    n = np.where(counts >= words, counts - (words - 1), counts > 0)
    text = np.repeat(np.arange(len(counts)), n)
    first = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + begins[text]
    found = np.zeros(len(text), np.uint64)
    last = (begins + counts)[text]
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    for k in range(words):
        found += np.where(first + k < last, padded[first + k] * (_ROLL[k] | np.uint64(1)), np.uint64(0))
    found = mix(found)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.bincount(text[new], minlength=len(counts))


def set_ids(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return mix(per_text(mix(found + np.uint64(11)), counts) + counts.astype(np.uint64)).view(np.int64)


def signatures(found: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of each set that has shingles."""
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    out = np.empty((n, int(full.sum())), np.uint64)
    if len(starts):
        for k in range(n):
            out[k] = np.minimum.reduceat((found ^ _SEEDS[1, k]) * (_SEEDS[0, k] | np.uint64(1)) >> np.uint64(24), starts)
    return out


def features(docs: DataFrame, *, words: int, trees: int, length: int) -> DataFrame:
    """For each row: doc_id, text_id, set_id and n shingles, signature, and a prefix key for each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(1000003))
        for batch in batches:
            data, at = flat(batch.column(2))
            for b, e in slices(at):
                found, counts = shingles(data[at[b] : at[e]], at[b : e + 1] - at[b], words)
                sign = signatures(found, counts, trees * length)
                full = np.flatnonzero(counts > 0)
                keys = np.empty((len(full), trees), np.uint64)
                for tree in range(trees):
                    h = np.full(len(full), salt[tree])
                    for k in range(length):
                        h = mix(h ^ sign[tree * length + k])
                    keys[:, tree] = h
                ends = np.zeros(e - b + 1, np.int64)
                ends[1:] = np.cumsum((counts > 0) * trees)
                low = iter(np.ascontiguousarray((sign >> np.uint64(9)).astype(np.uint8).T))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(b, e - b),
                        batch.column(1).slice(b, e - b),
                        pa.array(set_ids(found, counts)),
                        pa.array(counts.astype(np.int64)),
                        pa.array([next(low).tobytes() if c else None for c in counts], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel().view(np.int64))),
                    ],
                    ["doc_id", "text_id", "set_id", "n", "sign", "keys"],
                )

    schema = "doc_id bigint, text_id bigint, set_id bigint, n bigint, sign binary, keys array<bigint>"
    return docs.select("doc_id", _text_id(), "text").mapInArrow(run, schema)


def _text_id():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_id")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it is connected with.

    Stars: neighbours larger than a node are tied to its smallest neighbour, then smaller ones to
    the smallest, until nothing changes; the rounds grow with the logarithm of the longest path.
    """
    edges = shared.checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = shared.checkpointed(small.select("e.*").where("a != b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _blocks(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in."""
    own = F.pmod(F.xxhash64("set_id"), F.col(blocks)).cast("int")
    rows = rows.withColumn("block", own)
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)).alias("other")
    rows = rows.select("*", other).withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    return rows.drop("other", blocks).repartition(group, "one", "two").sortWithinPartitions(group, "one", "two", "set_id")


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the smallest row that it is connected with."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(linked, label, len(label)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _across(block: np.ndarray, one: int, two: int) -> np.ndarray:
    """Pairs that a task for two blocks answers for."""
    return np.ones((len(block), len(block)), bool) if one == two else block[:, None] != block[None, :]


def _rough_links(agreement: float):
    """Edges within buckets between sets whose signatures agree well; one per set at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for group in shared.groups(batches, ["key", "one", "two"]):
            if group.num_rows < 2:
                continue
            group = group.combine_chunks()
            ids = group.column("set_id").to_numpy()
            joined = b"".join(group.column("sign").to_pylist())
            sign = np.frombuffer(joined, np.uint8).reshape(len(ids), -1)
            same = np.zeros((len(ids), len(ids)), np.uint16)
            for column in sign.T:
                same += column[:, None] == column[None, :]
            linked = (same >= agreement * sign.shape[1]) & _across(group.column("block").to_numpy(), group.column("one")[0].as_py(), group.column("two")[0].as_py())
            root = _roots(linked)
            tied = np.flatnonzero(root != np.arange(len(root)))
            done.append((ids[tied], ids[root[tied]]))
            size += len(tied)
            if size > shared.OUT_ROWS:
                yield _edge_batch(done)
                done, size = [], 0
        if done:
            yield _edge_batch(done)

    return run


def _edge_batch(done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in done])) for k in (0, 1)], ["a", "b"])


def common(found: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of ``found`` (sorted, distinct) share."""
    m = len(found)
    out = np.zeros((m, m), np.int64)
    row = np.repeat(np.arange(m), [len(x) for x in found])
    values = np.concatenate(found)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    sizes = np.diff(np.append(begins, len(values)))
    few = np.repeat((sizes > 1) & (sizes <= 8), sizes)
    v, r = values[few], row[few]
    for lag in range(1, 8):  # rare shingles pair by pair
        if lag >= len(v):
            break
        same = v[lag:] == v[:-lag]
        out += np.bincount(r[:-lag][same] * m + r[lag:][same], minlength=m * m).reshape(m, m)
    out += out.T
    often = sizes > 8  # the rest as blocks of a matrix
    r, which = row[np.repeat(often, sizes)], np.repeat(np.arange(int(often.sum())), sizes[often])
    step = max(1, 8_000_000 // m)
    for begin in range(0, int(often.sum()), step):
        part = slice(*np.searchsorted(which, [begin, begin + step]))
        held = np.zeros((m, min(step, int(often.sum()) - begin)), np.float32)
        held[r[part], which[part] - begin] = 1
        out += (held @ held.T).astype(np.int64)
    return out


def _exact_links(threshold: Fraction):
    """For each set its links in this pair of blocks (copies counted), and the smallest set it is tied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for group in shared.groups(batches, ["cluster", "one", "two"]):
            group = group.combine_chunks()
            ids, first = np.unique(group.column("set_id").to_numpy(), return_index=True)  # a repeated row comes twice
            if len(ids) < 2:
                continue
            held = group.column("held").to_pylist()
            found = [np.frombuffer(held[i], np.uint64) for i in first]
            n = np.array([len(x) for x in found])
            weight = group.column("weight").to_numpy()[first]
            shared_ = common(found)
            linked = shared_ * (threshold.denominator + threshold.numerator) >= threshold.numerator * (n[:, None] + n[None, :])
            linked &= _across(group.column("block").to_numpy()[first], group.column("one")[0].as_py(), group.column("two")[0].as_py())
            np.fill_diagonal(linked, False)
            done.append((ids, linked @ weight, ids[_roots(linked)]))
            size += len(ids)
            if size > shared.OUT_ROWS:
                yield _link_batch(done)
                done, size = [], 0
        if done:
            yield _link_batch(done)

    return run


def _link_batch(done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in done])) for k in range(3)], ["set_id", "links", "root"])


def _held_shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(0))
            for b, e in slices(at):
                found, counts = shingles(data[at[b] : at[e]], at[b : e + 1] - at[b], words)
                ends = np.concatenate(([0], np.cumsum(counts))).tolist()
                parts = pa.array([found[x:y].tobytes() for x, y in zip(ends, ends[1:])], pa.binary())
                rest = batch.slice(b, e - b)
                yield pa.RecordBatch.from_arrays([*rest.columns[1:], parts], [*rest.schema.names[1:], "held"])

    return run


def jaccard_classes(
    docs: DataFrame,
    *,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its class and its links.

    Returns doc_id, text_id (a hash of the text), set_id, n_shingles, class_key (the smallest set_id
    among the rows connected by links), class_id (the smallest doc_id among them), and n_links
    (other rows whose sets are at least ``threshold`` alike, copies included). Texts that are null or without words have no links and
    are each a class of their own. Null doc_ids take part; a class of them alone has a null id.
    Repeated rows are copies of each other. Other columns are not read.
    """
    exact = Fraction(threshold).limit_denominator(10_000)
    length = prefix_length(threshold, trees, depth, recall)
    rows = shared.written(features(docs, words=words, trees=trees, length=length), "features")
    full = rows.where("n > 0")
    first = F.min(F.struct("doc_id", "text_id")).alias("first")
    least = F.min("doc_id").alias("least")
    sets = full.groupBy("set_id").agg(F.count("*").alias("weight"), first, least, F.first("n").alias("n"), F.first("sign").alias("sign"), F.first("keys").alias("keys"))
    sets = shared.written(sets, "sets")

    spread = sets.select("set_id", F.explode("keys").alias("key"))
    buckets = spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = buckets.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    met = spread.join(buckets, "key").join(sets.select("set_id", "sign"), "set_id").select("key", "set_id", "sign", "blocks")
    rough = _blocks(met, "key", "blocks").mapInArrow(_rough_links(_ROUGH * threshold), "a bigint, b bigint")
    clusters = shared.checkpointed(components(rough).select(F.col("node").alias("set_id"), F.col("root").alias("cluster")))

    members = clusters.join(sets.select("set_id", "weight", "n", "first"), "set_id")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    members = members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    members = members.select("set_id", "cluster", "weight", "blocks", F.col("first.doc_id").alias("__doc"), F.col("first.text_id").alias("__text"))
    texts = docs.select("doc_id", _text_id(), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(members, (F.col("text_id") == F.col("__text")) & F.col("doc_id").eqNullSafe(F.col("__doc")))
    held = texts.select("text", "set_id", "cluster", "weight", "blocks").mapInArrow(
        _held_shingles(words), "set_id bigint, cluster bigint, weight bigint, blocks int, held binary"
    )
    links = _blocks(held, "cluster", "blocks").mapInArrow(_exact_links(exact), "set_id bigint, links bigint, root bigint")
    links = shared.checkpointed(links)

    tied = components(links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    tied = tied.join(sets.select(F.col("set_id").alias("node"), "least"), "node")
    ids = tied.groupBy("root").agg(F.min("least").alias("class_id"))
    tied = tied.join(ids, "root").select(F.col("node").alias("set_id"), "class_id", F.col("root").alias("class_key"))
    counted = links.groupBy("set_id").agg(F.sum("links").alias("links"))
    known = sets.select("set_id", "weight", "least").join(tied, "set_id", "left").join(counted, "set_id", "left")
    known = known.select(
        "set_id",
        "weight",
        F.coalesce("class_key", "set_id").alias("class_key"),
        F.when(F.col("class_key").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    known = shared.checkpointed(known)
    # Sets of many copies, less than HOT of them, are looked up where the rows are; the others meet by set.
    total = F.lit(full.count())
    many = known.where(F.col("weight") * HOT > total).drop("weight")
    few = known.where(F.col("weight") * HOT <= total).drop("weight")
    own = full.select("doc_id", "text_id", "set_id", "n")
    joined = own.join(F.broadcast(many), "set_id").unionByName(
        own.join(F.broadcast(many.select("set_id")), "set_id", "left_anti").join(few, "set_id")
    )
    empty = rows.where("n = 0").select("set_id", "doc_id", "text_id", "n", F.col("set_id").alias("class_key"), F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    out = joined.unionByName(empty)
    return out.select("doc_id", "text_id", "set_id", F.col("n").alias("n_shingles"), "class_key", "class_id", "n_links")


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest (doc_id, text hash).

    Texts without words all stay. Of rows that agree in doc_id and text one stays, any if their
    other columns differ. All columns pass through.
    """
    classes = jaccard_classes(docs, **parameters).where("n_shingles > 0")
    first = classes.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_id")).alias("first"))
    doc, text, mine = shared.unused(docs.columns, "__doc", "__text", "__own")
    first = first.select(F.col("first.doc_id").alias(doc), F.col("first.text_id").alias(text))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.withColumn(mine, _text_id())
    kept = own.where(worded).join(first, (F.col(mine) == F.col(text)) & F.col("doc_id").eqNullSafe(F.col(doc)))
    kept = kept.dropDuplicates([text, doc]).select(*[f"`{c}`" for c in docs.columns])
    return kept.unionByName(docs.where(~worded))
