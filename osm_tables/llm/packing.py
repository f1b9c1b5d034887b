"""Packing documents into training sequences of balanced cost.

Texts become token ids and one end id each. Attention makes a piece of ``n`` tokens cost
``linear * n + quadratic * n * n``. Pieces are dealt out in descending length: each goes to the
cheapest sequence that still has room for it. A document longer than a sequence first fills whole
sequences; one that no sequence has room for is cut over the cheapest open ones. The tokens of a
batch that fill no whole sequence go to sequences whose lengths are powers of two, which need no
padding, so no token of padding is ever added.

Ids are those of the ``tokenizers`` library at its defaults, without special tokens added: a string of
an added token in a text (``<|endoftext|>``) is that token's one id.

Every batch of tokens is packed where it was tokenized: no shuffle, and a task holds about
``batch_tokens`` ids at a time (a longer document alone). A sequence id is made of the partition and
a running number, so it is the same when a lost task is run again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 1024
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def encoder(path: str):
    """A function from a text to its ids, those of ``tokenizers`` at its defaults for a byte-level BPE file.

    Texts are cut at the strings of added tokens, each of which is one id, and what lies between is merged by
    ``tiktoken``, which has the same ids in a third of the time. A file whose added tokens take in blanks around
    them, match whole words only or lie within one another goes to ``tokenizers`` itself.
    """
    import json

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    added = {x["content"]: x["id"] for x in content["added_tokens"]}
    odd = any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in content["added_tokens"])
    plain_form = content["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if odd or content["normalizer"] or not plain_form or any(a != b and a in b for a in added for b in added):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
    merge = byte_bpe(path).encode_ordinary
    if not added:
        return merge
    parts = re.compile("|".join(map(re.escape, added)))

    def encode(text: str) -> list[int]:
        found = parts.search(text)
        if found is None:
            return merge(text)
        ids, at = [], 0
        while found:
            ids += merge(text[at : found.start()])
            ids.append(added[found[0]])
            at = found.end()
            found = parts.search(text, at)
        return ids + merge(text[at:])

    return encode


def byte_bpe(path: str):
    """An encoder for the byte-level BPE in a ``tokenizers`` file; strings of added tokens are plain text."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    # Byte-level vocabularies write each byte as a printable character: itself, or one from U+0100 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    added = {x["content"] for x in content["added_tokens"]}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in content["model"]["vocab"].items() if piece not in added}
    words = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=words, mergeable_ranks=ranks, special_tokens={})


def pack(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) that hold every token once, without padding.

    Ties: of documents of one length the earlier goes first, of sequences of one cost the earlier.
    """
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    rest = total % capacity
    room = np.array(
        [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length())[::-1] if rest >> b & 1], np.int64
    )
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(doc, start, n, k):
        pieces.append((doc, start, n, k, int(used[k])))
        used[k] += n
        room[k] -= n
        cost[k] += linear * n + quadratic * n * n

    whole = lengths // capacity
    docs = np.repeat(np.arange(len(lengths)), whole)
    first = np.arange(len(docs)) - np.repeat(np.cumsum(whole) - whole, whole)
    n_whole = len(docs)
    pieces += zip(docs.tolist(), (first * capacity).tolist(), [capacity] * n_whole, range(n_whole), [0] * n_whole)
    room[:n_whole], cost[:n_whole] = 0, np.inf
    short = lengths - whole * capacity
    for doc in np.argsort(-short, kind="stable").tolist():
        n, start = int(short[doc]), int(whole[doc]) * capacity
        while n:
            open_ = np.flatnonzero(room >= n)
            if not len(open_):  # cut: fill the cheapest sequence that is open
                open_ = np.flatnonzero(room)
            k = int(open_[np.argmin(cost[open_])])
            part = min(n, int(room[k]))
            put(doc, start, part, k)
            start, n = start + part, n - part
    return np.array(pieces, np.int64).reshape(-1, 5)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 0,
    capacity: int = CAPACITY,
    linear: float = 1.0,
    quadratic: float = 1.0 / CAPACITY,
    batch_tokens: int = 2_000_000,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): where each lies in its document and in its sequence.

    Null text is empty and packs as its end id alone; repeated rows and doc_ids are packed row by
    row; other columns are not read. ``capacity`` must be a power of two. ``ids_crc32`` is of the
    piece's ids as little-endian unsigned 32-bit numbers. ``with_ids`` adds them as ``ids``.
    No documents give no pieces.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError(f"capacity {capacity} is no power of two")
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def table(docs: list, ids: list[np.ndarray], base: int) -> tuple[pa.Table, int]:
        pieces = pack(np.array([len(x) for x in ids]), capacity, linear, quadratic)
        doc, start, n, sequence, offset = pieces.T
        parts = [ids[d][s : s + k] for d, s, k in zip(doc.tolist(), start.tolist(), n.tolist())]
        columns = {
            "doc_id": pa.array(docs, pa.int64()).take(pa.array(doc)),
            "start": start,
            "length": n,
            "ids_crc32": np.array([zlib.crc32(x) for x in parts], np.int64),
            "doc_tokens": np.array([len(x) for x in ids], np.int64)[doc],
            "sequence_id": base + sequence,
            "offset": offset,
        }
        if with_ids:
            columns["ids"] = pa.array([x.astype(np.int32) for x in parts], pa.list_(pa.int32()))
        return pa.table(columns), base + int(sequence.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        base, held, docs, ids = TaskContext.get().partitionId() << 40, 0, [], []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encode(text.as_py() or "")
                found.append(end_id)
                docs.append(doc)
                ids.append(np.array(found, "<u4"))
                held += len(found)
                if held >= batch_tokens:
                    out, base = table(docs, ids, base)
                    yield from out.to_batches()
                    held, docs, ids = 0, [], []
        if ids:
            yield from table(docs, ids, base)[0].to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
