"""SentencePiece encoding and decoding as shortest paths in a weighted transducer.

The model file is compiled once in each worker: its normaliser (identity; spaces become ``U+2581``
and one is put before a text), its pieces with their weights, and a path of byte pieces for every
character that no piece holds. A text is composed with the transducer: states are places in the text
together with the piece that ends there, arcs are the pieces that begin there, and the path of least
weight (min, +) is the encoding.

For BPE models, weights alone cannot say which pieces repeated merging yields. There, the transducer
lets one piece follow another only if merging their joined text gives back just these two. A
sequence is what merging yields if and only if all its neighbours pass, because a merge across a
boundary depends on nothing but the merges within the two pieces beside it. That leaves one path.

No piece goes on after a word into a space, and none holds a line feed, so words are composed one by
one and remembered; where a model has such pieces, whole texts are composed.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Words remembered in a worker.
REMEMBERED = 1_000_000
#: Weight of a byte piece, above that of any other way.
_BYTE_WEIGHT = 1e6
# What ends where a text begins, and where bytes end (any piece may follow), and nothing yet.
_BEGIN, _BROKEN, _NONE = -1, -2, -3


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, type(model.pieces[0])
        if spec.precompiled_charsmap:
            raise ValueError(f"{path}: normalisation by a character map is not supported")
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.merging = model.trainer_spec.model_type == model.trainer_spec.BPE
        self.names = [p.piece for p in model.pieces]
        self.weights = [-p.score for p in model.pieces]
        kind = [p.type for p in model.pieces]
        self.unknown = kind.index(kinds.UNKNOWN)
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_value = {i: b for b, i in self.byte.items()}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.rank = {x: self.weights[i] for x, i in self.ids.items()}
        self.compile_arcs()
        inner = [x.lstrip(SPACE) for x in self.ids]
        words = not any(SPACE in x or "\n" in x for x in inner)
        self.parts = re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if words else r"(?s).+")
        self.follows: dict[int, bool] = {}
        self.known = _Words(self.path)
        self.own = list(range(len(self.names)))  # one object for each id, however often it is kept
        space = " " if self.escape else SPACE
        self.raw = [p.replace(SPACE, space).encode() for p in self.names]
        for i, k in enumerate(kind):
            if i in self.byte_value:
                self.raw[i] = bytes([self.byte_value[i]])
            elif k == kinds.CONTROL:
                self.raw[i] = b""

    def compile_arcs(self) -> None:
        """For each text that a piece is or begins with: twice the piece (-2 if none), plus 1 if longer ones begin so."""
        openings = {x[:k] for x in self.ids for k in range(1, len(x))}
        self.arcs = {x: 2 * self.ids.get(x, -1) + (x in openings) for x in openings | self.ids.keys()}
        self.single = {x for x in self.ids if len(x) == 1}

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = f" {text}" if self.prefix else text
        return text.replace(" ", SPACE) if self.escape else text

    def merged(self, text: str) -> list[str]:
        """What merging gives: again and again the neighbours that make the piece of least weight, the first of equals."""
        parts, rank = list(text), self.rank.get
        ranks = [rank(x + y, inf) for x, y in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == inf:
                break
            k = ranks.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank(parts[k - 1] + parts[k], inf)
            if k < len(ranks):
                ranks[k] = rank(parts[k] + parts[k + 1], inf)
        return parts

    def may_follow(self, before: int, piece: int) -> bool:
        key = before * len(self.names) + piece
        allowed = self.follows.get(key)
        if allowed is None:
            if len(self.follows) > REMEMBERED:
                self.follows.clear()
            own = [self.names[piece]] if before < 0 else [self.names[before], self.names[piece]]
            allowed = self.follows[key] = not self.merging or self.merged("".join(own)) == own
        return allowed

    def path(self, text: str) -> tuple[int, ...]:
        """Ids on the path of least weight through one part of a text.

        Of the states at one place only the best is kept: merging leaves one, and without merging
        what follows does not depend on the piece before.
        """
        if self.merging and self.single.issuperset(text):
            return self._merging_path(text)
        back, last = (self._merging_states if self.merging else self._weighted_states)(text)
        out: list[int] = []
        at = len(text)
        while at:
            begin, piece = back[at], last[at]
            if piece == _BROKEN:
                raw = text[begin:at].encode("utf-8", "replace")
                out += [self.byte[b] for b in raw[::-1]] if self.byte else [self.unknown]
            else:
                out.append(self.own[piece])
            at = begin
        return tuple(out[::-1])

    def _merging_path(self, text: str) -> tuple[int, ...]:
        """The path of pieces that may follow one another, the longest tried first.

        Merging leaves one path to each place, so a place that leads nowhere is met once.
        """
        n, arcs, follows, size = len(text), self.arcs, self.follows, len(self.names)
        path: list[int] = []
        ways: list[list[tuple[int, int]]] = []  # for each piece of the path, those not yet tried in its place
        before, i = _BEGIN, 0
        while i < n:
            j, code, found = i + 1, arcs[text[i]], []
            while code is not None:
                if code >= 0:
                    found.append((code >> 1, j))
                if j == n or not code & 1:
                    break
                j += 1
                code = arcs.get(text[i:j])
            while True:
                while not found:
                    found = ways.pop()
                    path.pop()
                    before = path[-1] if path else _BEGIN
                piece, j = found.pop()
                allowed = follows.get(before * size + piece)
                if allowed if allowed is not None else self.may_follow(before, piece):
                    break
            ways.append(found)
            path.append(piece)
            before, i = piece, j
        return tuple(path)

    def _merging_states(self, text: str) -> tuple[array, array]:
        """For each place where the piece that ends there begins, and that piece."""
        n, arcs, follows, size = len(text), self.arcs, self.follows, len(self.names)
        back, last = array("i", bytes(4 * (n + 1))), array("i", [_NONE]) * (n + 1)
        last[0] = _BEGIN
        for i in range(n):
            before, j = last[i], i + 1
            code = arcs.get(text[i])
            if code is None or code < 0:
                if last[j] == _NONE:
                    back[j], last[j] = i, _BROKEN
            while code is not None:
                if code >= 0 and last[j] == _NONE:
                    piece = code >> 1
                    allowed = follows.get(before * size + piece)
                    if allowed if allowed is not None else self.may_follow(before, piece):
                        back[j], last[j] = i, piece
                if j == n or not code & 1:
                    break
                j += 1
                code = arcs.get(text[i:j])
        return back, last

    def _weighted_states(self, text: str) -> tuple[array, array]:
        n, arcs = len(text), self.arcs
        weight, back, last = array("d", [inf]) * (n + 1), array("i", bytes(4 * (n + 1))), array("i", [_NONE]) * (n + 1)
        weight[0] = 0.0
        for i in range(n):
            j = i + 1
            code = arcs.get(text[i])
            if (code is None or code < 0) and weight[i] + _BYTE_WEIGHT < weight[j]:
                weight[j], back[j], last[j] = weight[i] + _BYTE_WEIGHT, i, _BROKEN
            while code is not None:
                if code >= 0 and weight[i] + self.weights[code >> 1] < weight[j]:
                    weight[j], back[j], last[j] = weight[i] + self.weights[code >> 1], i, code >> 1
                if j == n or not code & 1:
                    break
                j += 1
                code = arcs.get(text[i:j])
        return back, last

    def packed(self, text: str) -> bytes:
        """Ids of a text, 32 bits each: those of its words, put together as bytes and not id by id."""
        return b"".join(map(self.known.__getitem__, self.parts.findall(self.normalised(text))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class _Words(dict):
    """Ids of the words met lately, 32 bits each: the newer half of them, and the half before."""

    def __init__(self, path):
        self._path, self._older = path, {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = array("i", self._path(word)).tobytes()
        if len(word) < 100:
            if len(self) >= REMEMBERED // 2:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


@lru_cache(2)
def compiled(path: str) -> Transducer:
    return Transducer(path)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id and ids.

    Null text is empty and has no ids. Rows are encoded one by one; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = compiled(model).packed
        for batch in batches:
            for b in range(0, batch.num_rows, 500):
                part = batch.slice(b, 500)
                found = [packed(x or "") for x in part.column(1).to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the text that the ids stand for; null ids are none, which is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        for batch in batches:
            for b in range(0, batch.num_rows, 500):
                part = batch.slice(b, 500)
                texts = pa.array([transducer.decode(x.as_py() or []) for x in part.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def digests(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_ids, n_bytes (ids of single bytes), ids_crc32 (little-endian, 32 bits each), and the decoded text's length and SHA-256."""
    import hashlib
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        byte = np.array(sorted(transducer.byte_value), np.int32)
        for batch in batches:
            rows = []
            for x in batch.column(1):
                ids = x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)
                text = transducer.decode(ids.tolist())
                n_bytes = int(((ids >= byte[0]) & (ids <= byte[-1])).sum()) if len(byte) else 0
                rows.append((len(ids), n_bytes, zlib.crc32(ids.astype("<u4").tobytes()), len(text), hashlib.sha256(text.encode()).hexdigest()))
            columns = [batch.column(0), batch.column(1), *(pa.array(c) for c in zip(*rows))] if rows else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_ids", "n_bytes", "ids_crc32", "decoded_chars", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, n_ids bigint, n_bytes bigint, ids_crc32 bigint, decoded_chars bigint, decoded_sha256 string"
    )
