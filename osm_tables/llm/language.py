"""Language identification with bit-sliced Bloom filters of character trigrams.

Training counts, for each language, the trigrams around every letter (lower case; anything but a
letter is a word boundary). A language's profile holds the trigrams that make up at least
``min_rate`` of it, and at least ``min_share`` of the rate in the language that uses them most; it
has ``1 / min_rate`` trigrams at most, whatever the size of the corpus. All profiles go into one
Bloom filter whose slots are bit masks, a bit for each language: the AND of a trigram's slots is the
set of languages that contain it.

A text's trigrams are looked up together and the bits of each language counted. A language with
false positive rate ``f`` that really contains a share ``t`` of the trigrams shows ``t + (1 - t) f``,
so ``t`` is estimated as ``(seen - f) / (1 - f)``. The language with the largest ``t`` wins; of equal
ones the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from osm_tables.llm import shared
from osm_tables.llm.text import SEGMENT, flat, mix, per_text, slices

UNKNOWN = "und"
#: A bound on what is sent to every task: this many languages of ``1 / min_rate`` trigrams.
MAX_LANGUAGES = 256
_HASHES = 3
_MERGE = 500_000


@cache
def _folded() -> np.ndarray:
    """For each code point: its lower case if it is a letter, else 0."""
    out = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of one text between characters."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + SEGMENT)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield begin, end
        begin = end


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each letter of texts, made of the letter and its neighbours, and letters per text."""
    if len(at) == 2 and len(data) > 2 * SEGMENT:  # one long text: letters, then keys of all of them
        points = np.concatenate([_points(data[b:e]) for b, e in _pieces(data)])
        ends = np.array([0, len(points)])
    else:
        points = _points(data)
        ends = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))[at]
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
    before, after = np.zeros_like(points), np.zeros_like(points)
    before[1:], after[:-1] = points[:-1], points[1:]
    full = ends[1:] > ends[:-1]
    before[ends[:-1][full]] = 0
    after[ends[1:][full] - 1] = 0
    letters = np.flatnonzero(points)
    keys = before[letters] << 42 | points[letters] << 21 | after[letters]
    return keys, np.diff(np.searchsorted(letters, ends))


def _points(data: np.ndarray) -> np.ndarray:
    text = data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace")
    return _folded()[np.frombuffer(text, "<u4")]


@dataclass
class LanguageFilters:
    languages: list[str]
    slots: list[np.ndarray]  # for each 64 languages
    rates: np.ndarray  # false positives of each language

    def masks(self, keys: np.ndarray, group: int) -> np.ndarray:
        slots = self.slots[group]
        h = mix(keys.astype(np.uint64))
        found = None
        for k in range(_HASHES):
            at = (h >> np.uint64(20 * k)) & np.uint64(len(slots) - 1)
            found = slots[at] if found is None else found & slots[at]
        return found

    def judge(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the index of its language (-1: none) and the corrected share of it."""
        best, score = np.full(len(counts), -1), np.full(len(counts), -1.0)
        n = np.maximum(counts, 1)
        for group in range(len(self.slots)):
            masks = self.masks(keys, group)
            for bit in range(min(64, len(self.languages) - 64 * group)):
                hits = per_text(((masks >> masks.dtype.type(bit)) & masks.dtype.type(1)).astype(np.int64), counts)
                false = self.rates[64 * group + bit]
                share = np.clip((hits / n - false) / (1 - false), 0, 1)
                better = (share > score) & (counts > 0)
                best[better], score[better] = 64 * group + bit, share[better]
        return best, np.maximum(score, 0)


def train_filters(
    docs: DataFrame, *, min_rate: float = 1e-5, min_share: float = 0.1, bits_per_key: int = 16
) -> LanguageFilters:
    """Filters from every row of ``docs`` (text, lang) with a language and a letter.

    Only the profiles come to the driver: ``1 / min_rate`` trigrams for each language at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def merged():
            for lang, parts in held.items():
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([c for _, c in parts]))
                yield lang, keys, n.astype(np.int64)

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, at = flat(batch.column(0))
            for b, e in slices(at):
                keys, counts = trigrams(data[at[b] : at[e]], at[b : e + 1] - at[b])
                own = np.repeat(langs[b:e], counts)
                for lang in set(langs[b:e]):
                    found = np.unique(keys[own == lang], return_counts=True)
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                if size > _MERGE:
                    held = {lang: [(k, n)] for lang, k, n in merged()}
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > _MERGE:
                        yield from rows(held)
                        held, size = {}, 0
        yield from rows({lang: [(k, n)] for lang, k, n in merged()})

    def rows(held) -> Iterator[pa.RecordBatch]:
        for lang, ((keys, n),) in held.items():
            yield from shared.cut(pa.table({"lang": pa.array([lang] * len(keys), pa.string()), "key": keys, "n": n}))

    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    found = docs.mapInArrow(count, "lang string, key bigint, n bigint")
    found = shared.checkpointed(found.groupBy("lang", "key").agg(F.sum("n").alias("n")))
    totals = {r["lang"]: r["n"] for r in found.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(totals)
    if not languages:
        return LanguageFilters([], [], np.zeros(0))
    sizes = docs.sparkSession.createDataFrame([(x, float(totals[x])) for x in languages], "lang string, total double")
    rated = found.join(F.broadcast(sizes), "lang").select("lang", "key", (F.col("n") / F.col("total")).alias("rate"))
    rated = rated.where(F.col("rate") >= min_rate)
    most = rated.groupBy("key").agg(F.max("rate").alias("most"))
    profile = rated.join(most, "key").where(F.col("rate") >= min_share * F.col("most")).select("lang", "key").toArrow()

    index = {x: i for i, x in enumerate(languages)}
    lang = np.array([index[x] for x in profile.column("lang").to_pylist()], np.int64)
    keys = profile.column("key").to_numpy()
    n_slots = 1 << max(10, int(bits_per_key * max(1, len(keys)) / max(1, min(len(languages), 8))).bit_length())
    n_slots = min(n_slots, 1 << 20)
    slots = []
    for group in range((len(languages) + 63) // 64):
        width = min(64, len(languages) - 64 * group)
        kind = np.uint8 if width <= 8 else np.uint16 if width <= 16 else np.uint32 if width <= 32 else np.uint64
        slots.append(np.zeros(n_slots, kind))
    h = mix(keys.astype(np.uint64))
    rates = np.zeros(len(languages))
    for i in range(len(languages)):
        table = slots[i // 64]
        own = h[lang == i]
        for k in range(_HASHES):
            table[(own >> np.uint64(20 * k)) & np.uint64(n_slots - 1)] |= table.dtype.type(1 << i % 64)
        rates[i] = np.count_nonzero(table & table.dtype.type(1 << i % 64)) / n_slots
    return LanguageFilters(languages, slots, rates**_HASHES)


def identify(docs: DataFrame, filters: LanguageFilters, *, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language of every whole text and its corrected share of trigrams (0 to 1).

    Texts that are null or have no letter, and all texts if no language was learned, are ``und``
    with score 0. Rows are judged one by one, so repeated rows stay; other columns pass through
    unread, except that columns called like ``names`` are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    kept = [f for f in docs.schema if f.name not in names]
    # Numbered columns on the way: names with dots cannot be passed to a Python function.
    plain = [f"c{i}" for i in range(len(kept) + 2)]
    schema = StructType([StructField(c, f.dataType) for c, f in zip(plain, [*kept, StructField("", StringType()), StructField("", DoubleType())])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        named = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            data, at = flat(batch.column(batch.num_columns - 1))
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for b, e in slices(at):
                found = model.judge(*trigrams(data[at[b] : at[e]], at[b : e + 1] - at[b]))
                best.append(found[0])
                score.append(found[1])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(named[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score))]
            yield pa.RecordBatch.from_arrays(columns, plain)

    own = [F.col(f"`{f.name}`").alias(c) for f, c in zip(kept, plain)]
    return docs.select(*own, F.col("text").alias("text")).mapInArrow(run, schema).toDF(*[f.name for f in kept], *names)
