"""A hierarchical Pitman-Yor language model, sampled and applied on all executors.

The model predicts a token from the word before it. Every previous word has a restaurant of its own
(so has the beginning of a text); all of them share one parent, the restaurant of single words, whose
base is uniform over the vocabulary and one unknown word:

    p(w | u) = (c_uw - d t_uw + (theta + d t_u) p(w)) / (theta + c_u)

``c`` counts customers (tokens), ``t`` the tables they sit at; each table is a customer of the
parent. Tables are hidden and sampled by blocked Gibbs sweeps: a restaurant's customers of one word
leave and are seated again by the Chinese restaurant process, given the parent's probability and the
restaurant's other tables as the last sweep left them. After ``burn_in`` sweeps the predictive
probabilities of the following ones are averaged.

Work is dealt out once, by word: a range of word hashes holds all that is known of its words. Words
that make up more than ``1 / HOT`` of the tokens (``HOT`` at most) are dealt out by word and previous
word, counted in advance; what all parts know of them is summed on the driver. A restaurant's
customers are spread over the parts of the words that sit in it. So each part sends customers and
different words of each restaurant to the restaurant's home, a range of hashes of previous words, and
gets the sums back, with a number for each restaurant in which some word has more than one customer.
Only there can tables change: after a sweep a part sends the tables that it has beyond one a word, by
those numbers, and gets the sums back. Nothing that grows with the number of restaurants reaches the
driver. Every step works on packed arrays; the packed tokens and the sums are kept in the checkpoint
folder, so a lost executor repeats only its part, with the same random numbers. Parts follow from the
number of training tokens alone, and random numbers from the part, so the number of shuffle partitions
changes no score.

Words are 64-bit hashes of their bytes, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osm_tables.llm import shared
from osm_tables.llm.text import flat, mix, slices, word_hashes

#: Places for previous words in a part whose number of them is not given.
CONTEXTS = 2048
HOT = 1024
#: Tokens of a batch, about, and rows at most (their numbers take 16 bits).
BATCH_TOKENS, BATCH_ROWS = 1_000_000, 60_000
#: Training tokens of a part at most, about, and the fewest parts.
PART_TOKENS, PARTS = 1_500_000, 8
#: Frequent words that have a number (of two bytes), and how many a task proposes. Saves bytes only.
DICTIONARY, PROPOSED = 65_536, 32_768
_EXCHANGE = "home int, part int, kind int, blob binary"
_END = np.uint64(0x5851F42D4C957F2D)
_TRAIN = np.uint32(1 << 31)


@dataclass
class Totals:
    """What a part must know of all others. On the driver ``customers`` and ``tables`` are empty."""

    tokens: int
    customers: np.ndarray  # of each of the part's contexts
    tables: np.ndarray  # of each of the part's contexts
    words: int = 0
    root_customers: float = 0.0
    root_tables: float = 0.0
    hot_p: np.ndarray = field(default_factory=lambda: np.zeros(0))  # p(w) of frequent words


@dataclass
class Settings:
    discount: float = 0.85
    strength: float = 1.0
    root_discount: float = 0.8
    root_strength: float = 1.0
    sweeps: int = 3
    burn_in: int = 1
    seed: int = 1
    one_by_one: bool = False  # seat beyond 16 customers, too, one after another
    parts: int = PARTS
    dictionary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


def tokens_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts (words, then an end), of the tokens before them, and tokens per text."""
    words, counts = word_hashes(data, at)
    tokens = np.insert(words, np.cumsum(counts), _END)
    before = np.concatenate(([_END], tokens[:-1]))
    return tokens, before, counts + 1


def _packed(*arrays: np.ndarray) -> bytes:
    # The first bytes of sorted hashes compress well when they lie together.
    planes = [a.view(np.uint8).reshape(-1, 8).T if a.dtype == np.uint64 else a for a in map(np.ascontiguousarray, arrays)]
    body = b"".join(a.tobytes() for a in planes)
    head = np.array([len(arrays), len(body), *[x for a in arrays for x in (ord(a.dtype.char), len(a))]], "<i8")
    return head.tobytes() + pa.compress(body, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    n, size = np.frombuffer(blob, "<i8", 2).tolist()
    head = np.frombuffer(blob, "<i8", 2 * n, 16).reshape(n, 2).tolist()
    body = pa.decompress(blob[16 + 16 * n :], size, "zstd", asbytes=True)
    out, begin = [], 0
    for char, length in head:
        found = np.frombuffer(body, chr(char), length, begin)
        begin += found.nbytes
        if found.dtype == np.uint64:
            found = np.ascontiguousarray(found.view(np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
        out.append(found)
    return out


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _small(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()) if len(numbers) else 0))


def _numbered(words: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words in a sorted list, and whether they are there."""
    if not len(among):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(among, words), len(among) - 1)
    return at, among[at] == words


def _coded(words: np.ndarray, dictionary: np.ndarray) -> list[np.ndarray]:
    """Ascending words as three arrays: which of them have a number, the gaps of these, and the others."""
    at, known = _numbered(words, dictionary)
    return [np.packbits(known), _small(np.diff(at[known], prepend=0)), words[~known]]


def _decoded(known: np.ndarray, gaps: np.ndarray, others: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    known = np.unpackbits(known, count=len(gaps) + len(others)).astype(bool)
    words = np.empty(len(known), np.uint64)
    words[known], words[~known] = dictionary[np.cumsum(gaps, dtype=np.int64)], others
    return words


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of training tokens, and counts of frequent words."""
    n, words, often, more = 0, np.zeros(0, np.uint64), np.zeros(0), []

    def folded(words, often, more):
        found, back = np.unique(np.concatenate([words, *more]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([often, np.ones(len(back) - len(words))]), len(found))
        top = np.lexsort((found, -counts))[:PROPOSED]
        return found[top], counts[top]

    for batch in batches:
        data, at = flat(batch.column(0))
        for b, e in slices(at):
            tokens, _, _ = tokens_of(data[at[b] : at[e]], at[b : e + 1] - at[b])
            n += len(tokens)
            # Which words count as frequent steers the work: every eighth token will do.
            more.append(tokens[::8])
            if sum(map(len, more)) > BATCH_TOKENS // 8:
                words, often = folded(words, often, more)
                more = []
    words, often = folded(words, often, more)
    kind = np.repeat([0, 1], [1, len(words)]).astype(np.int32)
    ids = np.concatenate([np.zeros(1, np.int64), words.view(np.int64)])
    counts = np.concatenate([[n], 8 * often]).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, ids, counts)], ["kind", "id", "n"])


def _spread(settings: Settings):
    """Texts to blobs: of each batch one for every part, and one of its rows."""
    hot = settings.hot

    def blobs(number, docs, held, parts):
        tokens, before, counts = (np.concatenate(x) for x in zip(*parts))
        doc = np.repeat(np.arange(len(counts), dtype=np.uint16), counts)
        train = ~np.array(held)[doc]
        is_hot = _numbered(tokens, hot)[1]
        known = np.array([x is not None for x in docs])
        ids = np.array([x or 0 for x in docs], np.int64)
        yield number % settings.parts, number, 0, _packed(ids, known, np.array(held), counts.astype(np.int64))
        names, context = np.unique(before, return_inverse=True)
        # Rare words in the order of their hashes.
        cold = np.flatnonzero(~is_hot)
        cold = cold[np.argsort(tokens[cold], kind="stable")]
        cold_cuts = np.searchsorted(part_of(tokens[cold], settings.parts), np.arange(settings.parts + 1))
        # Frequent words by part, pair and document, each with its number.
        some = np.flatnonzero(is_hot)
        some_part = part_of(mix(tokens[some] ^ mix(before[some])), settings.parts)
        some = some[np.lexsort((doc[some], context[some], tokens[some], some_part))]
        w, u, d = tokens[some], before[some], doc[some]
        changes = np.ones(len(some), bool)
        changes[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1])
        pair, firsts = np.cumsum(changes) - 1, np.flatnonzero(changes)
        changes[1:] |= d[1:] != d[:-1]
        entry = np.flatnonzero(changes)
        times, pair_of = np.diff(np.append(entry, len(some))), pair[entry]
        entries = np.bincount(pair_of, minlength=len(firsts))
        pair_n = np.bincount(pair, train[some], len(firsts)).astype(np.int64)
        pair_part = part_of(mix(w[firsts] ^ mix(u[firsts])), settings.parts)
        pair_cuts = np.searchsorted(pair_part, np.arange(settings.parts + 1))
        entry_cuts = np.searchsorted(pair_of, pair_cuts)
        for part in range(settings.parts):
            own = cold[cold_cuts[part] : cold_cuts[part + 1]]
            its, its_docs = slice(*pair_cuts[part : part + 2]), slice(*entry_cuts[part : part + 2])
            if not len(own) and its.stop == its.start:
                continue
            begins = np.flatnonzero(np.concatenate(([True], tokens[own][1:] != tokens[own][:-1]))) if len(own) else np.zeros(0, np.int64)
            both = np.concatenate([context[own], context[some[firsts[its]]]])
            used, at = np.unique(both, return_inverse=True)
            yield part, number, 1, _packed(
                *_coded(tokens[own[begins]], settings.dictionary), _small(np.diff(np.append(begins, len(own)))), _small(at[: len(own)]), np.packbits(train[own]), doc[own],
                np.searchsorted(hot, w[firsts[its]]).astype(np.uint16), _small(at[len(own) :]), _small(pair_n[its]),
                _small(entries[its]), d[entry[its_docs]], _small(times[its_docs]),
                *_coded(names[used], settings.dictionary),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs, held, parts, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        for batch in batches:
            ids, out_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, at = flat(batch.column(2))
            for b, e in slices(at):
                parts.append(tokens_of(data[at[b] : at[e]], at[b : e + 1] - at[b]))
                docs += ids[b:e]
                held += out_[b:e]
                size += len(parts[-1][0])
                if size >= BATCH_TOKENS or len(docs) >= BATCH_ROWS - 20_000:
                    yield _rows(blobs(number, docs, held, parts))
                    number, docs, held, parts, size = number + 1, [], [], [], 0
        if docs:
            yield _rows(blobs(number, docs, held, parts))

    return run


def _rows(rows) -> pa.RecordBatch:
    part, number, kind, blob = zip(*rows)
    arrays = [pa.array(part, pa.int32()), pa.array(number, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["part", "batch", "kind", "blob"])


def seat(customers: np.ndarray, base: np.ndarray, other: np.ndarray, discount: float, strength: float, rng, one_by_one: bool = False) -> np.ndarray:
    """Tables that customers of one word take when they are seated one after another.

    ``base`` is the parent's probability of the word, ``other`` the restaurant's tables of other
    words. Beyond 16 customers a sixteenth of those seated come in together, unless ``one_by_one``:
    that is exact, in as many steps as a word has customers.
    """
    order = np.argsort(-customers, kind="stable")
    c, p, o = customers[order], base[order], other[order]
    t, seated, falling = np.ones(len(c)), 1, -c
    while True:
        n = int(np.searchsorted(falling, -seated))  # those with more customers come first
        if not n:
            break
        step = 1 if one_by_one else max(1, seated // 16)
        new = (strength + discount * (o[:n] + t[:n])) * p[:n]
        chance = np.clip(new / (new + seated - discount * t[:n]), 0, 1)
        t[:n] += rng.random(n) < chance if step == 1 else rng.binomial(np.minimum(step, c[:n] - seated).astype(np.int64), chance)
        seated += step
    out = np.empty(len(c))
    out[order] = t
    return out


def _root(customers: np.ndarray, tables: np.ndarray, totals: Totals, s: Settings) -> np.ndarray:
    spare = (s.root_strength + s.root_discount * totals.root_tables) / (totals.words + 1)
    return (customers - s.root_discount * tables + spare) / (s.root_strength + totals.root_customers)


def _root_tables(customers: np.ndarray, own: np.ndarray | None, before: Totals, s: Settings, rng) -> np.ndarray:
    """Tables that words take in the parent, given those they had."""
    used = customers > 0
    own = own if own is not None else used.astype(float)
    base = np.full(len(used), 1 / (before.words + 1) if before.words else 1 / max(1, before.tokens))
    other = np.maximum(max(before.root_tables, 1) - own, 0)
    return np.where(used, seat(customers, base, other, s.root_discount, s.root_strength, rng, s.one_by_one), 0)


class Part:
    """All training customers of a range of words, and of a range of pairs of frequent ones."""

    def __init__(self, blobs: list[list[np.ndarray]], settings: Settings, part: int, contexts: int = CONTEXTS):
        self.settings, self.rng, self.contexts = settings, np.random.default_rng([settings.seed, part]), contexts
        self.words = np.unique(np.concatenate([x for b in blobs for x in (b[0], b[4])]))
        keys, counts = [], []
        for words, times, contexts, _, hot_words, hot_contexts, hot_counts, *_ in blobs:
            found = self._keys(np.repeat(words, times), contexts & ~_TRAIN)[contexts & _TRAIN != 0]
            some = np.asarray(hot_counts) > 0
            for k, n in ((found, None), (self._keys(hot_words[some], hot_contexts[some]), hot_counts[some])):
                k, back = np.unique(k, return_inverse=True)
                keys.append(k)
                counts.append(np.bincount(back, n, len(k)))
        self.pairs, back = np.unique(np.concatenate(keys), return_inverse=True)
        self.counts = np.bincount(back, np.concatenate(counts), len(self.pairs)).astype(float)
        self.word, self.context = self.pairs // self.contexts, self.pairs % self.contexts
        self.word_counts = np.bincount(self.word, self.counts, len(self.words))
        self.is_hot = np.isin(self.words, settings.hot)
        self.hot_at = np.searchsorted(settings.hot, self.words[self.is_hot])
        self.singles = np.zeros(len(self.words))  # pairs with one customer, thus one table, that are not among the pairs
        self.tables = self.root_customers = self.root_tables = None

    def varying(self) -> list[np.ndarray]:
        """All that a sweep needs: pairs with more than one customer, and of each word its other pairs."""
        some = self.counts > 1
        singles = np.bincount(self.word[~some], minlength=len(self.words))
        numbers = [np.diff(self.word[some], prepend=0), self.context[some], self.counts[some], singles, self.word_counts]
        return [*(_small(x.astype(np.int64)) for x in numbers), np.packbits(self.is_hot), self.hot_at]

    @classmethod
    def restored(cls, state: list[np.ndarray], settings: Settings, part: int, step: int) -> "Part":
        self = cls.__new__(cls)
        self.settings, self.rng = settings, np.random.default_rng([settings.seed, part, step])
        gaps, self.context, counts, singles, word_counts, hot, self.hot_at = state
        self.word, self.counts = np.cumsum(gaps, dtype=np.int64), counts.astype(float)
        self.singles, self.word_counts = singles.astype(float), word_counts.astype(float)
        self.is_hot = np.unpackbits(hot, count=len(singles)).astype(bool)
        self.tables = self.root_customers = self.root_tables = None
        return self

    def seated(self, tables: np.ndarray, root_tables: np.ndarray) -> None:
        """As a sweep left it."""
        self.tables, self.root_tables = tables.astype(float), root_tables.astype(float)
        self.root_customers = np.bincount(self.word, self.tables, len(self.singles)) + self.singles

    def _keys(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words, words) * self.contexts + contexts.astype(np.int64)

    def root(self, totals: Totals) -> np.ndarray:
        """p(w) of each word."""
        p = _root(self.root_customers, self.root_tables, totals, self.settings)
        p[self.is_hot] = totals.hot_p[self.hot_at]
        return p

    def sweep(self, before: Totals) -> None:
        s = self.settings
        if self.tables is None:
            p, own = self.word_counts / max(1, before.tokens), np.minimum(self.counts, 1)
            p[self.is_hot] = before.hot_p[self.hot_at]
        else:
            p, own = self.root(before), self.tables
        other = np.maximum(before.tables[self.context] - own, 0)
        self.tables = seat(self.counts, p[self.word], other, s.discount, s.strength, self.rng, s.one_by_one)
        self.root_customers = np.bincount(self.word, self.tables, len(self.singles)) + self.singles
        self.root_tables = _root_tables(np.where(self.is_hot, 0, self.root_customers), self.root_tables, before, s, self.rng)

    def direct(self, totals: Totals) -> np.ndarray:
        s = self.settings
        return (self.counts - s.discount * self.tables) / (s.strength + totals.customers[self.context])


def _backoff(totals: Totals, settings: Settings) -> np.ndarray:
    """Of each context, the weight of the parent."""
    return (settings.strength + settings.discount * totals.tables) / (settings.strength + totals.customers)


def _unfolded(blobs: list[bytes], settings: Settings) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """A part's different previous words, in order, and its blobs with numbers of those in place of their own."""
    found = [_unpacked(b) for b in blobs]
    found = [[_decoded(*f[:3], settings.dictionary), *f[3:-3], _decoded(*f[-3:], settings.dictionary)] for f in found]
    names = np.unique(np.concatenate([np.zeros(0, np.uint64), *(f[-1] for f in found)]))
    out = []
    for words, times, context, train, doc, hot_words, hot_context, hot_counts, entries, *rest, own in found:
        local = np.searchsorted(names, own).astype(np.uint32)
        flags = np.unpackbits(train, count=len(context)).astype(np.uint32) * _TRAIN
        pair = np.repeat(np.arange(len(entries)), entries)
        out.append([words, times, local[context] | flags, doc, settings.hot[hot_words], local[hot_context], hot_counts, pair, *rest])
    return names, out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task was sent, as one row: lists of numbers, kinds and blobs, ordered by number."""
    held = []
    for batch in batches:
        number, kind, blob = (batch.column(c).to_pylist() for c in ("batch", "kind", "blob"))
        held += [x for x in zip(number, kind, blob) if x[1] >= 0]
    columns = list(zip(*sorted(held, key=lambda x: x[:2]))) or [[], [], []]
    kinds = (pa.int64(), pa.int32(), pa.binary())
    lists = [pa.array([list(c)], pa.list_(k)) for c, k in zip(columns, kinds)]
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), *lists], ["part", "batches", "kinds", "blobs"])


def _sent_to(part: int, batches: list, kinds: list, blobs: list) -> tuple[list, list]:
    """Numbers and blobs of the tokens that a part holds."""
    own = [(n, b) for n, k, b in zip(batches, kinds, blobs) if k == 1]
    return [n for n, _ in own], [bytes(b) for _, b in own]


def _asker(settings: Settings):
    """Customers and different words of each previous word in a part, to its home, what sweeps need, and customers of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number = row["part"]
                names, blobs = _unfolded(_sent_to(**row)[1], settings)
                hot, out = np.zeros(len(settings.hot)), []
                if blobs:
                    part = Part(blobs, settings, number, len(names))
                    hot[part.hot_at] = part.word_counts[part.is_hot]
                    out.append((number, number, 2, _packed(*part.varying())))
                    sums = [np.bincount(part.context, n, len(names)).astype(np.int64) for n in (part.counts, None)]
                    cuts = np.searchsorted(part_of(names, settings.parts), np.arange(settings.parts + 1))
                    for home, (b, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                        if e > b:
                            out.append((home, number, 1, _packed(names[b:e], *(_small(x[b:e]) for x in sums))))
                yield _exchanged([*out, (number, number, 0, _packed(hot))])

    return run


def _exchanged(rows) -> pa.RecordBatch:
    home, part, kind, blob = zip(*rows)
    arrays = [pa.array(home, pa.int32()), pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["home", "part", "kind", "blob"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part that sent sums to a home the sums over all parts, in the order it sent them; the rest as it is."""
    held: dict[int, list] = {}
    for batch in batches:
        for home, part, kind, blob in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if kind == 1:
                held.setdefault(home, []).append((part, blob))
            else:
                yield _exchanged([(home, part, kind, blob)])
    for home in sorted(held):
        parts, blobs = zip(*held.pop(home))
        found = [_unpacked(b) for b in blobs]
        cuts = np.concatenate(([0], np.cumsum([len(f[0]) for f in found]))).tolist()
        together = [np.concatenate(x) for x in zip(*found)]
        if len(together) == 3:  # names, customers, different words
            _, at = np.unique(together[0], return_inverse=True)
            customers, pairs = (np.bincount(at, x).astype(np.int64) for x in together[1:])
            varies = customers > pairs
            numbers = np.cumsum(varies) - 1
            customers, pairs, numbers, varies = customers[at], pairs[at], numbers[at], varies[at]
            for part, b, e in zip(parts, cuts, cuts[1:]):
                gaps = np.diff(numbers[b:e][varies[b:e]], prepend=0)
                yield _exchanged([(home, part, 1, _packed(_small(customers[b:e]), _small(customers[b:e] - pairs[b:e]), _small(gaps)))])
        else:
            at = np.concatenate([np.cumsum(f[0], dtype=np.int64) for f in found])
            sums = np.bincount(at, together[1]).astype(np.int64)[at]
            for part, b, e in zip(parts, cuts, cuts[1:]):
                yield _exchanged([(home, part, 1, _packed(_small(sums[b:e])))])


def _opened(sums, history: list[Totals]):
    """What a part was sent: totals after each step as it sees them, where its tables go, and its own states by step."""
    own, states = {}, {}
    for home, kind, blob in zip(*sums[1:]):  # in the order of homes
        found = _unpacked(bytes(blob))
        if kind % 2:
            states[kind // 2] = found
        else:
            own.setdefault(kind // 2, []).append((home, *found))
    none = [np.zeros(0, np.int64)]
    customers, beyond = (np.concatenate(none + [f[k] for f in own.get(0, [])]).astype(float) for k in (1, 2))
    varies, homes = beyond > 0, [(f[0], f[3]) for f in own.get(0, [])]
    # At first each word of a restaurant has one table.
    seen = {0: replace(history[0], customers=customers, tables=customers - beyond)}
    for step, totals in enumerate(history[1:], 1):
        if step in states:
            tables = customers - beyond
            tables[varies] += np.concatenate(none + [f[1] for f in own.get(step, [])])
            seen[step] = replace(totals, customers=customers, tables=tables)
    return seen, homes, states


def _sweeper(settings: Settings, history: list[Totals]):
    """One sweep of every part after the last of ``history``: its sums, and the tables as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number, step = row["part"], len(history) - 1
                seen, homes, states = _opened((number, row["batches"], row["kinds"], row["blobs"]), history)
                if not states:
                    continue
                part = Part.restored(states[0], settings, number, step)
                if step:
                    part.seated(*states[step])
                part.sweep(seen[step])
                cold, hot = ~part.is_hot, np.zeros(len(settings.hot))
                hot[part.hot_at] = part.root_customers[part.is_hot]
                told = [np.count_nonzero(part.word_counts[cold]), part.root_customers[cold].sum(), part.root_tables[cold].sum()]
                more = np.bincount(part.context, part.tables - 1, len(seen[0].customers)).astype(np.int64)
                more, out, begin = more[seen[0].customers > seen[0].tables], [], 0
                for home, gaps in homes:
                    if len(gaps):
                        out.append((home, number, 1, _packed(gaps, _small(more[begin : begin + len(gaps)]))))
                    begin += len(gaps)
                state = (_small(x.astype(np.int64)) for x in (part.tables, part.root_tables))
                yield _exchanged([*out, (number, number, 0, _packed(np.array(told, float), hot)), (number, number, 2, _packed(*state))])

    return run


def _fixed(x: np.ndarray) -> np.ndarray:
    """Sums that are not negative, in billionths: their first bytes compress to nothing."""
    return np.rint(np.maximum(x, 0) * 1e9).astype(np.uint64)


def _scorer(settings: Settings, history: list[Totals], hot_counts: np.ndarray):
    """For each batch what a part's words add to its rows."""

    def run(row, sums) -> list[tuple]:
        number = row[0]
        names, blobs = _sent_to(*row)
        contexts_, blobs = _unfolded(blobs, settings)
        if not blobs:
            return []
        seen, _, states = _opened(sums, history)
        part = Part(blobs, settings, number, len(contexts_))
        direct, roots, averaged, varies = np.zeros(len(part.pairs) + 1), [], sorted(states), part.counts > 1
        for step in averaged:
            tables = np.ones(len(part.pairs))
            tables[varies] = states[step][0]
            part.seated(tables, states[step][1])
            direct[:-1] += part.direct(seen[step])
            roots.append(part.root(seen[step]))
        weights = [_backoff(seen[step], settings) for step in averaged]
        counts = part.word_counts.copy()
        counts[part.is_hot] = hot_counts[part.hot_at]

        def looked_up(words, context):
            word = np.searchsorted(part.words, words)
            key = word * part.contexts + context
            at = np.searchsorted(part.pairs, key)
            at = np.where(np.append(part.pairs, -1)[at] == key, at, len(part.pairs))
            p = direct[at]
            for root, weight in zip(roots, weights):
                p = p + weight[context] * root[word]
            return counts[word], np.log10(p / len(roots))

        out = []
        for name, (words, times, contexts, doc, hot_words, hot_contexts, _, pair, hot_doc, hot_times) in zip(names, blobs):
            count, log_p = looked_up(np.repeat(words, times), (contexts & ~_TRAIN).astype(np.int64))
            hot_count, hot_log = looked_up(hot_words, hot_contexts.astype(np.int64))
            doc, n = np.concatenate([doc, hot_doc]), np.concatenate([np.ones(len(doc)), hot_times])
            count, log_p = np.concatenate([count, hot_count[pair]]), np.concatenate([log_p, hot_log[pair]])
            rows, at = np.unique(doc, return_inverse=True)
            total = lambda x: np.bincount(at, n * x, len(rows))
            out.append((number, name, 1, _packed(rows, _fixed(total(np.log10(count + 1))), _fixed(-total(log_p)), total(count > 0).astype(np.uint32))))
        return out

    return run


def _finisher(totals: Totals):
    """Rows with their scores, from a batch's rows and what all parts add to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in shared.groups(batches, ["batch"]):
            added = []
            for kind, blob in zip(group.column("kind").to_pylist(), group.column("blob").to_pylist()):
                if kind == 0:
                    ids, known, held, n = _unpacked(blob)
                else:
                    added.append(_unpacked(blob))
            base, score, n_known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
            for rows, b, s, k in sorted(added, key=lambda x: x[1].tobytes()):
                base[rows] += b / 1e9
                score[rows] -= s / 1e9
                n_known[rows] += k
            base -= n * np.log10(totals.tokens + totals.words + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=~known.astype(bool)),
                    pa.array(held.astype(bool)),
                    pa.array(n),
                    pa.array(n_known),
                    pa.array(np.full(len(ids), totals.tokens)),
                    pa.array(base),
                    pa.array(score),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score_documents(docs: DataFrame, held_out: Column, **parameters) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) scored by a model of the rows that are not ``held_out``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one single words) and
    score, both log10 probabilities of the whole text. Null text is empty: its end token alone.
    Rows are scored one by one, repeated ones alike; null doc_ids stay. With nothing to learn from
    every token has probability 1 in either model. A text of any length is read whole, in segments.
    Other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    settings = Settings(**parameters)
    docs = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    seen = docs.where("NOT held_out").select("text").mapInArrow(_survey, "kind int, id bigint, n bigint")
    seen = shared.checkpointed(seen.groupBy("kind", "id").agg(F.sum("n").alias("n")))
    tokens = sum(r["n"] for r in seen.where("kind = 0").collect())
    settings.parts = max(PARTS, -(-tokens // PART_TOKENS))
    # No more than 2^20 words are that frequent, so no more are sorted on the driver.
    frequent = seen.where((F.col("kind") == 1) & (F.col("n") * (1 << 20) >= tokens)).orderBy(F.desc("n"), "id").limit(DICTIONARY).collect()
    words, counts = np.array([(r["id"], r["n"]) for r in frequent], np.int64).reshape(-1, 2).T
    settings.dictionary = np.sort(words.astype(np.int64).view(np.uint64))
    settings.hot = np.sort(words[counts * HOT > tokens][:HOT].view(np.uint64))

    # One row for each part, in a partition of its own, so that what is kept and what is sent later can be zipped.
    every = spark.range(0, settings.parts, 1, 1).select(F.col("id").cast("int").alias("part"), F.lit(0).cast("bigint").alias("batch"), F.lit(-1).alias("kind"), F.lit(b"").alias("blob"))
    gathered = "part int, batches array<bigint>, kinds array<int>, blobs array<binary>"

    def by_part(rows: DataFrame, use=None, schema: str = gathered) -> DataFrame:
        run = (lambda batches: use(_gathered(batches))) if use else _gathered
        return rows.unionAll(every).repartitionById(settings.parts, F.col("part")).mapInArrow(run, schema)

    packed = shared.checkpointed(by_part(docs.mapInArrow(_spread(settings), "part int, batch bigint, kind int, blob binary")))
    shared.release(spark)
    told = []

    def exchanged(sent: DataFrame) -> list[list[np.ndarray]]:
        """Sums at the homes are kept; what parts report comes back."""
        sums = sent.repartitionById(settings.parts, F.col("home")).mapInArrow(_summed, _EXCHANGE)
        told.append(shared.checkpointed(sums))
        shared.release(spark)
        return [_unpacked(r["blob"]) for r in told[-1].where("kind = 0").select("part", "blob").orderBy("part").toLocalIterator()]

    def sums_of(steps, states, *use) -> DataFrame:
        """What each part was sent in these steps, and its own states, as one row."""
        kept = [t.where("kind = 1" + " OR kind = 2" * (k in states)).select(
            "part", F.col("home").cast("bigint").alias("batch"), (F.lit(2 * k - 1) + F.col("kind")).alias("kind"), "blob"
        ) for k, t in enumerate(told) if k in steps]
        return by_part(reduce(DataFrame.unionAll, kept), *use)

    none = np.zeros(0)
    hot_counts = sum((r[0] for r in exchanged(packed.mapInArrow(_asker(settings), _EXCHANGE))), np.zeros(len(settings.hot)))
    history = [Totals(tokens, none, none, hot_p=hot_counts / max(1, tokens))]
    hot_tables, rng = None, np.random.default_rng([settings.seed, settings.parts, 1])
    for _ in range(settings.sweeps):
        steps = {0, len(history) - 1}
        reports = exchanged(sums_of(steps, steps, _sweeper(settings, history), _EXCHANGE))
        words, root_customers, root_tables = sum((r[0] for r in reports), np.zeros(3))
        hot_customers = sum((r[1] for r in reports), np.zeros(len(settings.hot)))
        hot_tables = _root_tables(hot_customers, hot_tables, history[-1], settings, rng)
        words += np.count_nonzero(hot_customers)
        now = Totals(tokens, none, none, int(words), root_customers + hot_customers.sum(), root_tables + hot_tables.sum())
        now.hot_p = _root(hot_customers, hot_tables, now, settings)
        history.append(now)
    averaged = set(range(settings.burn_in + 1, settings.sweeps + 1))
    # Kept first, so that a task that scores has one Python worker and not two.
    sums, score = shared.checkpointed(sums_of({0} | averaged, averaged)), _scorer(settings, history, hot_counts)
    shared.release(spark)
    pairs = packed.rdd.zip(sums.rdd)
    added = spark.createDataFrame(pairs.flatMap(lambda x: score(*x)), "part int, batch bigint, kind int, blob binary", verifySchema=False)
    rows = packed.select(F.explode(F.arrays_zip("batches", "kinds", "blobs")).alias("x")).select("x.batches", "x.kinds", "x.blobs").where("kinds = 0")
    rows = rows.toDF("batch", "kind", "blob").unionAll(added.select("batch", "kind", "blob"))
    rows = rows.repartition(settings.parts, "batch").sortWithinPartitions("batch")
    return rows.mapInArrow(
        _finisher(history[-1]),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
