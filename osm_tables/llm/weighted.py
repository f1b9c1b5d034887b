"""Document fingerprints by consistent weighted sampling.

A text's terms are the 64-bit hashes of its words; a term's weight ``s`` is how often it
occurs. For each of ``samples`` draws every term has its own fixed ``r`` and ``c`` from Gamma(2, 1)
and ``b`` from U(0, 1), made from hashes. With ``t = floor(ln s / r + b)`` and
``ln a = ln c - r (t - b + 1)``, the draw is the pair (term, t) of the smallest ``a``. Two texts draw
the same pair with a probability that equals the generalised Jaccard similarity of their weights,
``sum(min) / sum(max)``; the part of equal draws estimates it,
with a standard deviation of ``sqrt(J * (1 - J) / samples)`` for a similarity of ``J``.

Everything is DataFrame functions; ``r``, ``b`` and ``c`` are computed from the term, once for a text and its edited
text together, and with logarithms only if a lower bound of ``a`` says that the term can be a draw. Terms are counted within the row, and the smallest draws are aggregated where the texts were joined.
A draw is kept as 32 bits of the pair's hash. Texts of any length have their words counted in one array of hashes,
16 bytes a word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from osm_tables.llm import shared
from osm_tables.llm.quality import hashes_of, let, words_of
from osm_tables.llm.shared import unused

SAMPLES = 64
#: Samples of a row while they are drawn; the code for all at once is too long to be compiled.
_AT_ONCE = 2
#: A text's draws are looked for among terms whose ``a`` can be below this, divided by the number of its words.
_NEAR = 16.0
_BITS = 22
_KEY = ["id", "known", "text_id"]
_KINDS = ("own", "edited")


def pair_counts(own: Column, edited: Column) -> Column:
    """Structs of a term and how often it occurs in each of two texts: ``term, own, edited``.

    A term is a word's 64-bit hash without its last bit, in which the sorted list keeps the text.
    """

    def marked(text: Column, kind: int) -> Column:
        return F.transform(hashes_of(words_of(text)), lambda h: h.bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(kind)))

    def runs(s: Column) -> Column:
        last = F.transform(s, lambda x, i: F.when(x == F.get(s, i + 1), F.lit(None)).otherwise(F.struct(x.alias("x"), i.alias("end"))))
        return F.filter(last, lambda x: x.isNotNull())

    def merged(e: Column) -> Column:
        def one(x, k):
            own, before, after = x["x"].bitwiseAND(F.lit(1)) == 0, F.get(e, k - 1), F.get(e, k + 1)
            n = x["end"] - F.coalesce(before["end"], F.lit(-1))
            term = x["x"].bitwiseAND(F.lit(-2)).alias("term")
            first = F.struct(term, n.alias("own"), F.when(after["x"] == x["x"] + 1, after["end"] - x["end"]).otherwise(F.lit(0)).alias("edited"))
            second = F.struct(term, F.lit(0).alias("own"), n.alias("edited"))
            return F.when(own, first).when(~F.coalesce(before["x"] == x["x"] - 1, F.lit(False)), second)

        return F.filter(F.transform(e, one), lambda x: x.isNotNull())

    marks = F.sort_array(F.concat(marked(own, 0), marked(edited, 1)))
    # Each list is bound once: as the only element of an array that is transformed.
    for step in (runs, merged):
        marks = F.transform(F.array(marks), step)[0]
    return marks


def _uniforms(first: Column, second: Column) -> dict[str, Column]:
    """``exp(-r)``, b and ``exp(-c)`` from a term's two hashes for a sample."""

    def uniform(h: Column, low: int, bits: int) -> Column:
        part = F.shiftrightunsigned(h, low).bitwiseAND(F.lit((1 << bits) - 1))
        return (part.cast("double") + 0.5) * (1.0 / (1 << bits))

    return {"r": uniform(first, 0, 32) * uniform(first, 32, 32), "b": uniform(second, 0, 22), "c": uniform(second, 22, 21) * uniform(second, 43, 21)}


def draw(term: Column, j: Column) -> tuple[Column, Column, Column]:
    """A term's fixed r, b and ln c for sample j, from two hashes."""
    first = F.xxhash64(term, j)
    u = _uniforms(first, F.xxhash64(first))
    return -F.ln(u["r"]), u["b"], F.ln(-F.ln(u["c"]))


def _least(u: Column, b: Column, v: Column, once: Column) -> Column:
    """A number that ``s * a`` of a term that occurs ``s`` times never falls below, made of ``u = exp(-r)``, b and
    ``v = exp(-c)`` without a logarithm; a greater one where the term occurs at most ``once``.

    As ``t <= ln s / r + b``, ``s * a >= c * u``; for ``s = 1``, ``a = c * u * exp(r * b)``. The first terms of the series of
    ``-ln v``, ``-ln u`` and ``exp`` are less than these.
    """
    w, x = 1 - v, 1 - u
    y = b * x * (1 + 0.5 * x)
    least = u * w * (1 + w * (w * (1.0 / 3) + 0.5))
    return F.when(once, least * (1 + y * (1 + 0.5 * y))).otherwise(least)


def _packed(term: Column, s: Column, r: Column, b: Column, c: Column) -> tuple[Column, Column]:
    """The size of a draw, ``ln a``, as a whole number, and the draw: the smallest number of a text is its draw."""
    t = F.floor(s / r + b)
    size = F.floor((c - r * (t - b + 1) + 1000) * float(1 << 30))
    pair = term.bitwiseXOR(F.shiftright(term, 32)).bitwiseXOR(F.shiftleft(t, 1))
    return size, F.shiftleft(size, _BITS).bitwiseOR(pair.bitwiseAND(F.lit((1 << _BITS) - 1)))


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` of ``texts`` (which name a row) and its other columns, with ``own`` and ``edited`` replaced by their
    fingerprints, arrays of ``samples`` ints.

    A text without words has -1 in every place. Where ``texts`` is partitioned by ``keys`` already, nothing is shuffled.

    The smallest ``a`` of a text of ``n`` words is larger than ``_NEAR / n`` with a probability of ``exp(-_NEAR)``.
    Logarithms are taken only for terms that can be below that; a text whose draw is not below it is drawn from all
    its terms.
    """
    counted = texts.select(*keys, pair_counts(F.col("own"), F.col("edited")).alias("pairs"))
    near = [(_NEAR / F.greatest(F.aggregate("pairs", F.lit(0).cast("long"), lambda a, x: a + x[kind]), F.lit(1))).alias(f"near_{kind}") for kind in _KINDS]  # noqa: B023
    counted = counted.select(*keys, *near, "pairs")
    most = [F.floor((F.ln(f"near_{kind}") + 1000) * float(1 << 30) - 2).alias(f"most_{kind}") for kind in _KINDS]
    terms = counted.select(*keys, *[f"near_{kind}" for kind in _KINDS], *most, F.explode("pairs").alias("x"))
    rounds = F.explode(F.array(*[F.lit(i) for i in range(0, samples, _AT_ONCE)])).alias("first")
    # ln 0 is null, and so is all that a text draws from a term that it lacks.
    logs = [F.ln(F.col(f"x.{kind}").cast("double")).alias(f"s_{kind}") for kind in _KINDS]
    reach = F.greatest(*[F.col(f"x.{kind}") * F.col(f"near_{kind}") for kind in _KINDS]).alias("reach")
    once = (F.greatest("x.own", "x.edited") == 1).alias("once")
    terms = terms.select(*keys, F.col("x.term").alias("term"), *logs, reach, once, *[f"most_{kind}" for kind in _KINDS]).select("*", rounds)
    terms = terms.withColumns({f"h{i}": F.xxhash64("term", F.col("first") + i) for i in range(_AT_ONCE)})
    terms = terms.withColumns({f"g{i}": F.xxhash64(f"h{i}") for i in range(_AT_ONCE)})
    fixed = {}
    for i in range(_AT_ONCE):
        u = _uniforms(F.col(f"h{i}"), F.col(f"g{i}"))
        fixed |= {f"u{i}": u["r"], f"v{i}": u["c"], f"b{i}": u["b"]}
    terms = terms.withColumns(fixed)
    terms = terms.withColumns({f"can{i}": _least(*[F.col(f"{x}{i}") for x in "ubv"], F.col("once")) <= F.col("reach") for i in range(_AT_ONCE)})
    # The condition always holds. It depends on the row's place, which keeps the filter above the hashes.
    some = F.when(F.monotonically_increasing_id() >= 0, reduce(Column.__or__, [F.col(f"can{i}") for i in range(_AT_ONCE)]))
    terms = terms.withColumn("some", some).where("some")
    fixed = {}
    for i in range(_AT_ONCE):
        fixed |= {f"r{i}": F.when(F.col(f"can{i}"), -F.ln(f"u{i}")), f"c{i}": F.when(F.col(f"can{i}"), F.ln(-F.ln(f"v{i}")))}
    terms = terms.withColumns(fixed)

    def drawn(kind: str, i: int) -> Column:
        size, draw_ = _packed(F.col("term"), F.col(f"s_{kind}"), F.col(f"r{i}"), F.col(f"b{i}"), F.col(f"c{i}"))
        return F.when(size <= F.col(f"most_{kind}"), draw_)

    least = [F.min(drawn(kind, i)).alias(f"{kind}{i}") for kind in _KINDS for i in range(_AT_ONCE)]
    found = terms.groupBy(*keys, "first").agg(*least)
    halves = [F.array(*[_short(F.col(f"{kind}{i}")) for i in range(_AT_ONCE)]).alias(kind) for kind in _KINDS]
    found = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("first", *halves))).alias("rounds"))
    quick = dict(zip(_KINDS, unused([*texts.columns], *[f"__{kind}" for kind in _KINDS])))
    found = found.select(*keys, *[F.slice(F.flatten(F.col(f"rounds.{kind}")), 1, samples).alias(quick[kind]) for kind in _KINDS])
    others = [c for c in texts.columns if c not in (*keys, *_KINDS)]

    def whole(kind: str) -> Column:
        all_drawn = F.coalesce(F.size(quick[kind]) == samples, F.lit(False)) & ~F.exists(quick[kind], lambda x: x.isNull())
        return F.when(all_drawn, F.col(quick[kind])).otherwise(draws_of_all(pair_counts(F.col("own"), F.col("edited")), kind, samples)).alias(kind)

    return texts.select(*keys, *others, *_KINDS).join(found, keys, "left").select(*keys, *others, *[whole(kind) for kind in _KINDS])


def draws_of_all(pairs: Column, kind: str, samples: int) -> Column:
    """A text's fingerprint, drawn from all of its terms; -1 in every place if it has none."""

    def one(p: Column, j: Column) -> Column:
        each = F.transform(p, lambda x: _packed(x["term"], F.ln(x[kind].cast("double")), *draw(x["term"], j))[1])
        return F.coalesce(_short(F.array_min(each)), F.lit(-1))

    places = F.sequence(F.lit(0), F.lit(samples - 1))
    return let(pairs, lambda p: F.transform(places, lambda j: one(p, j)))


def _short(x: Column) -> Column:
    """32 bits of a draw's hash; null where there is none."""
    return F.when(x.isNotNull(), F.shiftright(F.xxhash64(x), 32).cast("int"))


def as_text(draws_: Column) -> Column:
    return F.array_join(F.transform(draws_, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(one: Column, two: Column) -> Column:
    same = F.zip_with(one, two, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda a, x: a + x) / F.size(one)


def neighbours(docs: DataFrame) -> DataFrame:
    """Each document's key, and the key of the next one in descending order; the first follows the last.

    ``docs`` has one row for each key (id, known, text_id). Sorted by ranges; only the first key of
    each range is compared across ranges.
    """
    order = [F.desc("known"), F.desc("id"), F.desc("text_id")]
    parts = shared.shuffle_partitions(docs.sparkSession)
    ranged = docs.select(*_KEY).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = shared.written(ranged.select("part", F.struct("known", "id", "text_id").alias("me")), "ranges")
    own = ranged.withColumn("next", F.lead("me").over(Window.partitionBy("part").orderBy(F.desc("me"))))
    firsts = ranged.groupBy("part").agg(F.max("me").alias("first"))  # a row for each range
    every = Window.orderBy("part")
    around = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("first").over(every), F.first("first").over(around))
    firsts = firsts.select("part", following.alias("following"))
    out = own.join(F.broadcast(firsts), "part").select("me", F.coalesce("next", "following").alias("next"))
    return out.select(*[F.col(f"me.{c}").alias(c) for c in _KEY], *[F.col(f"next.{c}").alias(f"next_{c}") for c in _KEY])


def with_edited(docs: DataFrame) -> DataFrame:
    """One row for each different (doc_id, text): its text, an edited text, how often it occurs, and the key before it.

    The edited text's last ``n_chars // 2`` characters are replaced by the first as many of the next
    document. Rows that agree in doc_id and text are one document here; documents with one doc_id
    are ordered by a hash of their texts; null doc_ids come last. Null text is empty.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    own = own.groupBy(*_KEY).agg(F.first("text").alias("text"))  # used twice below, shuffled once
    keys = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"), F.xxhash64(text).alias("text_id"), F.length(text).alias("n"))
    keys = keys.groupBy(*_KEY).agg(F.first("n").alias("n"), F.count("*").alias("copies"))
    links = neighbours(keys)
    asked = links.join(keys, _KEY).select(*[F.col(f"next_{c}").alias(c) for c in _KEY], *[F.col(c).alias(f"for_{c}") for c in _KEY], F.floor(F.col("n") / 2).cast("int").alias("need"), "copies")
    asking = own.join(asked, _KEY)
    given = asking.select(*[F.col(f"for_{c}").alias(c) for c in _KEY], F.col("text").substr(F.lit(1), F.col("need")).alias("given"), "copies")
    before = asked.select(*_KEY, *[F.col(f"for_{c}").alias(f"before_{c}") for c in _KEY])
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - F.floor(n / 2).cast("int")), F.col("given")).alias("edited")
    return own.join(given, _KEY).join(before, _KEY).select(*_KEY, *[f"before_{c}" for c in _KEY], "copies", "text", edited)


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every row's text and edited text (see ``with_edited``), and likenesses.

    Returns doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (hexadecimal),
    near_edited and near_next. Equal texts have equal fingerprints; texts without words have one of
    their own. Repeated rows come back as often as they are there. Other columns are not read.
    """
    edited = with_edited(docs)
    before = [f"before_{c}" for c in _KEY]
    facts = [F.length("text").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha")]
    drawn = fingerprints(edited.select(*_KEY, *before, "copies", *facts, F.col("text").alias("own"), "edited"), _KEY, samples)
    # Each row goes to its key, and its fingerprint to the key before it: one shuffle, nothing written.
    here = F.struct(*[F.col(c).alias(c) for c in _KEY], F.struct("copies", "n_chars", "sha", *_KINDS).alias("here"), F.lit(None).cast("array<int>").alias("after"))
    there = F.struct(*[F.col(b).alias(c) for b, c in zip(before, _KEY)], F.lit(None).alias("here"), F.col("own").alias("after"))
    sent = drawn.select(F.explode(F.array(here, there)).alias("x")).select("x.*")
    out = sent.groupBy(*_KEY).agg(F.max("here").alias("here"), F.max("after").alias("after")).select(*_KEY, "here.*", "after")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
