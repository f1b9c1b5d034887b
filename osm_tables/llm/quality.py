"""Quality rules: how much more a text looks like trusted documents than like the raw corpus.

A text is cut into tokens: words, out of which runs of odd marks (ASCII punctuation but for ``.,'-``)
are cut as tokens of their own, so that they count whatever word they cling to. Tokens and pairs of
tokens are hashed into ``buckets``. Two multinomials over the buckets are counted: one over trusted
documents, one over all documents, whose counts are scaled to the number of trusted tokens; both get ``prior`` added to each bucket, so
that a bucket says little while few tokens are expected in it. A text's score is the mean over its
n-grams of ``ln(p_trusted / p_raw)``; it is kept if simple rules hold and the score reaches
``threshold``. The same text always gets the same verdict.

Everything is DataFrame functions. The counts are summed before they are shuffled, and only the
``buckets`` weights, one array, reach the tasks, as a scalar subquery; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osm_tables.llm.shared import unused

BUCKETS = 1 << 14
#: Trusted documents are at most so many of the labelled ones, those with the smallest hashed ids.
MAX_TRUSTED = 20_000
THRESHOLD = -0.35
PRIOR = 5.0
MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]+"
_MARK = r"[!-&(-+/:-@\[-`{-~]"
_PLACE_BITS = 21
_PLACE = (1 << _PLACE_BITS) - 1


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    one_space = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(one_space, " ", -1), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def has_marks(text: Column) -> Column:
    return F.coalesce(text.rlike(_MARK), F.lit(False))


def token_hashes(text: Column, word_hashes: Column) -> Column:
    """Hashes of a text's tokens; those of its words if it has no odd marks."""
    apart = F.regexp_replace(text, f"({_MARK}+)", " $1 ")
    return F.when(has_marks(text), hashes_of(words_of(apart))).otherwise(word_hashes)


def pairs_of(hashes: Column) -> Column:
    """Hashes of all neighbouring words."""
    n = F.size(hashes)
    pairs = F.zip_with(hashes, F.slice(hashes, 2, n), lambda x, y: F.xxhash64(x, y))
    return F.slice(pairs, 1, F.greatest(n - 1, F.lit(0)))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(_WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column, hashes: Column, pairs: Column) -> Column:
    """Words within windows of three that are found twice or more.

    The windows' hashes are sorted with their places, in one number while places fit (``2**21``
    words), so equal windows become neighbours; neighbours of equal hash are compared word by word.
    """

    def count(key, alike, place) -> Column:
        def same(x: Column, y: Column) -> Column:
            i, j = place(x), place(y)
            equal = alike(x, y)
            for k in range(3):
                equal = equal & (words[i + k] == words[j + k])
            return equal

        def places(s: Column) -> Column:
            pairs = F.transform(s, lambda x, k: F.when(same(x, F.get(s, k + 1)), F.array(place(x), place(F.get(s, k + 1)))))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

        def covered(p: Column) -> Column:
            each = F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x))  # least() skips the last null
            return F.aggregate(each, F.lit(0), lambda a, x: a + x)

        windows = F.slice(pairs, 1, F.greatest(F.size(pairs) - 1, F.lit(0)))
        keys = F.transform(windows, lambda x, i: key(F.xxhash64(x, hashes[i + 2]), i))
        return let(let(F.sort_array(keys), places), covered)

    packed = count(
        lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")),
        lambda x, y: F.shiftright(x.bitwiseXOR(y), _PLACE_BITS) == 0,
        lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int"),
    )
    wide = count(lambda h, i: F.struct(h.alias("h"), i.alias("i")), lambda x, y: x["h"] == y["h"], lambda x: x["i"])
    return F.when(F.size(words) <= _PLACE, packed).otherwise(wide)


def ngram_weights(
    docs: DataFrame, labels: DataFrame, *, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED, prior: float = PRIOR
) -> DataFrame:
    """One row, one array: ``ln(p_trusted / p_raw)`` of each bucket.

    Trusted are the documents that ``labels`` (doc_id, quality) gives quality 1, ``max_trusted`` of
    them at most; raw are all documents. With no trusted text all weights are 0.
    """
    if buckets & (buckets - 1):
        raise ValueError(f"buckets {buckets} is no power of two")
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__trusted")).distinct()
    trusted = trusted.orderBy(F.xxhash64("__trusted"), "__trusted").limit(max_trusted)
    own = docs.select("doc_id", "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("__trusted"), "left")
    own = own.select(F.col("__trusted").isNotNull().cast("long").alias("trusted"), token_hashes(F.col("text"), hashes_of(words_of(F.col("text")))).alias("h"))
    grams = own.select("trusted", F.explode(F.concat("h", pairs_of(F.col("h")))).alias("h"))
    grams = grams.select("trusted", F.col("h").bitwiseAND(F.lit(buckets - 1)).cast("int").alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good"))
    all_ = docs.sparkSession.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    counts = all_.join(counts, "bucket", "left").select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("raw", "good")])
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("c"), F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"))

    def weight(x: Column) -> Column:
        expected = x["raw"] * F.col("n_good") / F.col("n_raw")
        return F.when(F.col("n_good") > 0, F.ln((x["good"] + prior) / (expected + prior))).otherwise(F.lit(0.0))

    return listed.select(F.transform("c", lambda x: weight(x).cast("float")).alias("weights"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    buckets: int = BUCKETS,
    max_trusted: int = MAX_TRUSTED,
    prior: float = PRIOR,
    threshold: float = THRESHOLD,
    name: str = "verdict",
) -> DataFrame:
    """``docs`` with a struct called ``name``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score (null without words) and kept.

    Null text has no words and fails, as texts of under 50 words do. Repeated rows and texts get the
    same verdict each. Ties at the threshold are kept. Other columns pass through unread; one called
    like ``name`` is replaced. With no trusted label only the rules decide.
    """
    weights = ngram_weights(docs, labels, buckets=buckets, max_trusted=max_trusted, prior=prior).scalar()
    # Helper columns have names that the documents lack.
    w, h, p, t, q, held, v = unused(docs.columns, "__w", "__h", "__p", "__t", "__q", "__weights", "__v")
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.withColumn(w, words_of(F.col("text"))).withColumn(held, weights)
    counted = counted.withColumn(h, hashes_of(F.col(w))).withColumn(p, pairs_of(F.col(h)))
    counted = counted.withColumn(t, token_hashes(F.col("text"), F.col(h)))
    counted = counted.withColumn(q, F.when(has_marks(F.col("text")), pairs_of(F.col(t))).otherwise(F.col(p)))

    def log_ratio(hashes: str) -> Column:
        bucket = lambda x: x.bitwiseAND(F.lit(buckets - 1)).cast("int")
        return F.aggregate(hashes, F.lit(0.0), lambda a, x: a + F.col(held)[bucket(x)])

    total = (log_ratio(t) + log_ratio(q)) / (F.size(t) + F.size(q))
    counted = counted.withColumn(
        v,
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, _SYMBOL, ""))).cast("long").alias("n_symbols"),
            duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines"),
            repeated_words(F.col(w), F.col(h), F.col(p)).cast("long").alias("n_repeat_words"),
            F.when(F.size(w) > 0, total).alias("score"),
        ),
    )
    verdict = let(F.col(v), lambda x: F.struct(
        *[x[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        ((x["n_words"] < MIN_WORDS) | (100 * x["n_repeat_words"] > 50 * x["n_words"])).alias("base_failed"),
        x["score"].alias("score"),
        ((x["n_words"] >= MIN_WORDS) & (100 * x["n_repeat_words"] <= 50 * x["n_words"]) & (x["score"] >= threshold)).alias("kept"),
    ))
    # The condition always holds. It depends on the row's place, which keeps a filter on the verdict above
    # this projection; pushed below it, the filter would compute words and hashes again for every use.
    verdict = F.when(F.monotonically_increasing_id() >= 0, verdict)
    return counted.withColumn(name, verdict).drop(w, h, p, t, q, held, v)
