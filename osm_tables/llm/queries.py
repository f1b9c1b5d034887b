"""The registered queries of the operators in this package."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from osm_fixtures.shipping import ship_packages
from osm_tables.llm import (
    chat,
    divergence,
    language,
    licences,
    multi_index,
    near,
    packing,
    pitman_yor,
    quality,
    sentence_pieces,
    urls,
    vector_codes,
    weighted,
)

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Workers of a session that was started elsewhere cannot import from this directory."""
    ship_packages(spark, _ROOT, "osm_tables", "osm_fixtures")


def held_out(modulus: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == 2, F.lit(False))


def op1_language_id(spark, sf_dir):
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = language.train_filters(docs.where(~held_out(4)))
    found = language.identify(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


def op2_lm_scoring(spark, sf_dir):
    ship(spark)
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"), held_out(7))


def op3_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "verdict.*")


def op4_license_scans(spark, sf_dir):
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6))  # sums of weights differ in their last bits


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark, sf_dir):
    ship(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_ngram_jaccard_join(spark, sf_dir):
    ship(spark)
    found = near.jaccard_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_shingles", "n_links")


def op7_document_fingerprints(spark, sf_dir):
    return weighted.fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    ship(spark)
    path = tokenizer_path("piece_bpe_32k.model")
    return sentence_pieces.digests(sentence_pieces.encode_documents(table(spark, sf_dir, "documents"), path), path)


def op9_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, urls.train(spark)).select("page_id", "host", "path", "rule", "verdict")


def op10_chat_formatting(spark, sf_dir):
    ship(spark)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = [F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text"))
            for i, r in enumerate(["user", "assistant"])]
    rows = rows.unionByName(spark.range(0, 1, 1, 1).select(F.explode(F.array(*more)).alias("x")).select("x.*"))
    path = tokenizer_path("byte_bpe_50k.json")
    return chat.read_back(chat.format_conversations(rows, path), path)


def op11_nearest_neighbours(spark, sf_dir):
    ship(spark)
    rows = table(spark, sf_dir, "embeddings")
    return multi_index.search(rows, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op12_vector_codes(spark, sf_dir):
    ship(spark)
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    rows = vector_codes.with_label_errors(found.rows)
    return rows.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256")
    )


def op13_source_divergence(spark, sf_dir):
    ship(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_quality_rules": op3_quality_rules,
        "op4_license_scans": op4_license_scans,
        "op5_packing": op5_packing,
        "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
        "op7_document_fingerprints": op7_document_fingerprints,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_url_filters": op9_url_filters,
        "op10_chat_formatting": op10_chat_formatting,
        "op11_nearest_neighbours": op11_nearest_neighbours,
        "op12_vector_codes": op12_vector_codes,
        "op13_source_divergence": op13_source_divergence,
        "pipeline": pipeline,
    }


_CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), measured AS (
    SELECT *, role || chr(10) || text || chr(10) AS said,
           CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
           14 + length(regexp_replace(role, '([\\#:]|</turn>)', '\\\1', 'g'))
              + length(regexp_replace(text, '([\\#]|</turn>)', '\\\1', 'g')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
       sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM measured GROUP BY conv_id"""


# Every pair of documents that share a shingle is counted here; the query's forest finds its pairs otherwise.
_JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents
), runs AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
                        ELSE list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4]) END AS runs
    FROM worded
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(unnest(runs), ' ') AS run FROM runs
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingle a JOIN shingle b ON a.run = b.run AND a.doc_id <> b.doc_id
         JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 9 * count(*) >= 4 * (x.n + y.n)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reached.a, link.b FROM reached JOIN link ON link.a = reached.b
)
SELECT d.doc_id, min(r.b) AS class_id, coalesce(max(s.n), 0) AS n_shingles, coalesce(max(l.n), 0) AS n_links
FROM documents d JOIN reached r ON r.a = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id
     LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = d.doc_id
GROUP BY d.doc_id"""


def _licence_sql() -> str:
    """The templates as tables, and the same index, intersection and thresholds in SQL."""
    known = licences.templates()
    templates = ", ".join(f"({i}, '{t.label}', {t.base})" for i, t in enumerate(known))
    places = ", ".join(
        f"({i}, {at}, '{word}', {at in t.key_places()})" for i, t in enumerate(known) for at, word in enumerate(t.words)
    )
    return rf"""
WITH template(t, label, base) AS (VALUES {templates}), place(t, pos, word, is_key) AS (VALUES {places}),
worded AS (
    SELECT row_number() OVER () AS row_no, doc_id, list_filter(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), said AS (
    SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM worded
), seen AS (
    SELECT word, count(DISTINCT row_no) AS n FROM said GROUP BY word
), weighed AS (
    SELECT t, pos, word, is_key, ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / (coalesce(n, 0) + 1)) + 1e-3 AS idf
    FROM place LEFT JOIN seen USING (word)
), posting AS (
    SELECT * FROM weighed QUALIFY is_key OR row_number() OVER (PARTITION BY t, is_key ORDER BY idf DESC, pos) <= {licences.RARE}
), total AS (
    SELECT t, sum(idf) AS weight, count(*) FILTER (is_key) AS keys FROM posting GROUP BY t
), met AS (
    SELECT row_no, t, said.pos - posting.pos AS start, sum(idf) AS weight, count(*) FILTER (is_key) AS keys
    FROM said JOIN posting USING (word) GROUP BY ALL
), found AS (
    SELECT row_no, start, label, base, least(met.weight / total.weight, 1.0) AS share
    FROM met JOIN total USING (t) JOIN template USING (t)
    WHERE met.keys = total.keys AND met.weight / total.weight >= {licences.THRESHOLD}
)
SELECT doc_id, any_value(len(words)) AS n_words, count(*) FILTER (base) AS n_base,
       min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       round(coalesce(max(share), 0.0), 6) AS score
FROM worded LEFT JOIN found USING (row_no) GROUP BY row_no, doc_id"""


# The inner product of every query with every row, its products added in order.
_NEAREST_SQL = """
WITH kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), near AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]), lambda a, b: a + b) AS score,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]), lambda a, b: a + b) DESC, c.vec_id) AS rank
    FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM near WHERE rank <= 20"""


def _vector_codes_sql() -> str:
    """Every part against every entry of its codebook, once for each round."""
    kept = f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, vec_id, label, embedding AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), piece AS (
    SELECT row_no, p, pos, CAST(floor({vector_codes.SCALE} * CAST(v[p * (len(v) // {vector_codes.PARTS}) + pos] AS DOUBLE)) AS BIGINT) AS x
    FROM kept, range({vector_codes.PARTS}) a(p), unnest(range(1, len(v) // {vector_codes.PARTS} + 1)) b(pos)
), first AS (
    SELECT row_no, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS e FROM kept QUALIFY e < {vector_codes.ENTRIES}
), book0 AS (SELECT p, e, pos, x FROM piece JOIN first USING (row_no))"""
    steps = [kept]
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"""near{i} AS (
    SELECT row_no, p, e, sum((s.x - b.x) * (s.x - b.x)) AS far FROM piece s JOIN book{i} b USING (p, pos) GROUP BY row_no, p, e
    QUALIFY row_number() OVER (PARTITION BY row_no, p ORDER BY far, e) = 1
)""")
        if i < vector_codes.ROUNDS:
            steps.append(f"""mean{i} AS (
    SELECT p, e, pos, sum(x) AS s, count(*) AS n FROM near{i} JOIN piece USING (row_no, p) GROUP BY ALL
), book{i + 1} AS (
    SELECT p, e, pos, CAST(CASE WHEN n IS NULL THEN b.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
    FROM book{i} b LEFT JOIN mean{i} USING (p, e, pos)
)""")
    last = vector_codes.ROUNDS
    return f"""
WITH {", ".join(steps)}, coded AS (
    SELECT row_no, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{last} GROUP BY row_no
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(x, ',' ORDER BY p, e, pos)) FROM book{last}) AS codebooks_sha256
FROM kept JOIN coded USING (row_no)"""


# Every kept term of every two sources, priced one by one.
_DIVERGENCE_SQL = r"""
WITH doc AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), said AS (
    SELECT row_no, lang, source, unnest(list_filter(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term
    FROM doc
), kept AS (
    SELECT lang, term, count(*) AS total FROM said GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10
), pair AS (SELECT DISTINCT lang, source FROM doc
), n AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL
), of_lang AS (SELECT lang, CAST(sum(total) AS HUGEINT) AS held, count(*) AS kept FROM kept GROUP BY lang
), of_group AS (
    SELECT lang, source, CAST(coalesce(sum(n.n), 0) AS HUGEINT) AS held FROM pair LEFT JOIN n USING (lang, source) GROUP BY ALL
), p AS (
    SELECT lang, source, term, coalesce(n.n, 0) AS n,
           1 + (1000000000 * CAST(coalesce(n.n, 0) + 2 AS HUGEINT)) // (g.held + 2 * l.kept) AS p,
           1 + (1000000000 * CAST(kept.total + 2 AS HUGEINT)) // (l.held + 2 * l.kept) AS q
    FROM of_group g JOIN of_lang l USING (lang) JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)
), valued AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
    FROM pair a JOIN pair b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN valued v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scans": _licence_sql(), "op6_ngram_jaccard_join": _JACCARD_SQL, "op10_chat_formatting": _CHAT_SQL,
            "op11_nearest_neighbours": _NEAREST_SQL, "op12_vector_codes": _vector_codes_sql(), "op13_source_divergence": _DIVERGENCE_SQL}
