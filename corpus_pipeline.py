"""From raw documents to packed training sequences, a stage at a time.

Each stage reads the documents that the one before it wrote, and all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from osm_tables.llm import language, near, packing, quality
from osm_tables.llm.queries import ship, table, tokenizer_path
from osm_tables.llm.shared import new_table, unused

#: A text of which less than this share of the trigrams belongs to one learned language is rejected.
MIN_LANGUAGE_SCORE = 0.2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go, and every copy of a text fares alike."""
    (name,) = unused(docs.columns, "verdict")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), name=name)
    return judged.where(f"{name}.kept").select(*[f"`{c}`" for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents' own labels, all of them, teach; null texts and those without letters go."""
    ship(spark)
    filters = language.train_filters(docs)
    names = tuple(unused(docs.columns, "lang_pred", "lang_score"))
    found = language.identify(docs, filters, names=names)
    found = found.where(f"{names[0]} != '{language.UNKNOWN}' AND {names[1]} >= {MIN_LANGUAGE_SCORE}")
    return found.select(*[f"`{c}`" for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of repeated rows one stays."""
    ship(spark)
    return near.keep_first(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, in sequences; without documents, none."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("packing", packed),
]

#: Learned thresholds, MinHash and token ids have no SQL; ``tests/llm`` compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    place = new_table(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{i}-{name}")
        docs = spark.read.parquet(f"{place}/{i}-{name}")
    return docs
