"""Statistics of tags in sketches that can be kept and merged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

#: Logarithm of the buckets of a distinct count: a standard error of 0.8 %, exact for some hundreds of values.
BUCKETS = 14
#: Tags that are counted at once for one kind; exact up to three quarters of these.
TRACKED = 10_000


def _tags(entities: DataFrame, *columns: str) -> DataFrame:
    """A row for each tag, from tags as an array or as a map."""
    if isinstance(entities.schema[S.TAGS].dataType, T.MapType):
        return entities.select(*columns, F.explode(S.TAGS).alias("key", "value"))
    return entities.select(*columns, F.inline(S.TAGS).alias("key", "value"))


def tag_sketches(entities: DataFrame) -> DataFrame:
    """``entity_type, key, n`` (tags), ``value_sketch, user_sketch`` of each kind and key.

    Sketches are built where entities are read, and only they are shuffled, so a key that all entities have is one
    row of each task. Entities without tags give nothing; tags without a value and entities without a user count
    in ``n`` alone. A key that an entity has twice counts twice.
    """
    # The sketch passes over empty strings, so it takes their hash.
    value = F.when(F.col("value").isNotNull(), F.xxhash64("value"))
    tags = _tags(entities, S.ENTITY_TYPE, S.UID)
    return tags.groupBy(S.ENTITY_TYPE, "key").agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(value, BUCKETS).alias("value_sketch"),
        F.hll_sketch_agg(S.UID, BUCKETS).alias("user_sketch"),
    )


def tag_rollup(*sketches: DataFrame) -> DataFrame:
    """``entity_type, key, n, n_values, n_users`` from one or more tables of `tag_sketches`.

    A row for each kind and key, and one for each key over all kinds, whose ``entity_type`` is null. ``n`` is exact;
    the different values and users are estimates, exact where they are few, and a value or user that
    several tables or kinds have counts once. No entity is read again.
    """
    every = reduce(DataFrame.unionByName, sketches)
    merged = every.groupingSets([[S.ENTITY_TYPE, "key"], ["key"]], S.ENTITY_TYPE, "key").agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("value_sketch")).alias("n_values"),
        F.hll_sketch_estimate(F.hll_union_agg("user_sketch")).alias("n_users"),
    )
    return merged


def heavy_tags(entities: DataFrame, share: float = 0.01, tracked: int = TRACKED) -> DataFrame:
    """``entity_type, key, value, n`` of the tags that make up at least ``share`` of the tags of their kind.

    Counted in one sketch of ``tracked`` tags for each kind. With no more than three quarters of that many different tags
    the result is exact; beyond, no tag above ``share`` is missed while ``share`` exceeds 3.5 / ``tracked``, and ``n``
    is too great by no more than that part of all tags of the kind.
    """
    if not 3.5 / tracked < share <= 1:
        raise ValueError(f"share must be above 3.5 / tracked = {3.5 / tracked:g} and at most 1: {share}")
    tag = F.to_json(F.struct("key", "value"), {"ignoreNullFields": "false"}).alias("tag")
    counted = (
        _tags(entities, S.ENTITY_TYPE)
        .select(S.ENTITY_TYPE, tag)
        .groupBy(S.ENTITY_TYPE)
        .agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k_accumulate(tag, {tracked})").alias("sketch"))
    )
    found = counted.select(S.ENTITY_TYPE, "total", F.expr(f"inline(approx_top_k_estimate(sketch, {tracked}))"))
    tags = found.where(F.col("count") >= F.col("total") * share).select(
        S.ENTITY_TYPE, F.from_json("item", "key string, value string").alias("tag"), F.col("count").alias("n")
    )
    return tags.select(S.ENTITY_TYPE, "tag.key", "tag.value", "n")
