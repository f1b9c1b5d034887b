"""One state of each entity, and what changed between two extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S

_KEY = [S.ENTITY_TYPE, S.ID]


def latest_entities(entities: DataFrame) -> DataFrame:
    """The row of every (kind, id) with the greatest version, as overlapping extracts hold it several times.

    Missing versions are least; ties go to the later timestamp, then the greater changeset, then the greater
    hash of the row, so the same rows give the same result however they are dealt out. Whole rows are shuffled
    once, after the rows of one task have been reduced to the latest of each entity. Extracts have no deleted
    entities, so an entity that is missing in a later extract stays; `extract_diff` tells of those.
    """
    order = [F.coalesce(F.col(c), F.lit(-(2**31)).cast("long")) for c in (S.VERSION, S.TIMESTAMP, S.CHANGESET)]
    order.append(F.xxhash64(*[F.col(f"`{c}`") for c in entities.columns]))
    row = F.struct(*[F.col(f"`{c}`") for c in entities.columns])
    kept = entities.groupBy(*_KEY).agg(F.max_by(row, F.struct(*order)).alias("row"))
    return kept.select("row.*")


def extract_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``entity_type, id, change, before_version, after_version`` of every entity in which two extracts differ.

    ``change`` is ``created``, ``deleted`` or ``modified``; modified means that the latest row differs in any
    column that both have. Kinds, ids, versions and 64-bit hashes are compared, not whole rows: no tags are shuffled twice.
    """
    shared = [c for c in before.columns if c in after.columns]

    def narrow(df: DataFrame, name: str) -> DataFrame:
        # Order within the row is that of latest_entities, so its hash is the latest row's.
        versions = [F.coalesce(F.col(c), F.lit(-(2**31)).cast("long")) for c in (S.VERSION, S.TIMESTAMP, S.CHANGESET)]
        content = F.xxhash64(*[F.col(f"`{c}`") for c in shared])
        return df.groupBy(*_KEY).agg(F.max(F.struct(*versions, content.alias("content"), F.col(S.VERSION).alias("version"))).alias(name))

    both = narrow(before, "old").join(narrow(after, "new"), _KEY, "full")
    change = (
        F.when(F.col("old").isNull(), "created").when(F.col("new").isNull(), "deleted").when(F.col("old.content") != F.col("new.content"), "modified")
    )
    out = both.select(*_KEY, change.alias("change"), F.col("old.version").alias("before_version"), F.col("new.version").alias("after_version"))
    return out.where(F.col("change").isNotNull())
