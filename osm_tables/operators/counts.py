"""Counting entities."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..options import OsmReadOptions
from ..sources.decode import count_blob
from ..sources.reader import scan, with_settings

COUNT_SCHEMA = T.StructType(
    [T.StructField(S.ENTITY_TYPE, T.StringType(), False), T.StructField("count", T.LongType(), False)]
)


def count_by_type(
    spark: SparkSession,
    paths: str | Sequence[str] = (),
    options: OsmReadOptions | None = None,
    **settings,
) -> DataFrame:
    """(entity_type, count), as ``read_osm(...).groupBy("entity_type").count()`` would give it.

    Entities are counted where they are read: a blob becomes one row per kind, not one per entity.
    """
    options = with_settings(paths, options, settings)
    types, schema = options.selected_types, S.to_arrow_schema(COUNT_SCHEMA)

    def count(blob: memoryview, _: str) -> Iterator[pa.RecordBatch]:
        counts = count_blob(blob, types)
        columns = [pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    per_blob = scan(spark, options, count, COUNT_SCHEMA).filter(F.col("count") > 0)
    return per_blob.groupBy(S.ENTITY_TYPE).agg(F.sum("count").alias("count"))
