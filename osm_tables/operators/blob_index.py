"""Where the blobs of a set of files are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import ENTITY_TYPES
from ..plans.splits import FileRange
from ..schema import to_arrow_schema
from ..sources.blobs import DATA_BLOB, blobs_of_range
from ..sources.decode import count_blob
from ..sources.files import ReadAhead, file_sizes, to_location
from ..sources.reader import (
    DATA_CHUNK,
    HEADER_CHUNK,
    FileSet,
    default_file_system,
    over_ranges,
    planned_files,
    session_s3_settings,
    with_settings,
)

BLOB_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("data_offset", T.LongType(), False),
        T.StructField("datasize", T.LongType(), False),
        T.StructField("blob_type", T.StringType(), False),
        T.StructField("task_no", T.LongType(), False),
    ]
)
BATCH_ROWS = 10_000


def blob_index(
    spark: SparkSession, paths: str | Sequence[str], partitions: int = 1
) -> DataFrame:
    """One row per blob, from the blobs' headers only; large files are walked by many tasks.

    ``length`` counts the whole blob with its header; ``task_no`` is the read task that owns it.
    """
    options = with_settings(paths, None, {"partitions": partitions})
    files, schema = planned_files(spark, options), to_arrow_schema(BLOB_SCHEMA)

    def rows(files: FileSet, task_no: int, part: FileRange) -> Iterator[tuple]:
        # Blobs are mostly smaller than a window, so windows are read one after another, ahead.
        with files.open(part.file_no, HEADER_CHUNK, until=part.stop) as source:
            for b in blobs_of_range(source, part.start, part.stop):
                where = (b.offset, b.end - b.offset, b.data_offset, b.datasize)
                yield (files.names[part.file_no], *where, b.blob_type, task_no)

    def walk(files: FileSet, task_no: int, part: FileRange) -> Iterator[pa.RecordBatch]:
        found = rows(files, task_no, part)
        while chunk := list(islice(found, BATCH_ROWS)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*chunk), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return over_ranges(spark, files, walk, BLOB_SCHEMA)


def count_at(blobs: DataFrame) -> DataFrame:
    """(file, entity_type, count) of the data blobs of an index, read only where the index says they are."""
    spark = blobs.sparkSession
    default_fs, s3 = default_file_system(spark), session_s3_settings(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        try:
            for batch in batches:
                found = []
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != name:
                        if source is not None:
                            source.__exit__()
                        location = to_location(file, default_fs)
                        file_size = file_sizes([location], s3)[0]
                        name, source = file, ReadAhead(location, file_size, DATA_CHUNK, s3=s3)
                    counts = count_blob(source.read(offset, length), frozenset(ENTITY_TYPES))
                    found += [(file, kind, n) for kind, n in counts.items()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["file", "entity_type", "count"])
        finally:
            if source is not None:
                source.__exit__()

    data = blobs.where(F.col("blob_type") == DATA_BLOB).select("file", "data_offset", "datasize")
    counted = data.mapInArrow(count, "file string, entity_type string, count bigint")
    return counted.groupBy("file", "entity_type").agg(F.sum("count").alias("count"))
