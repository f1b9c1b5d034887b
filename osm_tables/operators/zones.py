"""What each blob holds, beside where it is: kinds, ids, places and times."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schema as S
from ..options import ENTITY_TYPES, OsmReadOptions
from ..plans.splits import FileRange
from ..sources.blobs import DATA_BLOB, HEADER_BLOB, Blob, blobs_of_range
from ..sources.decode import check_header, decode_blob
from ..sources.reader import DATA_CHUNK, FileSet, over_ranges, planned_files, with_settings

_RANGES = ((S.ID, T.LongType()), (S.LATITUDE, T.DoubleType()), (S.LONGITUDE, T.DoubleType()), (S.TIMESTAMP, T.LongType()))
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("data_offset", T.LongType(), False),
        T.StructField("datasize", T.LongType(), False),
        T.StructField("blob_type", T.StringType(), False),
        *(T.StructField(f"n_{kind.lower()}s", T.LongType()) for kind in ENTITY_TYPES),
        *(T.StructField(f"{end}_{name}", kind) for name, kind in _RANGES for end in ("min", "max")),
    ]
)
BATCH_ROWS = 10_000
_WANTED = S.to_arrow_schema(S.osm_schema(OsmReadOptions(), [S.ENTITY_TYPE, *(name for name, _ in _RANGES)]))


def _zones(contents: memoryview) -> list:
    """Entities of each kind, and least and greatest of each range; null where no entity has a value."""
    counts = dict.fromkeys(ENTITY_TYPES, 0)
    ends: dict[str, list] = {name: [] for name, _ in _RANGES}
    for batch in decode_blob(contents, "", _WANTED, frozenset(ENTITY_TYPES)):
        if batch.num_rows:
            counts[batch.column(0)[0].as_py()] += batch.num_rows
            for name, found in ends.items():
                found += [x for x in pc.min_max(batch.column(name)).as_py().values() if x is not None]
    return [*counts.values(), *(end(found, default=None) for found in ends.values() for end in (min, max))]


def blob_zones(spark: SparkSession, paths: str | Sequence[str], partitions: int = 1) -> DataFrame:
    """One row per blob: where it is, how many entities of each kind it holds, and the ranges of their ids,
    coordinates and times (null for a blob that is no data blob, or in which no entity has the value).

    Made by one pass over the files, to be stored as a table: `read_indexed` reads only blobs that can
    hold what is asked for. A file that demands an unknown feature, or cannot be decoded, is an error here.
    """
    options = with_settings(paths, None, {"partitions": partitions})
    files, schema = planned_files(spark, options), S.to_arrow_schema(ZONE_SCHEMA)

    def row(name: str, blob: Blob, contents: memoryview) -> list:
        kind = blob.blob_type.lower()
        if kind == HEADER_BLOB.lower():
            check_header(contents)
        known = _zones(contents) if kind == DATA_BLOB.lower() else [None] * (len(ZONE_SCHEMA) - 6)
        return [name, blob.offset, blob.end - blob.offset, blob.data_offset, blob.datasize, blob.blob_type, *known]

    def rows(files: FileSet, part: FileRange) -> Iterator[list]:
        with files.open(part.file_no, DATA_CHUNK, until=part.stop) as source:
            for blob in blobs_of_range(source, part.start, part.stop):
                try:
                    yield row(files.names[part.file_no], blob, source.read(blob.data_offset, blob.datasize))
                except Exception as e:
                    raise ValueError(f"{source.location}: blob at offset {blob.offset}: {e}") from e

    def walk(files: FileSet, _: int, part: FileRange) -> Iterator[pa.RecordBatch]:
        found = rows(files, part)
        while chunk := list(islice(found, BATCH_ROWS)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*chunk), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return over_ranges(spark, files, walk, ZONE_SCHEMA)
