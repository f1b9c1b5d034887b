"""Reading by a stored table of blobs: only blobs that can match, shared out evenly, nothing searched for."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..options import OsmReadOptions
from ..plans.balance import total_bytes, with_tasks
from ..plans.splits import MAX_TASKS, split_bytes
from ..predicates import Where
from .blobs import DATA_BLOB
from .files import ReadAhead, file_sizes, to_location
from .reader import DATA_CHUNK, BlobDecoder, as_result, decoded_schema, entity_decoder, split_settings

#: Blobs at most so far apart are fetched together with what lies between them.
GAP = 256 * 1024


def selected_blobs(blobs: DataFrame, types: frozenset[str], where: Where | None = None) -> DataFrame:
    """The rows of an index whose blobs can hold a wanted entity.

    Without zones (an index made by `blob_index`) these are all data blobs.
    """
    data = blobs.where(F.lower("blob_type") == DATA_BLOB.lower())
    return data.where((where or Where()).zones(types)) if "min_id" in blobs.columns else data


def read_indexed(
    blobs: DataFrame,
    options: OsmReadOptions | None = None,
    columns: Sequence[str] | None = None,
    where: Where | None = None,
    **settings,
) -> DataFrame:
    """Entities of the files in ``blobs``, a stored table as made by `blob_zones` or `blob_index`.

    The same rows as ``read_osm`` of these files, with the same arguments. Files are opened at the
    offsets that the table has: no range is searched, and no blob read that cannot match. The number of
    tasks follows from the bytes of the blobs that are left, which are summed at once; tasks get their
    blobs as rows, so what a task is sent does not grow with the number of files. A table that is older
    than its files leads to an error or, if blobs still lie where they did, to the files' present content.
    """
    spark = blobs.sparkSession
    options = replace(options or OsmReadOptions(), **settings)
    result, decoded = S.osm_schema(options, columns), decoded_schema(options, columns)
    decode = entity_decoder(decoded, options.selected_types, where=where)
    cut = split_settings(spark)
    chosen = selected_blobs(blobs, options.selected_types, where).select("file", "data_offset", "datasize")
    total = total_bytes(chosen, cut["open_cost_bytes"])
    target = split_bytes([total], cut["max_partition_bytes"], 0, max(cut["parallelism"], options.partitions))
    target = max(target, -(-total // MAX_TASKS))
    tasks = with_tasks(chosen, target, cut["open_cost_bytes"])
    dealt = tasks.repartitionById(total // target + 1, F.col("task")).drop("task").sortWithinPartitions("file", "data_offset")
    default_fs, s3 = cut["default_fs"], cut["s3"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read(batches, decode, default_fs, s3)

    entities = dealt.mapInArrow(read, decoded)
    return entities.select([as_result(f.name, options) for f in result.fields])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Blobs of a file that lie close to each other, in order, as (file, [(offset, size), ...])."""
    file, run = None, []
    for batch in batches:
        for name, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
            if run and (name != file or offset - sum(run[-1]) > GAP or offset < sum(run[-1])):
                yield file, run
                run = []
            file = name
            run.append((offset, size))
    if run:
        yield file, run


def _read(
    batches: Iterator[pa.RecordBatch], decode: BlobDecoder, default_fs: str | None, s3: Mapping[str, str]
) -> Iterator[pa.RecordBatch]:
    name, source = None, None
    with ExitStack() as opened:
        for file, run in _runs(batches):
            if file != name:
                opened.close()
                location = to_location(file, default_fs)
                size = file_sizes([location], s3)[0]
                name, source = file, opened.enter_context(ReadAhead(location, size, DATA_CHUNK, size, s3))
            source.only_until(sum(run[-1]))
            for offset, size in run:
                try:
                    yield from decode(source.read(offset, size), file)
                except Exception as e:
                    raise ValueError(f"{source.location}: blob contents at offset {offset}: {e}") from e
