"""``read_osm``: files to an entity DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.entities import tags_as_map
from ..options import OsmReadOptions
from ..plans.splits import FileCut, FileRange, Plan, SplitPlan, plan_splits, split_bytes
from ..predicates import Where
from .blobs import DATA_BLOB, HEADER_BLOB, blobs_of_range
from .decode import check_header, decode_blob
from .files import S3_SETTINGS, ReadAhead, file_sizes, s3_settings, to_location

# The contents of a data blob and the file's name, to record batches.
BlobDecoder = Callable[[memoryview, str], Iterator[pa.RecordBatch]]

DATA_CHUNK = 4 * 1024 * 1024
HEADER_CHUNK = 1024 * 1024
#: File lists up to this size are sent to every executor.
BROADCAST_BYTES = 1024 * 1024
#: Bytes of a file for each row that Spark's optimizer is told of, 8 bytes each before they are decoded.
ROW_BYTES = 8


@dataclass(frozen=True)
class FileSet:
    """The files of one read: the text the user gave, where each is, and how they are cut."""

    names: tuple[str, ...]
    locations: tuple[str, ...]
    plan: Plan
    s3: tuple[tuple[str, str], ...] = ()

    def open(self, file_no: int, chunk_bytes: int, until: int = 0) -> ReadAhead:
        size = self.plan.sizes[file_no]
        return ReadAhead(self.locations[file_no], size, chunk_bytes, until, dict(self.s3))


def file_set(
    paths: Sequence[str],
    partitions: int,
    max_partition_bytes: int,
    open_cost_bytes: int,
    parallelism: int,
    default_fs: str | None = None,
    s3: Mapping[str, str] | None = None,
) -> FileSet:
    if not paths:
        raise ValueError("no paths to read")
    # The same text is kept once, which halves what a task receives for many plain paths.
    locations = tuple(p if (at := to_location(p, default_fs)) == p else at for p in paths)
    sizes = file_sizes(locations, s3)
    target = split_bytes(sizes, max_partition_bytes, open_cost_bytes, parallelism)
    plan = plan_splits(sizes, target, open_cost_bytes, partitions)
    return FileSet(tuple(paths), locations, plan, tuple((s3 or {}).items()))


def split_settings(spark: SparkSession) -> dict:
    """How the session's file source settings want files to be cut, as arguments of ``file_set``."""

    def setting(name):  # None where neither the user nor Spark sets a value
        return spark.conf.get(name, None)

    parallelism = (
        setting("spark.sql.files.minPartitionNum")
        or setting("spark.sql.leafNodeDefaultParallelism")
        or spark.sparkContext.defaultParallelism
    )
    return {
        "max_partition_bytes": size_in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")),
        "open_cost_bytes": size_in_bytes(spark.conf.get("spark.sql.files.openCostInBytes")),
        "parallelism": int(parallelism),
        "default_fs": default_file_system(spark),
        "s3": session_s3_settings(spark),
    }


def default_file_system(spark: SparkSession) -> str | None:
    """Where paths without a scheme lie, by the session's Hadoop configuration.

    That is made of the cluster's own files and of ``spark.hadoop.*``, so settings alone do not show it.
    """
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")


def session_s3_settings(spark: SparkSession) -> dict[str, str]:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    return s3_settings({name: hadoop.get(name) for name in S3_SETTINGS})


def size_in_bytes(text: str) -> int:
    # Spark's size suffixes.
    units = {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    text = text.strip().lower()
    if text[-1] == "b" and text[-2:-1].isalpha():
        text = text[:-1]
    return int(text) if text[-1].isdigit() else int(text[:-1]) * units[text[-1]]


def scan_range(files: FileSet, part: FileRange, decode: BlobDecoder) -> Iterator[pa.RecordBatch]:
    """What ``decode`` makes of every data blob of a range, one blob in memory at a time."""
    with files.open(part.file_no, DATA_CHUNK, until=part.stop) as source:
        for blob in blobs_of_range(source, part.start, part.stop):
            kind = blob.blob_type.lower()
            if kind not in (DATA_BLOB.lower(), HEADER_BLOB.lower()):
                continue
            try:
                contents = source.read(blob.data_offset, blob.datasize)
                if kind == HEADER_BLOB.lower():
                    check_header(contents)
                else:
                    yield from decode(contents, files.names[part.file_no])
            except Exception as e:
                raise ValueError(f"{source.location}: blob at offset {blob.offset}: {e}") from e


def over_ranges(
    spark: SparkSession,
    files: FileSet,
    read: Callable[[FileSet, int, FileRange], Iterator[pa.RecordBatch]],
    schema: T.StructType,
) -> DataFrame:
    """What ``read`` makes of every range, given its task number; one Spark task for each of the plan.

    Names of a few files go to an executor once, and a task finds its ranges from its number. Beyond
    ``BROADCAST_BYTES`` the files are rows of a table, cut into ranges there and dealt out by task, so
    that a task is sent its own ranges only.

    Spark estimates a result by the rows that go into ``mapInArrow``, and one row per task would pass for a
    table small enough to be gathered on the driver and sent to all tasks in a join. So as many rows as the
    files are long are planned, of which all but one per task are dropped at once.
    """
    n = files.plan.n_tasks
    if len(cloudpickle.dumps(files)) > BROADCAST_BYTES:
        s3 = files.s3

        def read_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task_no, name, location, size, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                    yield from read(one_file(name, location, size, s3), task_no, FileRange(0, start, stop))

        # The estimate of a product is that of its sides multiplied, and that of the ranges is a byte or more for each file.
        weight = spark.range(0, 1 + sum(files.plan.sizes) // (ROW_BYTES * len(files.plan.sizes)), 1, 1).where("id = 0").select()
        ranges = ranges_table(spark, files).crossJoin(F.broadcast(weight))
        return ranges.repartitionById(n, F.col("task_no").cast("int")).mapInArrow(read_rows, schema)

    sent = spark.sparkContext.broadcast(files)

    def read_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = sent.value
        for batch in batches:
            for task_no in batch.column(0).to_pylist():
                for part in files.plan.ranges_of(task_no):
                    yield from read(files, task_no, part)

    rows = 1 + sum(files.plan.sizes) // (ROW_BYTES * n)
    tasks = spark.range(0, n * rows, 1, n).where(f"id % {rows} = 0").selectExpr(f"id div {rows} AS task_no")
    return tasks.mapInArrow(read_task, schema)


def one_file(name: str, location: str, size: int, s3: tuple[tuple[str, str], ...]) -> FileSet:
    return FileSet((name,), (location,), SplitPlan((size,), (0,), max(1, size), 1), s3)


def ranges_table(spark: SparkSession, files: FileSet) -> DataFrame:
    """``task_no, name, location, size, start, stop`` of every range of a plan, made by Spark from one row per file."""
    cuts = files.plan.cuts()
    rows = pa.table(
        {"name": list(files.names), "location": list(files.locations), "size": pa.array(files.plan.sizes, pa.int64())}
        | {name: pa.array([getattr(c, name) for c in cuts], pa.int64()) for name in FileCut._fields}
    )
    last = F.expr("(size - 1 + lead) div step")
    ranges = spark.createDataFrame(rows).where("size > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.greatest(F.lit(0).cast("long"), F.expr("k * step - lead")).alias("start")
    stop = F.least("size", F.expr("(k + 1) * step - lead")).alias("stop")
    return ranges.select((F.col("first_task") + F.col("k")).alias("task_no"), "name", "location", "size", start, stop)


def planned_files(spark: SparkSession, options: OsmReadOptions) -> FileSet:
    return file_set(options.paths, options.partitions, **split_settings(spark))


def scan(
    spark: SparkSession, options: OsmReadOptions, decode: BlobDecoder, schema: T.StructType
) -> DataFrame:
    """A DataFrame of what ``decode`` makes of the data blobs of all files, read range by range."""
    files = planned_files(spark, options)

    def read(files: FileSet, _: int, part: FileRange) -> Iterator[pa.RecordBatch]:
        return scan_range(files, part, decode)

    return over_ranges(spark, files, read, schema)


def with_settings(
    paths: str | Sequence[str], options: OsmReadOptions | None, settings: dict
) -> OsmReadOptions:
    options = replace(options or OsmReadOptions(), **settings)
    return options.with_paths(*([paths] if isinstance(paths, str) else paths))


def read_osm(
    spark: SparkSession,
    paths: str | Sequence[str] = (),
    options: OsmReadOptions | None = None,
    columns: Sequence[str] | None = None,
    where: Where | None = None,
    **settings,
) -> DataFrame:
    """Entities of all ``paths`` as a DataFrame; the files are read when the DataFrame is used.

    ``settings`` are fields of ``OsmReadOptions``. ``columns`` limits what is decoded: Spark cannot
    push a later ``select`` into the decoder, so name the columns here when a few are enough. ``where``
    leaves out entities before they are built; the result is that of ``filter(where.condition())``.
    """
    options = with_settings(paths, options, settings)
    result, decoded = S.osm_schema(options, columns), decoded_schema(options, columns)
    decode = entity_decoder(decoded, options.selected_types, where=where)
    entities = scan(spark, options, decode, decoded)
    return entities.select([as_result(f.name, options) for f in result.fields])


def decoded_schema(options: OsmReadOptions, columns: Sequence[str] | None) -> T.StructType:
    """What tasks decode: maps are made by Spark from lists, and rows without columns need one."""
    decoded = S.osm_schema(replace(options, tags_as_map=False), columns)
    return decoded if decoded.fields else S.osm_schema(options, [S.ENTITY_TYPE])


def entity_decoder(
    schema: T.StructType, types: frozenset[str], last_wins: bool = False, where: Where | None = None
) -> BlobDecoder:
    return partial(decode_blob, schema=S.to_arrow_schema(schema), types=types, last_wins=last_wins, where=where)


def as_result(name: str, options: OsmReadOptions):
    column = F.col(f"`{name}`")
    if name == S.TAGS and options.tags_as_map:
        return tags_as_map(column).alias(name)
    return column
