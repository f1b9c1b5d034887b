"""``spark.read.format("osm_pbf")``: the same reader as a named data source, usable from SQL."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .. import schema as S
from ..options import FORMAT, OsmReadOptions
from ..plans.splits import FileRange
from .files import s3_settings
from .reader import FileSet, entity_decoder, file_set, one_file, scan_range, size_in_bytes, split_settings

# Options of this source only. ``columns`` names the wanted columns, separated by commas, because
# Spark does not tell a Python source which columns a query uses. The others are Spark's own settings,
# which this source takes when it is registered; as options they hold for one read. So do Hadoop's
# ``fs.s3a.*`` settings for access.
COLUMNS = "columns"
MAX_PARTITION_BYTES = "maxPartitionBytes"
OPEN_COST = "openCostInBytes"
DEDUP_POLICY = "mapKeyDedupPolicy"


class TaskPartition(InputPartition):
    """The ranges of one task: name, location, size, start and stop of each."""

    def __init__(self, ranges: list[tuple[str, str, int, int, int]]):
        super().__init__(ranges)


class OsmReader(DataSourceReader):
    """Reads the selected kinds; the ``types`` option selects them, filters do not.

    It takes no filters from Spark: Spark keeps one reader for all queries on a loaded DataFrame, so
    a filter pushed by one query would also remove rows from the next.
    """

    def __init__(self, options: OsmReadOptions, schema: StructType, settings: dict, last_wins: bool):
        self._decode = entity_decoder(schema, options.selected_types, last_wins)
        self._s3 = tuple((settings.get("s3") or {}).items())
        self._files: FileSet | None = file_set(options.paths, options.partitions, **settings)

    def __getstate__(self) -> dict:
        # Spark copies the reader to every task; the list of files stays where the plan is made.
        return self.__dict__ | {"_files": None}

    def partitions(self) -> list[InputPartition]:
        files = self._files
        parts = (files.plan.ranges_of(n) for n in range(files.plan.n_tasks))
        return [
            TaskPartition([(files.names[p.file_no], files.locations[p.file_no], files.plan.sizes[p.file_no], p.start, p.stop) for p in ranges])
            for ranges in parts
        ]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for name, location, size, start, stop in partition.value:
            yield from scan_range(one_file(name, location, size, self._s3), FileRange(0, start, stop), self._decode)


def _settings(options: Mapping[str, str], registered: dict) -> dict:
    """Split settings as registered, unless options say otherwise; option names ignore case."""
    given = {k.lower(): v for k, v in options.items()}
    out = dict(registered)
    for option, name in ((MAX_PARTITION_BYTES, "max_partition_bytes"), (OPEN_COST, "open_cost_bytes")):
        if option.lower() in given:
            out[name] = size_in_bytes(given[option.lower()])
    out["s3"] = out["s3"] | s3_settings(given)
    return out


def _accepted(options: OsmReadOptions, asked: StructType) -> StructType:
    """The canonical schema for the columns of ``asked``, whose types must be the canonical ones."""
    canonical = S.osm_schema(options, asked.names)
    for mine, theirs in zip(canonical.fields, asked.fields):
        if mine.dataType.simpleString() != theirs.dataType.simpleString():
            raise ValueError(
                f"column {mine.name!r} is {mine.dataType.simpleString()}, "
                f"not {theirs.dataType.simpleString()}"
            )
    return canonical


def register_osm(spark: SparkSession) -> None:
    """Make the format known to this session.

    The source plans in a process without a session, so the session's split settings and its policy
    for repeated map keys are taken now; options of the same names override them for one read.
    """
    settings = split_settings(spark)
    policy = spark.conf.get("spark.sql.mapKeyDedupPolicy")

    class OsmDataSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> StructType:
            columns = [c.strip() for c in self.options.get(COLUMNS, "").split(",") if c.strip()]
            return S.osm_schema(OsmReadOptions.parse(self.options), columns or None)

        def reader(self, schema: StructType) -> DataSourceReader:
            options = OsmReadOptions.parse(self.options)
            last_wins = self.options.get(DEDUP_POLICY, policy).upper() == "LAST_WIN"
            own = _settings(self.options, settings)
            return OsmReader(options, _accepted(options, schema), own, last_wins)

    spark.dataSource.register(OsmDataSource)
