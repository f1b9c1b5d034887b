"""Entity files from the driver's tables, written by a Spark job.

Every line item becomes a node, every order a way, every customer a relation. Each entity is made from
its own row alone. Every file is an extract as real ones are: a share of the keys of each table, its nodes,
then its ways, then its relations, by id. Keys are shared out evenly by their size, which no frequent key
can swell; a task writes one share and holds one unfinished block per kind and codec.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import writer
from .shipping import new_shared_directory

BLOCK_ROWS = 8000
#: Files of each codec; tables of more than so many rows of a share get more shares.
SHARES, SHARE_ROWS = 8, 2_000_000
CODECS = ("raw", "zlib")

# Block layouts: (granularity, latitude and longitude offset, date granularity). A block holds one kind.
LAYOUTS = ((100, 0, 0, 1), (50, 500_000, -2_000_000, 1000))
LAYOUT_OF = {writer.PLAIN_NODE: 1, writer.DENSE_NODE: 0, writer.WAY: 0, writer.RELATION: 1}


def _day_millis(column: str):
    return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000


def _texts(*columns):
    return F.array(*[c if not isinstance(c, str) else F.lit(c) for c in columns])


_NO_TEXTS = "array<string>"
_REFS = "array<bigint>"
_MEMBERS = "array<struct<id:bigint,type:int,role:string>>"


def _row(kind, codec_key, **columns):
    def either(name, empty_type):
        return columns.get(name, F.array().cast(empty_type)).alias(name)

    return [
        kind.cast("int").alias("kind"),
        F.floor(codec_key * F.col("shares") / (F.col("greatest") + 1)).cast("int").alias("share"),
        (codec_key % 4 != 0).alias("zlib"),
        columns["id"].cast("long").alias("id"),
        columns["has_info"].alias("has_info"),
        columns["version"].cast("int").alias("version"),
        columns["timestamp"].cast("long").alias("timestamp"),
        columns["changeset"].cast("long").alias("changeset"),
        columns["uid"].cast("int").alias("uid"),
        columns["user"].alias("user"),
        F.when(columns["tagged"], columns["keys"])
        .otherwise(F.array().cast(_NO_TEXTS))
        .alias("keys"),
        F.when(columns["tagged"], columns["values"])
        .otherwise(F.array().cast(_NO_TEXTS))
        .alias("values"),
        columns.get("lat_e7", F.lit(0)).cast("long").alias("lat_e7"),
        columns.get("lon_e7", F.lit(0)).cast("long").alias("lon_e7"),
        either("refs", _REFS),
        either("members", _MEMBERS),
    ]


def _nodes(lineitem: DataFrame) -> DataFrame:
    order, part, supp, line = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    plain = order % 8 == 3
    return lineitem.select(
        _row(
            F.when(plain, writer.PLAIN_NODE).otherwise(writer.DENSE_NODE),
            order,
            id=order * 8 + line,
            has_info=~(plain & (line == 2)),
            version=1 + line % 3,
            timestamp=_day_millis("l_shipdate") + line * 1000,
            changeset=part,
            uid=supp % 1_000_003,
            user=F.concat(F.lit("usér-"), "l_returnflag", "l_linestatus"),
            tagged=part % 5 == 0,
            keys=_texts("highway", "línea"),
            values=_texts(F.concat(F.lit("crossing-"), "l_returnflag"), F.col("l_linestatus")),
            lat_e7=(part * 15_485_863 + order * 7919) % 1_700_000_001 - 850_000_000,
            lon_e7=(supp * 32_452_843 + order * 104_729 + line) % 3_600_000_001 - 1_800_000_000,
        )
    )


def _ways(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    count = (key % 9).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    refs = F.transform(numbers, lambda i: key * 8 + (i * 5) % 8)
    closed = (count >= 4) & (key % 2 == 0)
    return orders.select(
        _row(
            F.lit(writer.WAY),
            key,
            id=key,
            has_info=key % 11 != 0,
            version=F.lit(1),
            timestamp=_day_millis("o_orderdate") + F.col("o_custkey") % 1000,
            changeset=F.col("o_custkey"),
            uid=key % 1_000_003,
            user=F.col("o_orderpriority"),
            tagged=key % 7 != 0,
            keys=_texts("status", "priority"),
            values=_texts(F.col("o_orderstatus"), F.col("o_orderpriority")),
            refs=F.when(closed, F.concat(refs, F.slice(refs, 1, 1))).otherwise(refs),
        )
    )


def _relations(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    count = (key % 6).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    members = F.transform(
        numbers,
        lambda i: F.struct(
            (key * 3 - i * 1000).alias("id"),
            ((key + i) % 3).cast("int").alias("type"),
            F.when((key + i) % 4 == 0, "")
            .otherwise(F.concat("c_mktsegment", F.lit("-"), i.cast("string")))
            .alias("role"),
        ),
    )
    return customer.select(
        _row(
            F.lit(writer.RELATION),
            key,
            id=F.when(key % 10 == 3, -key).otherwise(key),
            has_info=F.lit(True),
            version=F.lit(2),
            timestamp=F.lit(1_577_836_800_000) + key * 1000,
            changeset=key + 100,
            uid=F.col("c_nationkey"),
            user=F.col("c_mktsegment"),
            tagged=F.lit(True),
            keys=_texts("name", "segment"),
            values=_texts(F.col("c_name"), F.col("c_mktsegment")),
            members=members.cast(_MEMBERS),
        )
    )


def _write_files(directory: str):
    """A function that writes the rows of its partition to one file per codec."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(directory)
        attempt = f"{root}/attempts/{context.partitionId()}-{context.taskAttemptId()}"
        system.create_dir(attempt, recursive=True)
        streams = {codec: system.open_output_stream(f"{attempt}/{codec}") for codec in CODECS}
        for stream in streams.values():
            stream.write(writer.header_blob("OsmSchema-V0.6", "DenseNodes"))
        waiting = {(codec, kind): [] for codec in CODECS for kind in LAYOUT_OF}
        n_rows = 0

        def flush(codec, kind, least):
            table = pa.concat_tables(waiting[codec, kind])
            while table.num_rows >= least:
                block = writer.block(table.slice(0, BLOCK_ROWS), *LAYOUTS[LAYOUT_OF[kind]])
                streams[codec].write(writer.blob("OSMData", block, codec))
                table = table.slice(BLOCK_ROWS)
            waiting[codec, kind] = [table] if table.num_rows else []

        for batch in batches:
            table = pa.Table.from_batches([batch])
            n_rows += table.num_rows
            for (codec, kind), tables in waiting.items():
                in_codec = table["zlib"] if codec == "zlib" else pc.invert(table["zlib"])
                tables.append(table.filter(pc.and_(in_codec, pc.equal(table["kind"], kind))))
                if sum(t.num_rows for t in tables) >= BLOCK_ROWS:
                    flush(codec, kind, BLOCK_ROWS)
        for (codec, kind), tables in waiting.items():
            if any(t.num_rows for t in tables):
                flush(codec, kind, 1)
        for codec, stream in streams.items():
            stream.close()
            # Every attempt of a task has the same rows; the last whole file to arrive stays.
            system.move(f"{attempt}/{codec}", f"{root}/{codec}/part-{context.partitionId():06d}.pbf")
        system.delete_dir(attempt)
        yield pa.RecordBatch.from_pydict({"n_rows": pa.array([n_rows], pa.int64())})

    return write


def write_entity_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write all entities of the tables in ``sf_dir`` and return the paths of the files."""
    directory = new_shared_directory(spark, "entities")
    system, root = fs.FileSystem.from_uri(directory)
    for codec in CODECS:
        system.create_dir(f"{root}/{codec}", recursive=True)

    sources = {"lineitem": _nodes, "orders": _ways, "customer": _relations}
    tables = {name: spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")) for name in sources}
    keys = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey"}
    ends = {name: table.agg(F.max(keys[name]), F.count("*")).first() for name, table in tables.items()}
    shares = max(SHARES, -(-sum(n for _, n in ends.values()) // SHARE_ROWS))
    nodes, ways, relations = (
        make(tables[name].withColumns({"greatest": F.lit(ends[name][0] or 0), "shares": F.lit(shares)})) for name, make in sources.items()
    )
    entities = nodes.unionByName(ways).unionByName(relations)
    entities = entities.repartitionById(shares, F.col("share")).sortWithinPartitions("kind", "id").drop("share")
    entities.mapInArrow(_write_files(directory), "n_rows long").write.format("noop").mode(
        "overwrite"
    ).save()

    prefix = directory[: len(directory) - len(root)]
    return sorted(
        prefix + info.path
        for codec in CODECS
        for info in system.get_file_info(fs.FileSelector(f"{root}/{codec}"))
        if info.path.endswith(".pbf")
    )
