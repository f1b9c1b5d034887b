"""Where intermediate tables go, and how batches reach Python functions."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of a batch that Python hands back at once.
OUT_ROWS = 50_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where driver and tasks share a machine."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can write to")
        shared = "file://" + tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(shared)
    return shared


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, partitions as they are."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what is checkpointed by now; it does so when the driver collects garbage.

    The scheduler holds on to the last job, so a small one goes before.
    """
    gc.collect()
    spark.range(0, 1, 1, 1).count()
    spark._jvm.System.gc()


def new_table(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, which goes when the session's process ends."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once and kept as a table in the shared folder; for rows worth compressing."""
    path = new_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with underscores put before it until no column is called so (in any letter case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(table: pa.Table, rows: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches(max_chunksize=rows)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that share ``keys``, from batches sorted by them."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for a in arrays:
            new[1:] |= a[1:] != a[:-1]
        first = tuple(a[0] for a in arrays)
        new[0] = last is not None and first != last
        last = tuple(a[-1] for a in arrays)
        begin = 0
        for at in np.flatnonzero(new).tolist():
            if at > begin:
                held.append(batch.slice(begin, at - begin))
            if held:
                yield pa.Table.from_batches(held)
            held, begin = [], at
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)
