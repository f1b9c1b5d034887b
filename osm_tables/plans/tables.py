"""Tables that a job writes for itself between its steps, in the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_table(spark: SparkSession, name: str) -> str:
    """A path in ``spark.checkpoint.dir`` that goes when the session's process ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can write to")
        shared = "file://" + tempfile.mkdtemp(prefix="osm-tables-")
        spark.sparkContext.setCheckpointDir(shared)
    path = os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once; what is made of it afterwards does not depend on how it was made."""
    path = new_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
