"""Blobs of a stored index to tasks of equal bytes, by prefix sums that no single task makes alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sums are first made within stretches of a file (bytes) and then within groups of stretches.
STRETCH = 1 << 30
GROUPS = 1024


def with_tasks(blobs: DataFrame, target_bytes: int, open_cost_bytes: int) -> DataFrame:
    """``blobs`` (file, data_offset, datasize, ...) with ``task``: blobs that lie one after another share one,
    up to ``target_bytes`` together. Starting on a stretch of a file counts as ``open_cost_bytes``.

    A window runs over the blobs of a stretch, one over the stretches of a group (as many as a group has
    files, or gigabytes of them), one over the groups; so a huge file, or many files, are no one's alone.
    """
    stretch = F.floor(F.col("data_offset") / STRETCH)
    group = F.pmod(F.xxhash64("file", "stretch"), F.lit(GROUPS))
    in_stretch = Window.partitionBy("file", "stretch").orderBy("data_offset").rowsBetween(Window.unboundedPreceding, -1)
    placed = blobs.withColumn("stretch", stretch).withColumn("inside", F.coalesce(F.sum("datasize").over(in_stretch), F.lit(0)))

    totals = blobs.groupBy("file", stretch.alias("stretch")).agg((F.sum("datasize") + open_cost_bytes).alias("bytes")).withColumn("group", group)
    in_group = Window.partitionBy("group").orderBy("file", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    over_groups = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    by_group = totals.groupBy("group").agg(F.sum("bytes").alias("all")).select(
        "group", F.coalesce(F.sum("all").over(over_groups), F.lit(0)).alias("groups_before")
    )
    before = F.coalesce(F.sum("bytes").over(in_group), F.lit(0)).alias("before")
    starts = totals.select("file", "stretch", "group", before).join(F.broadcast(by_group), "group")  # GROUPS rows
    starts = starts.select("file", "stretch", (F.col("before") + F.col("groups_before") + open_cost_bytes).alias("start"))
    task = F.floor((F.col("start") + F.col("inside")) / target_bytes).cast("int").alias("task")
    return placed.join(starts, ["file", "stretch"]).select(*blobs.columns, task)


def total_bytes(blobs: DataFrame, open_cost_bytes: int) -> int:
    """All bytes that `with_tasks` shares out."""
    stretches = blobs.groupBy("file", F.floor(F.col("data_offset") / STRETCH)).agg(F.sum("datasize").alias("bytes"))
    return stretches.agg(F.coalesce(F.sum(F.col("bytes") + open_cost_bytes), F.lit(0))).first()[0]
