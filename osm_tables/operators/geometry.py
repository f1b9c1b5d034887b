"""Ways as lines: references to nodes resolved to coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..options import NODE, WAY
from ..plans.tables import written

#: Mean radius of the earth in metres, as distances take it.
EARTH = 6_371_008.8
#: Nodes in so many ways or more have their references dealt over several tasks, this many each at most;
#: so many such nodes at most are sent to all tasks, 8 bytes each; of more, AQE splits the largest.
POPULAR, SENT = 100_000, 1_000_000


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along the great circle between two places in degrees."""
    up, along = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(up) * F.sin(up) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(along) * F.sin(along)
    a = F.when(a > 1, F.lit(1.0)).otherwise(a)  # null stays null
    return F.lit(2 * EARTH) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def way_lines(entities: DataFrame, popular: int = POPULAR) -> DataFrame:
    """One row per way and version: ``id, version, n_refs, n_missing, length, south, west, north, east, points``.

    ``points`` are the way's references in order, repeated ones too, as (index, nodeId, latitude, longitude), the
    last two null for a node that ``entities`` lack (counted in ``n_missing``). ``length`` (metres) adds up the
    stretches between neighbouring references that are both known; length and box are null for a way of
    which none is known. A way without references has an empty list. Of nodes that occur several times the greatest
    version counts; of ways, rows that agree in id and version are one. ``entities`` are those of ``read_osm`` with
    ways' nodes as (index, nodeId) structs.

    References go to their nodes by id and come back to their way by id: two shuffles of five numbers each, and
    one of the nodes. References to popular nodes are dealt over copies of these.
    """
    newest = F.max(F.struct(F.coalesce(S.VERSION, F.lit(-1)), F.coalesce(S.TIMESTAMP, F.lit(-1)), S.LATITUDE, S.LONGITUDE)).alias("x")
    nodes = entities.where(F.col(S.ENTITY_TYPE) == NODE).groupBy(F.col(S.ID).alias("nodeId")).agg(newest)
    nodes = nodes.select("nodeId", f"x.{S.LATITUDE}", f"x.{S.LONGITUDE}")
    ways = entities.where(F.col(S.ENTITY_TYPE) == WAY).select(S.ID, S.VERSION, S.NODES)
    refs = ways.select(S.ID, S.VERSION, F.explode_outer(S.NODES).alias("x")).select(S.ID, S.VERSION, "x.*")

    often = refs.where("nodeId IS NOT NULL").groupBy("nodeId").count().where(F.col("count") >= popular)
    often = written(often.select(F.col("nodeId"), F.ceil(F.col("count") / popular).cast("int").alias("shares")), "popular-nodes")
    few = often.count() <= SENT
    shares = F.broadcast(often) if few else often
    share = F.pmod(F.xxhash64(S.ID, S.NODE_INDEX), F.coalesce("shares", F.lit(1)))
    refs = refs.join(shares, "nodeId", "left").withColumn("share", share.cast("int")).drop("shares")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share")
    nodes = nodes.join(shares, "nodeId", "left").select("nodeId", S.LATITUDE, S.LONGITUDE, copies)

    found = refs.join(nodes, ["nodeId", "share"], "left")
    point = F.struct(S.NODE_INDEX, "nodeId", S.LATITUDE, S.LONGITUDE)
    # The reference of a way without any is null, and so no point.
    points = F.sort_array(F.collect_set(F.when(F.col(S.NODE_INDEX).isNotNull(), point))).alias("points")
    known = F.col(S.LATITUDE)
    lines = found.groupBy(S.ID, S.VERSION).agg(
        points, F.min(known).alias("south"), F.min(S.LONGITUDE).alias("west"), F.max(known).alias("north"), F.max(S.LONGITUDE).alias("east")
    )
    steps = F.zip_with(
        "points", F.slice("points", 2, F.size("points")),
        lambda a, b: F.coalesce(distance(a[S.LATITUDE], a[S.LONGITUDE], b[S.LATITUDE], b[S.LONGITUDE]), F.lit(0.0)),
    )
    length = F.when(F.col("south").isNotNull(), F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)).alias("length")
    n_missing = F.size(F.filter("points", lambda p: p[S.LATITUDE].isNull())).cast("long").alias("n_missing")
    return lines.select(S.ID, S.VERSION, F.size("points").cast("long").alias("n_refs"), n_missing, length, "south", "west", "north", "east", "points")
