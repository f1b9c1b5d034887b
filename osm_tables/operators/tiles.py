"""Nodes in many boxes at once, by square tiles of the map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..options import NODE
from ..plans.tables import written
from .sums import sums_in_boxes

#: The finest level: 2**LEVELS tiles each way.
LEVELS = 24
#: So many different (level, box) rows at most are sent to all tasks, some 60 bytes each; more are joined by a shuffle.
SENT = 100_000


def _cell(degrees: Column, least: float, level: Column | int) -> Column:
    """The number of a tile along one axis; the last one holds its outer border too."""
    level = level if isinstance(level, Column) else F.lit(level)
    whole = F.floor((degrees - least) * F.lit(2.0**LEVELS / 360))
    inside = F.least(F.greatest(whole, F.lit(0)), F.lit(2**LEVELS - 1))
    return F.call_function("shiftright", inside, (F.lit(LEVELS) - level).cast("int"))


def _spread(x: Column) -> Column:
    """The bits of a number of 32 bits at every other place."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = F.shiftleft(x, shift).bitwiseOR(x).bitwiseAND(F.lit(mask))
    return x


def tile(lat: Column, lon: Column, level: Column | int = LEVELS) -> Column:
    """The tile of a place as a Z-order number: tiles near each other mostly have near numbers, and the four
    tiles within a tile of the level above have its number times four and the three that follow.

    Range-partitioned or sorted by it, nodes of a neighbourhood lie together in few files or row groups.
    """
    return _interleaved(_cell(lon, -180.0, level), _cell(lat, -180.0, level))


def _interleaved(x: Column, y: Column) -> Column:
    return _spread(x.cast("long")).bitwiseOR(F.shiftleft(_spread(y.cast("long")), 1))


def box_tiles(boxes: DataFrame) -> DataFrame:
    """``boxes`` (south, west, north, east, ...) with the tiles that each lies in: ``level, tile``, four rows at most.

    The level is the finest at which tiles are as wide and as high as the box.
    """
    size = F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"), F.lit(360.0 / 2**LEVELS))
    level = F.least(F.greatest(F.floor(F.log2(F.lit(360.0) / size)), F.lit(0)), F.lit(LEVELS)).cast("int")
    ends = boxes.withColumn("level", level)
    xs, ys = (F.sequence(_cell(F.col(a), -180.0, F.col("level")), _cell(F.col(b), -180.0, F.col("level"))) for a, b in (("west", "east"), ("south", "north")))
    cells = ends.withColumn("x", F.explode(xs)).withColumn("y", F.explode(ys))
    return cells.withColumn("tile", _interleaved(F.col("x"), F.col("y"))).drop("x", "y")


def nodes_in_boxes(entities: DataFrame, boxes: DataFrame, totals: Mapping[str, Column] | None = None) -> DataFrame:
    """``box`` and ``id, latitude, longitude`` of every node in each of ``boxes`` (box, south, west, north, east).

    Borders belong to a box; one whose west is greater than its east lies across the 180th meridian; boxes with a
    null or with south above north hold nothing. A node has one row for each box and each of its own rows.

    Nodes and boxes meet by equal tiles and are then compared. Each box has a level of tiles by its size, and a node
    a row for each level that boxes have (`LEVELS` + 1 at most), so no box is compared with all nodes, and no
    tile is smaller than what a box needs.

    With ``totals`` (whole numbers made of an entity's columns, by name) there is a row for each ``box`` that holds nodes
    instead: ``n``, its rows, and the sums of ``totals`` over these. Rows by node and box grow with the product of
    both; sums are made without them (`sums_in_boxes`).
    """
    split = F.when(
        F.col("west") > F.col("east"), F.array(F.struct(F.col("west").alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), F.col("east").alias("e")))
    ).otherwise(F.array(F.struct(F.col("west").alias("w"), F.col("east").alias("e"))))
    whole = boxes.where("south <= north AND west IS NOT NULL AND east IS NOT NULL")
    parts = whole.select("box", "south", "north", F.explode(split).alias("x")).select("box", "south", F.col("x.w").alias("west"), "north", F.col("x.e").alias("east"))
    lat, lon = F.col(S.LATITUDE), F.col(S.LONGITUDE)
    nodes = entities.where((F.col(S.ENTITY_TYPE) == NODE) & lat.isNotNull() & lon.isNotNull())
    if totals is not None:
        return sums_in_boxes(nodes, parts, totals)
    tiles = written(box_tiles(parts), "box-tiles")
    levels = [r["level"] for r in tiles.select("level").distinct().collect()]  # LEVELS + 1 at most
    nodes = nodes.select(S.ID, S.LATITUDE, S.LONGITUDE)
    if not levels:
        return tiles.limit(0).join(nodes, F.lit(False)).select("box", S.ID, S.LATITUDE, S.LONGITUDE)
    # Tiles nest, so those of coarser levels are the first bits of the finest.
    fine = nodes.withColumn("fine", tile(lat, lon))
    keyed = fine.withColumn("level", F.explode(F.array(*[F.lit(n) for n in sorted(levels)])))
    keyed = keyed.withColumn("tile", F.call_function("shiftright", "fine", (F.lit(LEVELS) - F.col("level")) * 2)).drop("fine")
    side = F.broadcast(tiles) if tiles.count() <= SENT else tiles
    inside = lat.between(F.col("south"), F.col("north")) & lon.between(F.col("west"), F.col("east"))
    return keyed.join(side, ["level", "tile"]).where(inside).select("box", S.ID, S.LATITUDE, S.LONGITUDE)
