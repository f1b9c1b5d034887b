"""Ways of a relation stitched end to end."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..options import RELATION, WAY
from .graphs import components


def relation_rings(entities: DataFrame) -> DataFrame:
    """``id, ring, kind, n_ways, ways``: the ways of every relation, grouped by shared ends.

    A group is named ``ring`` by its least way. ``kind`` is ``ring`` if every end in it belongs to two way ends (a way that
    ends where it begins is a ring by itself), ``open`` if an end belongs to an odd number, and else ``touching``
    (rings that meet at an end, which can be told apart in more than one way). ``ways`` lists the ways as
    they follow one another, from the least on in its own direction, negative where a way is run backwards; it is
    null for groups that are no ring. A way that is a member several times counts once; ways without
    references and those that ``entities`` lack are left out. Rows of a way id are taken as one way (see `latest_entities`).

    Groups are the connected components of (relation, node), so relations of any size are stitched by all tasks;
    only the order within one ring is walked in one place.
    """
    ways = entities.where((F.col(S.ENTITY_TYPE) == WAY) & (F.size(S.NODES) > 0))
    ends = ways.select(F.col(S.ID).alias("way"), F.col(S.NODES)[0]["nodeId"].alias("first"), F.element_at(S.NODES, -1)["nodeId"].alias("last"))
    ends = ends.groupBy("way").agg(F.max(F.struct("first", "last")).alias("x")).select("way", "x.*")
    members = entities.where(F.col(S.ENTITY_TYPE) == RELATION).select(F.col(S.ID).alias("id"), F.explode(S.MEMBERS).alias("x"))
    members = members.where(F.col(f"x.{S.MEMBER_TYPE}") == WAY).select("id", F.col(f"x.{S.MEMBER_ID}").alias("way")).distinct()
    own = members.join(ends, "way")

    at = own.select(F.struct("id", "first").alias("a"), F.struct("id", F.col("last").alias("first")).alias("b"))
    group = components(at).select(F.col("id.id").alias("id"), F.col("id.first").alias("first"), F.col("component.first").alias("part"))
    meet = own.select("id", F.explode(F.array("first", "last")).alias("first")).groupBy("id", "first").count()
    by_part = meet.join(group, ["id", "first"]).groupBy("id", "part").agg(
        F.max((F.col("count") % 2).cast("int")).alias("odd"), F.max("count").alias("most")
    )
    kind = F.when(F.col("odd") == 1, "open").when(F.col("most") > 2, "touching").otherwise("ring").alias("kind")
    placed = own.join(group, ["id", "first"]).join(by_part.select("id", "part", kind), ["id", "part"])
    named = placed.groupBy("id", "part", "kind").agg(F.min("way").alias("ring"), F.count("*").alias("n_ways"))

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        meeting: dict[int, list] = {}
        for way, first, last in zip(rows["way"], rows["first"], rows["last"]):
            meeting.setdefault(first, []).append((way, last, way))
            meeting.setdefault(last, []).append((-way, first, way))
        start = rows.loc[rows["way"].idxmin()]
        order, used, at = [start["way"]], {start["way"]}, start["last"]
        while following := [x for x in meeting[at] if x[2] not in used]:
            signed, at, way = following[0]
            order.append(signed)
            used.add(way)
        return pd.DataFrame({"id": [rows["id"].iloc[0]], "part": [rows["part"].iloc[0]], "ways": [order]})

    walked = placed.where("kind = 'ring'").groupBy("id", "part").applyInPandas(walk, "id long, part long, ways array<long>")
    return named.join(walked, ["id", "part"], "left").select("id", "ring", "kind", "n_ways", "ways")
