"""What is reached through what: members of members, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..options import RELATION, WAY
from ..plans.tables import written


def relation_members(entities: DataFrame) -> DataFrame:
    """``id, member_type, member_id`` of every different member of every relation."""
    relations = entities.where(F.col(S.ENTITY_TYPE) == RELATION)
    members = relations.select(S.ID, F.explode(S.MEMBERS).alias("x"))
    return members.select(S.ID, F.col(f"x.{S.MEMBER_TYPE}").alias("member_type"), f"x.{S.MEMBER_ID}").distinct()


def relation_closure(entities: DataFrame) -> DataFrame:
    """``id, member_type, member_id, depth``: all that a relation holds, itself or through relations in it.

    ``depth`` is the least number of steps, 1 for the relation's own members. A relation that holds itself, in
    a circle, is among its members; a member relation that ``entities`` lack is there without members.

    Only members found in the last round are followed in the next, until a round finds none, so a circle ends
    and no path is walked twice. Each round's findings are a table.
    """
    members = written(relation_members(entities), "members")
    edges = members.where(F.col("member_type") == RELATION).select(F.col(S.ID).alias("through"), "member_id")
    frontier = edges.select(F.col("through").alias(S.ID), "member_id", F.lit(1).alias("depth"))
    inside = frontier = written(frontier, "reached")
    while True:
        step = frontier.select(S.ID, F.col("member_id").alias("through"), (F.col("depth") + 1).alias("depth"))
        step = step.join(edges, "through").select(S.ID, "member_id", "depth").distinct()
        frontier = written(step.join(inside, [S.ID, "member_id"], "left_anti").select(*inside.columns), "reached")
        if frontier.isEmpty():
            break
        inside = inside.unionByName(frontier)
    itself = members.select(S.ID).distinct().select(S.ID, F.col(S.ID).alias("member_id"), F.lit(0).alias("depth"))
    holders = itself.unionByName(inside).select(S.ID, F.col("member_id").alias("through"), "depth")
    own = members.select(F.col(S.ID).alias("through"), "member_type", "member_id")
    held = holders.join(own, "through").groupBy(holders[S.ID], "member_type", "member_id")
    return held.agg((F.min("depth") + 1).cast("int").alias("depth"))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every vertex of ``edges`` (a, b): the least vertex that it is connected with.

    Each vertex points to a smaller one of its component or to itself. In a round, the least pointer among
    its neighbours' is hooked to what a vertex points to and to the vertex, and every vertex then points where its
    pointer points. Minima are taken by aggregation before anything is shuffled, so a vertex with any number of
    neighbours gets one row from each task; trees shrink to stars, and the number of rounds grows with
    the logarithm of the longest path. Nulls are no vertices. Each round's pointers are a table.
    """
    pairs = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "edges")
    pointers = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "pointers")
    while True:
        # What a vertex's pointer points to; pointers are few where they are shared by many.
        target = pointers.select(F.col("id").alias("to"), F.col("to").alias("beyond"))
        jumped = written(pointers.join(target, "to").select("id", "to", "beyond"), "jumps")
        offered = both.join(jumped.select(F.col("id").alias("b"), F.col("beyond").alias("offer")), "b").groupBy("a").agg(F.min("offer").alias("offer"))
        hooked = offered.join(jumped.select(F.col("id").alias("a"), "to"), "a")
        least = (
            hooked.select(F.col("to").alias("id"), "offer")
            .unionByName(hooked.select(F.col("a").alias("id"), "offer"))
            .unionByName(jumped.select("id", F.col("beyond").alias("offer")))
        )
        following = written(least.groupBy("id").agg(F.min("offer").alias("to")), "pointers")
        changed = following.join(pointers.withColumnRenamed("to", "old"), "id").where("to <> old")
        pointers = following
        if changed.isEmpty():
            return pointers.withColumnRenamed("to", "component")


def way_components(entities: DataFrame) -> DataFrame:
    """``id, component`` of every way: the least way that it is connected with by shared nodes.

    A node links each of its ways to the least of them, which is found by aggregation: a node in a million
    ways gives a million edges, not their pairs.
    """
    ways = entities.where(F.col(S.ENTITY_TYPE) == WAY)
    at = ways.select(S.ID, F.explode(S.NODES).alias("x")).select(S.ID, "x.nodeId").distinct()
    least = at.groupBy("nodeId").agg(F.min(S.ID).alias("b"))
    edges = at.join(least, "nodeId").select(F.col(S.ID).alias("a"), "b")
    alone = ways.select(F.col(S.ID).alias("a"), F.col(S.ID).alias("b"))
    return components(edges.unionByName(alone))
