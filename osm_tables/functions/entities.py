"""Entity columns in their other shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def tags_as_map(tags: str | Column = S.TAGS) -> Column:
    """List tags as a map. Repeated keys obey spark.sql.mapKeyDedupPolicy; no tags stay null."""
    return F.map_from_entries(tags)


def way_node_ids(nodes: str | Column = S.NODES) -> Column:
    """The ids of a way's indexed nodes, in order."""
    return F.transform(nodes, lambda node: node[S.NODE_ID])
