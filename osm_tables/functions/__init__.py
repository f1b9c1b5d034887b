"""Column expressions on entity columns."""

from .entities import tags_as_map, way_node_ids

__all__ = ["tags_as_map", "way_node_ids"]
