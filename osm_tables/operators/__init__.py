"""Jobs built on the reader."""

from .blob_index import blob_index, count_at
from .counts import count_by_type
from .geometry import way_lines
from .graphs import components, relation_closure, way_components
from .rings import relation_rings
from .tags import heavy_tags, tag_rollup, tag_sketches
from .tiles import nodes_in_boxes, tile
from .versions import extract_diff, latest_entities
from .zones import blob_zones

__all__ = [
    "blob_index",
    "blob_zones",
    "components",
    "count_at",
    "count_by_type",
    "extract_diff",
    "heavy_tags",
    "latest_entities",
    "nodes_in_boxes",
    "relation_closure",
    "relation_rings",
    "tag_rollup",
    "tag_sketches",
    "tile",
    "way_components",
    "way_lines",
]
