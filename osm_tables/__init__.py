"""OpenStreetMap extracts as Spark DataFrames."""

from .operators import (
    blob_index,
    blob_zones,
    components,
    count_by_type,
    extract_diff,
    heavy_tags,
    latest_entities,
    nodes_in_boxes,
    relation_closure,
    relation_rings,
    tag_rollup,
    tag_sketches,
    way_components,
    way_lines,
)
from .options import FORMAT, OsmReadOptions
from .predicates import Where
from .schema import osm_schema
from .sources.datasource import register_osm
from .sources.indexed import read_indexed, selected_blobs
from .sources.reader import read_osm

__all__ = [
    "FORMAT",
    "OsmReadOptions",
    "Where",
    "blob_index",
    "blob_zones",
    "components",
    "count_by_type",
    "extract_diff",
    "heavy_tags",
    "latest_entities",
    "nodes_in_boxes",
    "osm_schema",
    "read_indexed",
    "read_osm",
    "register_osm",
    "relation_closure",
    "relation_rings",
    "selected_blobs",
    "tag_rollup",
    "tag_sketches",
    "way_components",
    "way_lines",
]
