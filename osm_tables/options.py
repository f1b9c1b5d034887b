"""Read options: the names users type, and one immutable value object for them."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

# The data source name and its option names.
FORMAT = "osm_pbf"
PATH = "path"
PATHS = "paths"
PARTITIONS = "partitions"
TYPES = "types"
EXCLUDE_METADATA = "exclude-metadata"
EXCLUDE_TAGS = "exclude-tags"
TAGS_AS_MAP = "tags-as-map"
WAY_NODES_AS_ID_LIST = "way-nodes-as-id-list"
INCLUDE_ORIGIN_FILE = "include-origin-file"

# The three entity kinds, spelled as in the entity_type column.
NODE = "Node"
WAY = "Way"
RELATION = "Relation"
ENTITY_TYPES = (NODE, WAY, RELATION)

_FLAGS = {
    "exclude_metadata": EXCLUDE_METADATA,
    "exclude_tags": EXCLUDE_TAGS,
    "tags_as_map": TAGS_AS_MAP,
    "way_nodes_as_id_list": WAY_NODES_AS_ID_LIST,
    "include_origin_file": INCLUDE_ORIGIN_FILE,
}


_BY_LOWER_NAME = {kind.lower(): kind for kind in ENTITY_TYPES}


def entity_type_named(name: str) -> str:
    """The canonical spelling of an entity type; any letter case is accepted."""
    kind = _BY_LOWER_NAME.get(name.lower())
    if kind is None:
        raise ValueError(f"{name!r} is no kind of entity; there are {', '.join(ENTITY_TYPES)}")
    return kind


@dataclass(frozen=True)
class OsmReadOptions:
    """How to read a set of files.

    ``types`` is ``None`` for "all kinds"; every ``with_*`` call returns a new object.
    """

    paths: tuple[str, ...] = ()
    partitions: int = 1
    types: frozenset[str] | None = None
    exclude_metadata: bool = False
    exclude_tags: bool = False
    tags_as_map: bool = False
    way_nodes_as_id_list: bool = False
    include_origin_file: bool = False

    def __post_init__(self):
        object.__setattr__(self, "paths", tuple(self.paths))
        object.__setattr__(self, "partitions", max(1, int(self.partitions)))
        if self.types is not None:
            names = [self.types] if isinstance(self.types, str) else self.types
            kinds = frozenset(entity_type_named(n) for n in names)
            object.__setattr__(self, "types", kinds or None)

    def with_paths(self, *paths: str) -> OsmReadOptions:
        return replace(self, paths=self.paths + paths)

    def with_partitions(self, value: int) -> OsmReadOptions:
        return replace(self, partitions=value)

    def with_type(self, name: str) -> OsmReadOptions:
        return replace(self, types=(self.types or frozenset()) | {entity_type_named(name)})

    def with_exclude_metadata(self, value: bool = True) -> OsmReadOptions:
        return replace(self, exclude_metadata=value)

    def with_exclude_tags(self, value: bool = True) -> OsmReadOptions:
        return replace(self, exclude_tags=value)

    def with_tags_as_map(self, value: bool = True) -> OsmReadOptions:
        return replace(self, tags_as_map=value)

    def with_way_nodes_as_id_list(self, value: bool = True) -> OsmReadOptions:
        return replace(self, way_nodes_as_id_list=value)

    def with_include_origin_file(self, value: bool = True) -> OsmReadOptions:
        return replace(self, include_origin_file=value)

    def contains_type(self, name: str) -> bool:
        return self.types is None or name in self.types

    @property
    def selected_types(self) -> frozenset[str]:
        return frozenset(ENTITY_TYPES) if self.types is None else self.types

    def to_options(self) -> dict[str, str]:
        """The same settings as data source option strings; ``parse`` reads them back."""
        out = {PARTITIONS: str(self.partitions)}
        if self.paths:
            out[PATHS] = json.dumps(list(self.paths))
        if self.types:
            out[TYPES] = ",".join(t for t in ENTITY_TYPES if t in self.types)
        out.update({name: "true" for attr, name in _FLAGS.items() if getattr(self, attr)})
        return out

    @classmethod
    def parse(cls, options: Mapping[str, str]) -> OsmReadOptions:
        """Read option strings. Keys ignore case, unknown keys are ignored."""
        given = {str(k).lower(): v for k, v in options.items() if v is not None}
        settings = {
            attr: str(given.get(name, "")).lower() == "true" for attr, name in _FLAGS.items()
        }
        if PARTITIONS in given:
            settings["partitions"] = int(given[PARTITIONS])
        if TYPES in given:
            settings["types"] = frozenset(n for n in re.split(r"[,\s]+", given[TYPES]) if n)
        paths = _json_paths(given[PATHS]) if PATHS in given else []
        if PATH in given:
            paths.append(given[PATH])
        return cls(paths=tuple(paths), **settings)


def _json_paths(text: str) -> list[str]:
    try:
        paths = json.loads(text)
    except ValueError as e:
        raise ValueError(f"Option {PATHS!r} must be a JSON list of paths: {e}") from e
    if not isinstance(paths, list) or not all(isinstance(p, str) for p in paths):
        raise ValueError(f"Option {PATHS!r} must be a JSON list of paths, got {text!r}")
    return paths
