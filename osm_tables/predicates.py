"""Conditions on entities that can be tested before an entity is built, and before its blob is read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import schema as S
from .options import ENTITY_TYPES


@dataclass(frozen=True)
class Where:
    """All conditions that are given must hold; an entity that lacks the value in question fails.

    ``ids`` and ``times`` (epoch milliseconds) are (least, greatest), both included, either may be None.
    ``keys``: one tag at least has one of these keys. ``box``: (south, west, north, east) in degrees,
    borders included; a box whose west is greater than its east lies across the 180th meridian.
    """

    ids: tuple[int | None, int | None] | None = None
    keys: frozenset[str] = frozenset()
    box: tuple[float, float, float, float] | None = None
    times: tuple[int | None, int | None] | None = None

    def __post_init__(self):
        keys: Iterable[str] = [self.keys] if isinstance(self.keys, str) else self.keys
        object.__setattr__(self, "keys", frozenset(keys))
        for name, length in (("ids", 2), ("times", 2), ("box", 4)):
            given = getattr(self, name)
            if given is not None:
                if len(given) != length:
                    raise ValueError(f"{name} needs {length} numbers, not {given!r}")
                object.__setattr__(self, name, tuple(given))

    @property
    def columns(self) -> list[str]:
        """The columns that the conditions look at."""
        asked = ((self.ids, [S.ID]), (self.times, [S.TIMESTAMP]), (self.keys, [S.TAGS]), (self.box, [S.LATITUDE, S.LONGITUDE]))
        return [name for given, names in asked if given for name in names]

    def condition(self) -> Column:
        """The same as a filter on entities with their tags as a list."""
        out = F.lit(True)
        for given, name in ((self.ids, S.ID), (self.times, S.TIMESTAMP)):
            out &= _within(given, F.col(name), F.col(name))
        if self.keys:
            out &= F.exists(S.TAGS, lambda t: t[S.TAG_KEY].isin(sorted(self.keys)))
        return F.coalesce(out & self._box(F.col(S.LATITUDE), F.col(S.LATITUDE), F.col(S.LONGITUDE), F.col(S.LONGITUDE)), F.lit(False))

    def zones(self, types: frozenset[str]) -> Column:
        """Whether a blob can hold a wanted entity, by the columns of `blob_zones`."""
        kinds = F.lit(False)
        for kind in ENTITY_TYPES:
            if kind in types:
                kinds |= F.col(f"n_{kind.lower()}s") > 0
        out = kinds & _within(self.ids, F.col("min_id"), F.col("max_id"))
        out &= _within(self.times, F.col("min_timestamp"), F.col("max_timestamp"))
        box = (F.col(f"{end}_{name}") for name in (S.LATITUDE, S.LONGITUDE) for end in ("min", "max"))
        return F.coalesce(out & self._box(*box), F.lit(False))

    def _box(self, low_lat: Column, high_lat: Column, low_lon: Column, high_lon: Column) -> Column:
        if self.box is None:
            return F.lit(True)
        south, west, north, east = self.box
        east_side, west_side = high_lon >= west, low_lon <= east
        across = east_side & west_side if west <= east else east_side | west_side
        return (high_lat >= south) & (low_lat <= north) & across

    def matches(self, n: int, arrays: Mapping[str, tuple], known_keys: np.ndarray | None) -> np.ndarray:
        """Which of ``n`` entities fulfil the conditions, from what was decoded of them.

        ``arrays`` has (values, present or None) for numbers, and for tags (key numbers, tags of each
        entity); ``known_keys`` tells for each key number whether the key is a wanted one.
        """
        keep = np.ones(n, bool)
        for given, name in ((self.ids, S.ID), (self.times, S.TIMESTAMP)):
            if given:
                values, present = arrays.get(name, (np.zeros(n), np.zeros(n, bool)))
                low, high = given
                keep &= np.ones(n, bool) if present is None else present
                keep &= (True if low is None else values >= low) & (True if high is None else values <= high)
        if self.box:
            if S.LATITUDE not in arrays:
                return np.zeros(n, bool)
            (lat, _), (lon, _) = arrays[S.LATITUDE], arrays[S.LONGITUDE]
            south, west, north, east = self.box
            keep &= (lat >= south) & (lat <= north)
            keep &= (lon >= west) & (lon <= east) if west <= east else (lon >= west) | (lon <= east)
        if self.keys:
            keys, counts = arrays.get(S.TAGS, (np.zeros(0, np.int64), np.zeros(n, np.int64)))
            found = np.repeat(np.arange(n), counts)[known_keys[keys]]
            keep &= np.bincount(found, minlength=n) > 0
        return keep


def _within(given: tuple | None, least: Column, greatest: Column) -> Column:
    if given is None:
        return F.lit(True)
    low, high = given
    out = least.isNotNull()
    if low is not None:
        out &= greatest >= low
    if high is not None:
        out &= least <= high
    return out
