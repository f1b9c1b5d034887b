"""Columnar number reading against one number at a time."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from osm_fixtures.writer import uvarint, zz
from osm_tables.sources import columns
from osm_tables.sources.columns import Bytes, running_sum, zigzag

UINT64 = st.one_of(st.integers(0, 300), st.integers(0, 2**35), st.integers(0, 2**64 - 1))
INT64 = st.integers(-(2**63), 2**63 - 1)


@settings(max_examples=300, deadline=None)
@given(st.lists(UINT64, max_size=60))
def test_numbers_at_positions(numbers):
    encoded = [uvarint(n) for n in numbers]
    starts = np.cumsum([0] + [len(e) for e in encoded])
    values, after = Bytes(b"".join(encoded)).varints_at(starts[:-1])
    assert values.tolist() == numbers
    assert after.tolist() == starts[1:].tolist()


@pytest.mark.parametrize("few", [0, 10**9])
@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.tuples(st.binary(min_size=1, max_size=9), st.lists(UINT64, max_size=9)), max_size=30))
def test_numbers_in_ranges(few, parts):
    """Ranges of numbers with anything between them."""
    content, starts, stops = b"", [], []
    for between, numbers in parts:
        content += between
        starts.append(len(content))
        content += b"".join(map(uvarint, numbers))
        stops.append(len(content))
    old, columns.FEW = columns.FEW, few
    try:
        found, counts = Bytes(content).varints_in(np.array(starts, np.int64), np.array(stops, np.int64))
    finally:
        columns.FEW = old
    assert found.tolist() == [n for _, numbers in parts for n in numbers]
    assert counts.tolist() == [len(numbers) for _, numbers in parts]


@pytest.mark.parametrize("few", [0, 10**9])
@pytest.mark.parametrize("content", [b"\x01\x80", b"\x01\x80\x80", b"\x01\xff" * 3])
def test_range_that_ends_inside_a_number(monkeypatch, few, content):
    monkeypatch.setattr(columns, "FEW", few)
    with pytest.raises(ValueError):
        Bytes(content).varints_in(np.array([1]), np.array([len(content)]))


@pytest.mark.parametrize("length", [11, 12, 20])
def test_numbers_that_are_too_long(length):
    content = Bytes(b"\x80" * (length - 1) + b"\x01")
    with pytest.raises(ValueError):
        content.varints_at(np.array([0]))
    with pytest.raises(ValueError):
        content.varints_at(np.array([length - 1, 0]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(INT64, max_size=8), max_size=8))
def test_running_sums_start_again_in_every_group(groups):
    deltas = np.array([d for g in groups for d in g], np.int64)
    expected = []
    for group in groups:
        total = 0
        for d in group:
            total = (total + d + 2**63) % 2**64 - 2**63
            expected.append(total)
    counts = np.array([len(g) for g in groups], np.int64)
    assert running_sum(deltas, counts).tolist() == expected


@given(st.lists(INT64, max_size=50))
def test_zigzag(numbers):
    assert zigzag(np.array([zz(n) for n in numbers], np.uint64)).tolist() == numbers
