"""The writer of entity files."""

import tracemalloc

import numpy as np
import pytest

from osm_fixtures.writer import uvarint, varints


@pytest.mark.parametrize("most", [1, 127, 128, 2**14, 2**35, 2**63 - 1])
def test_varints(most):
    values = [0, most, 1, most // 2, most - 1]
    pieces = varints(np.array(values))
    assert pieces.data.tobytes() == b"".join(map(uvarint, values))
    assert pieces.sizes.tolist() == [len(uvarint(v)) for v in values]


def test_varints_of_negative_numbers_and_of_none():
    assert varints(np.array([-1, 5])).data.tobytes() == uvarint(-1) + uvarint(5)
    assert varints(np.zeros(0, np.int64)).data.tobytes() == b""


def test_small_numbers_take_no_room_for_great_ones():
    values = np.ones(100_000, np.int64)
    tracemalloc.start()
    try:
        varints(values)
        assert tracemalloc.get_traced_memory()[1] < 2_500_000
    finally:
        tracemalloc.stop()
