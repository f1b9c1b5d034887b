from hypothesis import given, settings
from hypothesis import strategies as st

from osm_tables.plans.splits import plan_splits, split_bytes

SIZES = st.lists(st.integers(0, 5000), min_size=1, max_size=8)


def check_cover(sizes, plan):
    """Every byte of every file is in exactly one range, and ranges run in order."""
    at = [0] * len(sizes)
    for task_no in range(plan.n_tasks):
        for file_no, start, stop in plan.ranges_of(task_no):
            assert start == at[file_no]
            assert stop >= start
            at[file_no] = stop
    assert at == sizes


@settings(max_examples=300, deadline=None)
@given(SIZES, st.integers(1, 3000), st.integers(0, 500))
def test_ranges_cover_all_files(sizes, target, open_cost):
    plan = plan_splits(sizes, target, open_cost)
    check_cover(sizes, plan)
    for task_no in range(plan.n_tasks):
        assert sum(stop - start for _, start, stop in plan.ranges_of(task_no)) <= target


@settings(max_examples=300, deadline=None)
@given(SIZES, st.integers(1, 3000), st.integers(2, 50))
def test_partitions_is_the_least_number_per_file(sizes, target, partitions):
    plan = plan_splits(sizes, target, 100, partitions)
    check_cover(sizes, plan)
    for file_no, size in enumerate(sizes):
        ranges = [r for t in range(plan.n_tasks) for r in plan.ranges_of(t) if r.file_no == file_no]
        assert len(ranges) >= min(partitions, size)


def test_plan_does_not_grow_with_the_data():
    plan = plan_splits([10**14, 10**13], 2**27, 2**22)
    assert plan.n_tasks == -(-(11 * 10**13 + 2**23) // 2**27)
    last = plan.ranges_of(plan.n_tasks - 1)
    assert last[-1].stop == 10**13
    assert len(plan.starts) == 2


def test_small_files_share_tasks():
    plan = plan_splits([1000] * 64, 128 * 1024, 1000)
    assert plan.n_tasks == 1
    assert len(plan.ranges_of(0)) == 64


def test_target_size():
    assert split_bytes([2**40], 2**27, 2**22, 8) == 2**27
    assert split_bytes([100], 2**27, 2**22, 8) == 2**22
    assert split_bytes([2**26], 2**27, 2**22, 8) == (2**26 + 2**22) // 8
