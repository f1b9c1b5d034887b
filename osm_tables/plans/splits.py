"""Cutting files into byte ranges, read by one Spark task each.

The plan holds a few numbers per *file*, none per range, so it stays as small as the caller's own list
of paths however large the files are. A task finds its ranges from its number alone.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate
from typing import NamedTuple, Protocol


#: Fixed: Spark numbers partitions by ints; a plan stays far below.
MAX_TASKS = 1 << 24


class FileRange(NamedTuple):
    file_no: int
    start: int
    stop: int


class FileCut(NamedTuple):
    """How one file is cut: the first of its tasks, the bytes of that task before the file, and the step."""

    first_task: int
    lead: int
    step: int


class Plan(Protocol):
    sizes: tuple[int, ...]
    n_tasks: int

    def ranges_of(self, task_no: int) -> Sequence[FileRange]: ...

    def cuts(self) -> list[FileCut]: ...


@dataclass(frozen=True)
class SplitPlan:
    """Tasks of equal length along one line on which all files lie end to end.

    Opening a file counts as some bytes before its first byte. Cuts may fall anywhere in a file, so
    a task can hold the end of one file, some whole files and the start of another.
    """

    sizes: tuple[int, ...]
    starts: tuple[int, ...]
    step: int
    n_tasks: int

    def ranges_of(self, task_no: int) -> list[FileRange]:
        first, last = task_no * self.step, (task_no + 1) * self.step
        ranges = []
        for file_no in range(max(0, bisect_right(self.starts, first) - 1), len(self.sizes)):
            if self.starts[file_no] >= last:
                break
            start = max(0, first - self.starts[file_no])
            stop = min(self.sizes[file_no], last - self.starts[file_no])
            if start < stop:
                ranges.append(FileRange(file_no, start, stop))
        return ranges

    def cuts(self) -> list[FileCut]:
        return [FileCut(*divmod(start, self.step), self.step) for start in self.starts]


@dataclass(frozen=True)
class PerFilePlan:
    """Every file cut on its own, each range a task of its own."""

    sizes: tuple[int, ...]
    steps: tuple[int, ...]
    first_tasks: tuple[int, ...]
    n_tasks: int

    def ranges_of(self, task_no: int) -> list[FileRange]:
        file_no = bisect_right(self.first_tasks, task_no) - 1
        step = self.steps[file_no]
        start = (task_no - self.first_tasks[file_no]) * step
        return [FileRange(file_no, start, min(start + step, self.sizes[file_no]))]

    def cuts(self) -> list[FileCut]:
        return [FileCut(first, 0, step) for first, step in zip(self.first_tasks, self.steps)]


def split_bytes(
    sizes: Sequence[int], max_partition_bytes: int, open_cost_bytes: int, parallelism: int
) -> int:
    """Spark's own target size for one file partition, for these files together."""
    per_core = -(-sum(size + open_cost_bytes for size in sizes) // max(1, parallelism))
    return max(1, min(max_partition_bytes, max(open_cost_bytes, per_core)))


def plan_splits(
    sizes: Sequence[int], target_bytes: int, open_cost_bytes: int, partitions: int = 1
) -> SplitPlan | PerFilePlan:
    """Tasks of ``target_bytes``; with ``partitions`` > 1, at least so many ranges of every
    file, or one for each byte of a shorter one."""
    if partitions > 1:
        steps = [max(1, min(target_bytes, size // partitions)) for size in sizes]
        # An empty file still has one (empty) range, so that every task belongs to a file.
        counts = [max(1, -(-size // step)) for size, step in zip(sizes, steps)]
        *first_tasks, n_tasks = accumulate(counts, initial=0)
        return PerFilePlan(tuple(sizes), tuple(steps), tuple(first_tasks), n_tasks)
    *bases, total = accumulate((size + open_cost_bytes for size in sizes), initial=0)
    starts = tuple(base + open_cost_bytes for base in bases)
    return SplitPlan(tuple(sizes), starts, target_bytes, max(1, -(-total // target_bytes)))
