"""Runs of equal keys in sorted Arrow batches, for tasks that read a partition in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def whole_runs(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str],
    work: Callable[[pa.Table, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]],
) -> Iterator[pa.RecordBatch]:
    """Call ``work(rows, starts, ends)`` on rows in which every run of equal keys is complete.

    Rows come sorted by the keys, which are whole numbers. The last run of a batch is held for the
    next, so memory is that of a batch and the longest run.
    """
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        starts = run_starts(rows, keys)
        if len(starts) > 1:
            yield from work(rows.slice(0, starts[-1]), starts[:-1], starts[1:])
        held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield from work(held, np.array([0]), np.array([held.num_rows]))


def run_starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = rows[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def pairs_in_runs(starts: np.ndarray, ends: np.ndarray, at_once: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within each run, about ``at_once`` at a time."""
    sizes = ends - starts
    work = np.cumsum(sizes * (sizes - 1) // 2)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(work // at_once)) + 1, [len(sizes)]])
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        s, n = starts[low:high], sizes[low:high]
        # Row i of a run is paired with the rows behind it.
        left = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        behind = np.repeat(s + n, n) - left - 1
        i = np.repeat(left, behind)
        j = i + 1 + np.arange(behind.sum()) - np.repeat(np.cumsum(behind) - behind, behind)
        yield i, j
