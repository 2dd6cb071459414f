"""What the Python workers of several operators share."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa

# Texts of one step inside a task, in characters.
STEP_CHARS = 1_000_000


def once(key: Hashable, make: Callable):
    """An object kept in a Python worker from one task to the next.

    Only for things that any task can make anew, such as a loaded vocabulary.
    """
    home = sys.modules.setdefault("_sluice_kept", types.ModuleType("_sluice_kept"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
        # What stays need not be looked through by the collector.
        gc.freeze()
    return kept[key]


def steps(batches: Iterator[pa.RecordBatch], column: str | int, most: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts together stay near ``most`` characters."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], dtype=np.int32)[
            batch.column(column).offset : batch.column(column).offset + batch.num_rows + 1
        ])
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def lists(rows: list[np.ndarray], kind: np.dtype) -> pa.ListArray:
    """An Arrow list column from one array per row."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows).astype(kind, copy=False) if rows else np.zeros(0, dtype=kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
