"""Words of Arrow text columns, as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` holds about ``limit`` bytes (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(size)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of characters other than ASCII white space) of the rows of ``text``, one
    after the other, and how many each row has (null: none)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat, row = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves an empty word
    counts = np.bincount(row.filter(full).to_numpy(), minlength=len(text)).astype(np.int64)
    return flat.filter(full), counts


def starts(counts: np.ndarray) -> np.ndarray:
    """First place of each row in the flat array."""
    return np.cumsum(counts) - counts
