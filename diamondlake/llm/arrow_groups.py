"""Groups of sorted rows in map tasks: many small groups per call instead of one call per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def changes(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Whether each row begins a new group of equal, non-NULL integer keys."""
    fresh = np.ones(len(rows), dtype=bool)
    if len(rows):
        fresh[1:] = False
        for key in keys:
            values = rows[key].to_numpy()
            fresh[1:] |= values[1:] != values[:-1]
    return fresh


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``least`` rows each; a larger group comes alone or with few others."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, len(batch), least):
            held.append(batch.slice(at, least))
            size += len(held[-1])
            if size < 2 * least:
                continue
            rows = pa.Table.from_batches(held)
            begin = np.flatnonzero(changes(rows, keys))
            upto = 0
            while (later := begin[begin >= upto + least]).size:
                yield rows.slice(upto, int(later[0]) - upto)
                upto = int(later[0])
            held, size = rows.slice(upto).to_batches(), len(rows) - upto
    if size:
        yield pa.Table.from_batches(held)
