"""Arrow batches cut by size: Spark counts rows, and texts may be of any length."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_BYTES = 4 << 20


def bounded(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = MOST_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices of about ``most`` bytes of ``column`` and of at most
    ``rows`` rows; a longer value ends a slice. What is computed from a slice is bounded by it."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes.astype(np.int64)) - sizes) // most
        turn = np.diff(part, prepend=-1) != 0
        if rows:
            places = np.arange(batch.num_rows)
            turn |= (places - np.maximum.accumulate(np.where(turn, places, 0))) % rows == 0
        starts = np.flatnonzero(turn).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)
