"""Arrow batches worked off by parts: a batch can hold ten thousand long texts, as Python objects many times its size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

# Of a batch about this many bytes are Python objects at the same time.
PART_BYTES = 1024 * 1024


def by_parts(work: Callable[..., list], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``work`` on lists of a few neighbouring values of all ``columns`` at a time; it gives as many values of ``kind``."""
    n = len(columns[0])
    step = max(1, n * PART_BYTES // (1 + sum(column.nbytes for column in columns)))
    parts = [
        pa.array(work(*(column.slice(low, step).to_pylist() for column in columns)), kind) for low in range(0, n, step)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
