"""Reading list columns of numbers as double vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row as doubles; None where it is null, empty, or holds a null or non-finite component."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    return [
        values[a:b] if ok and b > a and bad[a] == bad[b] else None
        for ok, a, b in zip(valid, offsets[:-1], offsets[1:], strict=True)
    ]
