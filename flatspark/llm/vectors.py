"""Arrow lists of components as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def finite(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the vectors of one length, for each length of at least one.

    Null vectors, and those that hold null or non-finite components, are left out. A negative
    zero becomes zero, so equal vectors have equal bytes.
    """
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0
    lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        rows = flat[offsets[:-1][at][:, None] + np.arange(n)]
        good = np.isfinite(rows).all(axis=1)
        if good.any():
            yield at[good], rows[good]
