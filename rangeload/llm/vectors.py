"""Vectors from Arrow lists to matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_length(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix in double precision) of usable rows for each length of vector.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    there = pc.and_(pc.is_valid(ids), pc.is_valid(vectors))
    ids, vectors = ids.filter(there), vectors.filter(there)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.zeros(len(ids), bool)
    bad[np.repeat(np.arange(len(ids)), lengths)[~np.isfinite(values)]] = True
    starts = np.cumsum(lengths) - lengths
    keys = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    found = {}
    for length in np.unique(lengths[~bad]).tolist():
        rows = np.nonzero((lengths == length) & ~bad)[0]
        found[length] = (keys[rows], values[starts[rows, None] + np.arange(length)[None, :]])
    return found
