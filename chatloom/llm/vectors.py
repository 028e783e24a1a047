"""Vectors of an Arrow batch as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCALE = 256.0


class Integers:
    """Each component x of a list column as floor(256 * x).

    ``size`` is each row's length and ``good`` whether it has a vector without null or
    non-finite components; ``most`` is the greatest magnitude of a good row's components.
    """

    def __init__(self, column: pa.Array) -> None:
        self.size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.flat = np.floor(SCALE * flat)
        row = np.repeat(np.arange(len(self.size)), self.size)
        bad = np.bincount(row[~np.isfinite(self.flat)], minlength=len(self.size)) > 0
        self.good = column.is_valid().to_numpy(zero_copy_only=False) & ~bad
        self.most = np.zeros(len(self.size))
        np.maximum.at(self.most, row, np.where(np.isfinite(self.flat), np.abs(self.flat), 0))

    def matrix(self, rows: np.ndarray, size: int) -> np.ndarray:
        """The vectors of these rows, all of length ``size``."""
        return self.flat[self.start[rows][:, None] + np.arange(size)].astype(np.int64)
