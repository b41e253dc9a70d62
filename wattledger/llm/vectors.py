"""Vectors as whole numbers: which rows take part, and their components as NumPy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole components beyond this are not exact as doubles.
MOST = 1 << 53


def usable(vector: Column) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, computed as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrix(lists: pa.Array, multiple: int = 1) -> np.ndarray:
    """The lists as rows of one matrix; shorter ones are filled up with zeros, and all of them to a
    width that is a multiple of `multiple`."""
    lengths = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    width = -(-int(lengths.max(initial=0)) // multiple) * multiple
    made = np.zeros((len(lengths), width), dtype=np.int64)
    made[np.arange(width) < lengths[:, None]] = np.asarray(lists.flatten(), dtype=np.int64)
    if made.size and max(-int(made.min()), int(made.max())) >= MOST:
        raise ValueError("a component is too large for exact whole numbers")
    return made


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    """The rows with zeros up to `width`."""
    return np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))
