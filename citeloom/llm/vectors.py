"""Vectors of integers, as the vector operators take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """True for a vector that is there and holds neither null nor a non-finite component."""
    infinity = F.lit(float("inf"))
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinity)
    )
    return F.coalesce(~bad, F.lit(False))


def whole(vector: Column, scale: int, bound: int) -> Column:
    """Each component as ``floor(scale * x)``, held within ``bound`` on either side."""
    return F.transform(
        vector,
        lambda x: F.floor(
            F.greatest(
                F.least(x.cast("double") * scale, F.lit(float(bound))), F.lit(float(-bound))
            )
        ).cast("int"),
    )


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """An Arrow column of integer lists as rows; shorter ones count as ending in zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(values) == len(column) * dimensions:
        return values.reshape(len(column), dimensions)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dimensions), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    begins = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, np.arange(len(values)) - begins] = values
    return out
