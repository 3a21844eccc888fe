"""Embeddings as integer vectors, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components from here on, after scaling, have squares whose sums may not fit a long.
LARGEST = 1 << 27


def whole_vectors(embeddings: DataFrame, factor: int) -> DataFrame:
    """vec_id long, label and embedding array<double> of the rows whose vector is there, whole and finite.

    Components of LARGEST / factor or more in size take a row out as well: integer scores would not fit a long.
    """
    vector = F.col("embedding").cast("array<double>")
    fits = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < LARGEST / factor, F.lit(False)))  # false for NaN: it is the largest
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("embedding")).where(F.col("embedding").isNotNull() & fits)


def longest(rows: DataFrame) -> int:
    """Components of the longest vector; 0 of an empty table. Shorter vectors count as if zeros followed."""
    return rows.agg(F.max(F.size("embedding"))).first()[0] or 0


def integer_matrix(column: pa.ListArray, factor: int, dim: int) -> np.ndarray:
    """floor(factor * x) of every component as an (n, dim) array of longs."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * factor).astype(np.int64)
    if len(values) == len(column) * dim:
        return values.reshape(len(column), dim)
    sizes = column.value_lengths().to_numpy()
    whole = np.zeros((len(column), dim), np.int64)
    whole[np.arange(dim) < sizes[:, None]] = values
    return whole
