"""Reading embedding columns, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(rows: DataFrame, vector_col: str) -> int:
    """The commonest length of a vector, the longer one where two are as common; 0 for a table without vectors."""
    lengths = rows.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).head()
    return int(top["d"]) if top else 0


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dim`` finite entries, and those entries as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    good = lengths == dim
    if not dim:
        return np.zeros(len(lengths), bool), np.zeros((0, 0))
    taken = column.filter(pa.array(good))
    entries = taken.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    finite = np.isfinite(entries).all(axis=1)
    good[np.flatnonzero(good)[~finite]] = False
    return good, entries[finite]
