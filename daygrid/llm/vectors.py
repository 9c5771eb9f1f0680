"""Vectors that take part in searches and joins, and their blocks in Python steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, without null, NaN or infinite components, and not zero."""
    finite = F.forall(
        vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def usable_rows(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) with double components of the rows that take part."""
    source = frame.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    return source.where(usable(F.col("v")))


def matrix(column) -> np.ndarray:
    """Rows of a pandas column of equally long vectors, in double precision."""
    return np.array([np.asarray(v, dtype=np.float64) for v in column])
