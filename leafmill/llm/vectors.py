"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound(v: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def matrix(cells) -> np.ndarray:
    """Rows of doubles from a column of arrays."""
    return np.stack([np.asarray(x, np.float64) for x in cells])


def usable(df: DataFrame, id_col: str, vec_col: str, *more: Column) -> DataFrame:
    """(vec_id, v, more) of the rows whose vector is sound; v keeps its type, so that floats move as floats."""
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"), *more).where(F.col("vec_id").isNotNull() & sound(F.col("v")))
