"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(rows: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that take part: no nulls, all components finite.

    One vector to an id: repeated rows count once, and of different vectors under
    one id the smallest in array order stands.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return kept.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
