"""Embedding rows as integer vectors, shared by the vector operators."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest magnitude of an integer component; larger ones are set to it, so that sums stay exact.
MOST = 1 << 20


def integer_vectors(df: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vid, label, v)`` with ``v`` the components ``floor(scale * x)``.

    Rows whose vector is null or holds a null, NaN or infinite component are
    left out.  Other columns, whatever their names, are left behind."""
    inf = F.lit(float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("vid"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("x")) \
        .filter(F.col("x").isNotNull() & F.forall("x", lambda x: x.isNotNull() & (x < inf) & (x > -inf)))
    whole = lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int")
    return rows.select("vid", "label", F.transform("x", whole).alias("v"))


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors of a column, all of length ``dim``, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
