"""Vector columns for the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, dim, v`` (little-endian doubles, as given) of the usable vectors with an id."""
    src = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    src = src.where(F.col("vec_id").isNotNull() & usable(F.col("x")))

    def run(ids: pa.Array, x: pa.ListArray) -> dict:
        flat = x.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0   # -0.0 becomes 0.0
        size = pa.compute.list_value_length(x).to_numpy(zero_copy_only=False)
        end = np.cumsum(size)
        return {"vec_id": ids, "dim": size.astype(np.int32),
                "v": [flat[e - n:e].tobytes() for e, n in zip(end.tolist(), size.tolist())]}

    return map_rows(src, run, f"vec_id {dict(src.dtypes)['vec_id']}, dim int, v binary")


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """The packed vectors of one dimension as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norm; by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
