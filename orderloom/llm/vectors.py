"""What the two vector operators share: which vectors take part, and blocks of numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def usable(vector: str) -> str:
    """SQL: not null, not empty, no null or non-finite component, not all zeros."""
    fine = f"forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return f"coalesce(size({vector}) > 0 and {fine} and exists({vector}, x -> x <> 0), false)"


def common_size(df: DataFrame, vector: str) -> int:
    """The most frequent number of components, 0 without rows; ties to the smaller."""
    sizes = df.selectExpr(f"size({vector}) as n").groupBy("n").count()
    first = sizes.orderBy(sizes["count"].desc(), "n").limit(1).collect()
    return first[0].n if first else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of an array column as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths; components are added one after the other, as in ``cosines``."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * x[:, k]
    return np.sqrt(total)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of every row of ``a`` with every row of ``b``. The components are added in the same
    order for every pair, so equal vectors get equal values wherever they stand."""
    total = np.zeros((len(a), len(b)))
    columns = np.ascontiguousarray(b.T)
    for k in range(a.shape[1]):
        total += a[:, k, None] * columns[k]
    return total / (norms(a)[:, None] * norms(b))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component first, so that extreme values neither overflow nor
    vanish when squared."""
    return x / np.abs(x).max(axis=1, keepdims=True)
