"""Vectors of an Arrow batch as exact integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(column: str) -> Column:
    return F.col(column).cast("array<double>")


def scaled(column: pa.ListArray, factor: int, largest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of a batch and their components as floor(``factor`` * x).

    Null vectors and those with a null or non-finite component are left out, and so are vectors whose squared length in integers would pass
    2^``largest``: sums and differences of the others stay exact in 64 bits.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    ends = np.cumsum(size)
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(flat * factor)
    row = np.repeat(np.arange(len(size)), size)
    # Nulls have become NaN; what overflows on scaling is not finite either.
    square = np.bincount(row, np.minimum(np.where(np.isfinite(whole), whole * whole, np.inf), 1e300), len(size))
    usable &= square <= 2.0**largest
    places = np.flatnonzero(usable)
    return places, [whole[ends[i] - size[i] : ends[i]].astype(np.int64) for i in places]


def packed(vector: np.ndarray) -> bytes:
    return vector.astype("<i4").tobytes()


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows of a float matrix of ``width`` columns: what is missing counts as 0, what is beyond is left out."""
    if all(len(v) == 4 * width for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), width).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        own = np.frombuffer(v, "<i4")[:width]
        out[i, : len(own)] = own
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, both integers held as floats."""
    if a.size == 0 or b.size == 0 or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)  # no partial sum leaves the whole numbers a float holds
    return a.astype(np.int64) @ b.astype(np.int64).T


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``a`` and one row each of ``b``."""
    apart = a - b
    if apart.size == 0 or np.abs(apart).max() ** 2 * a.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", apart, apart).astype(np.int64)
    whole = a.astype(np.int64) - b.astype(np.int64)
    return np.einsum("ij,ij->i", whole, whole)


def checked(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
