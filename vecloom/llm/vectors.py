"""Vectors as packed bytes: what the embedding operators exchange."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def _pack(vector: list | np.ndarray | None) -> bytes | None:
    if vector is None or isinstance(vector, list) and None in vector:
        return None
    values = np.asarray(vector, np.float64) + 0.0  # no negative zero
    if not np.isfinite(values).all():
        return None
    small = values.astype(np.float32)
    return b"f" + small.tobytes() if (small == values).all() else b"d" + values.tobytes()


@F.arrow_udf(BinaryType())
def _packed(vectors: pa.Array) -> pa.Array:
    # A null component is NaN here, which leaves a vector out just so.
    values, at = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    rows = zip(at, at[1:], vectors.is_valid().to_numpy(zero_copy_only=False), strict=False)
    return pa.array([_pack(values[a:b]) if there else None for a, b, there in rows], pa.binary())


def packed(vector: Column) -> Column:
    """The vector as bytes, exactly; null if it is null or holds null or non-finite numbers."""
    return _packed(vector.cast("array<double>"))


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if raw[:1] == b"f" else np.float64, offset=1).astype(np.float64)


def by_dimension(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each dimension among the vectors."""
    vectors = [unpacked(r) for r in raws]
    sizes = np.array([len(v) for v in vectors])
    return [(rows := np.flatnonzero(sizes == d), np.stack([vectors[i] for i in rows])) for d in np.unique(sizes)]
