"""Reading vector columns inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector as float64, or None if it is null, empty, zero, or holds a
    null or non-finite component."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    gaps = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    values = np.where(gaps, np.nan, values)
    ends = np.cumsum(lengths)
    out = []
    for end, n in zip(ends.tolist(), lengths.tolist()):
        v = values[end - n:end]
        out.append(v if n and np.isfinite(v).all() and v.any() else None)
    return out


def as_binary(vectors: DataFrame, keep: list[str], column: str = "embedding") -> DataFrame:
    """(keep..., dim, vec): usable vectors as little-endian doubles, else null."""

    def run(batches):
        for batch in batches:
            vs = usable(batch.column(column))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array([None if v is None else len(v) for v in vs], pa.int32()),
                   pa.array([None if v is None else v.astype("<f8").tobytes() for v in vs], pa.binary())],
                [*keep, "dim", "vec"])

    from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType
    src = vectors.select(*keep, F.col(column))
    schema = StructType([src.schema[k] for k in keep]
                        + [StructField("dim", IntegerType()), StructField("vec", BinaryType())])
    return src.mapInArrow(run, schema)


def matrix(blobs) -> np.ndarray:
    """Rows of equal dimension from their bytes."""
    return np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1)


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix; the same for the same seed everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))
