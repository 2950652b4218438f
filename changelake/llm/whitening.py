"""Embedding whitening with distributed block matrices.

Entries become whole numbers x = floor(64 c) + 1000000. The fit list is each
distinct x vector once; its size n and its sums S are exact integers. Centred
rows x - S/n are laid into dense blocks that MLlib's ``BlockMatrix`` multiplies:
transposed times itself gives the scatter matrix (columns x columns, the only
thing that reaches the driver, decomposed there by ``eigh``), and times the
whitening matrix projects the rows. The inner dimension of the transposed
product is split, so no task gets all blocks, and the blocks go through in slabs
of ``slab_blocks``, so what the driver keeps of their places is bounded.

Blocks are stored as Parquet in the layout of MLlib's matrix type and read
straight into it: rows never pass through Python one by one.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries give no rows; null and repeated ids are kept. Vectors of another length
form a fit of their own. 64 c is clipped at 2**53 in size. A component whose
eigenvalue is zero to double precision (at most columns x 2**-52 x the largest)
has no whitened value and is left out: a single or constant vector gives no
rows. ``deviation`` is a decimal(38,0); it is null beyond 38 digits. An empty
table gives no rows. Only the id and vector columns are read, so other columns'
names do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DoubleType, IntegerType, LongType,
                               StructField, StructType)

from .common import Stash

SCALE, SHIFT, LIMIT = 64, 1_000_000, 2.0 ** 53

#: How MLlib's matrix type is stored.
MATRIX = StructType([
    StructField("type", ByteType()), StructField("numRows", IntegerType()),
    StructField("numCols", IntegerType()), StructField("colPtrs", ArrayType(IntegerType())),
    StructField("rowIndices", ArrayType(IntegerType())), StructField("values", ArrayType(DoubleType())),
    StructField("isTransposed", BooleanType())])
#: Small row groups: a batch of blocks is decoded at once.
LAYOUT = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1"}

OUT = "dim int, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What the fit list of one vector length gives: exact n and S, eigenvalues
    in falling order and their unit vectors (as columns)."""

    dim: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    total: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part first, as integers, then the fraction."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n x - S)^2, exactly.

        With q = S div n, r = S mod n and y = x - q it is
        n^2 sum(y^2) - 2 n sum(r y) + sum(r^2)."""
        n = self.n
        q = [s // n for s in self.sums]
        r = [s % n for s in self.sums]
        y = x - np.array(q, np.int64)
        most = int(np.abs(y).max(initial=0))
        if self.dim * max(most * most, n * most) >= 1 << 62:
            y = y.astype(object)
            r_y = np.array(r, dtype=object)
        else:
            r_y = np.array(r, np.int64)
        squares, cross, last = (y * y).sum(axis=1), (y * r_y).sum(axis=1), sum(v * v for v in r)
        top = 10 ** 38
        found = [n * n * a - 2 * n * b + last for a, b in zip(squares.tolist(), cross.tolist())]
        return pa.array([Decimal(v) if v < top else None for v in found], pa.decimal128(38, 0))


def whole_numbers(column: pa.Array):
    """For each length of vector in a batch: (length, row numbers, x)."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        if len(rows) * dim == len(values):
            v = values.reshape(-1, dim)
        else:
            v = values[starts[rows][:, None] + np.arange(dim)]
        fine = np.isfinite(v).all(axis=1)
        if fine.any():
            v = np.clip(np.floor(SCALE * v[fine]), -LIMIT, LIMIT)
            yield dim, rows[fine], v.astype(np.int64) + SHIFT


def _pack(x: np.ndarray) -> pa.Array:
    """Each row's bytes: four to an entry if all of the row's entries fit, else eight."""
    narrow = (np.abs(x) < 1 << 31).all(axis=1)
    if narrow.all():
        x = np.ascontiguousarray(x, "<i4")
        offsets = np.arange(len(x) + 1, dtype=np.int32) * x.strides[0]
        return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])
    return pa.array([row.astype("<i4" if small else "<i8").tobytes() for row, small in zip(x, narrow)], pa.binary())


def _unpack(blobs: pa.Array, dim: int) -> np.ndarray:
    parts = blobs.to_pylist()
    if all(len(b) == 4 * dim for b in parts):
        return np.frombuffer(b"".join(parts), "<i4").reshape(-1, dim).astype(np.int64)
    return np.array([np.frombuffer(b, "<i4" if len(b) == 4 * dim else "<i8") for b in parts], np.int64)


def fit_list(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(dim, x): every distinct x vector once. Equal ones meet map-side first."""

    def run(batches):
        for batch in batches:
            for dim, _, x in whole_numbers(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), dim, np.int32)), _pack(x)], ["dim", "x"])

    return vectors.select(column).mapInArrow(run, "dim int, x binary").distinct()


def sums(distinct: DataFrame) -> list[Fit]:
    """Exact n and S of every vector length; one row per dimension comes back."""

    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                x = _unpack(batch.column("x").filter(pa.array(dims == dim)), dim)
                at = total.setdefault(dim, [0, np.zeros(dim, object)])
                at[0] += len(x)
                # High and low halves apart, so that long sums stay exact.
                at[1] = at[1] + ((x >> 32).sum(axis=0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(axis=0)
        for dim, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                 pa.array([Decimal(v) for v in s.tolist()], pa.decimal128(38, 0))], ["dim", "i", "n", "s"])

    per = (distinct.mapInArrow(run, "dim int, i int, n bigint, s decimal(38,0)")
           .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    by_dim: dict[int, dict[int, tuple]] = {}
    for row in per:
        by_dim.setdefault(row.dim, {})[row.i] = (row.n, int(row.s))
    return [Fit(dim, at[0][0], tuple(at[i][1] for i in range(dim))) for dim, at in sorted(by_dim.items())]


def _cells(block: np.ndarray, columns: int) -> list[dict]:
    """A block of rows as stored matrices, cut to ``columns`` columns each."""
    out = []
    for j in range(0, block.shape[1], columns):
        part = block[:, j:j + columns]
        out.append({"type": 1, "numRows": part.shape[0], "numCols": part.shape[1], "colPtrs": None,
                    "rowIndices": None, "values": part.ravel(order="F"), "isTransposed": False})
    return out


def _blocks(source: DataFrame, fit: Fit, read, rows: int, columns: int, id_type: DataType | None) -> DataFrame:
    """(part, seq, col, m[, ids, deviations]): centred blocks of at most ``rows``
    rows, filled and numbered within each task. ``read`` turns a batch into
    (x, ids)."""
    dim = fit.dim
    schema = StructType([StructField("part", IntegerType()), StructField("seq", IntegerType()),
                         StructField("col", IntegerType()), StructField("m", MATRIX)])
    if id_type is not None:
        schema = schema.add("ids", ArrayType(id_type)).add("deviations", ArrayType(
            StructType.fromDDL("v decimal(38,0)")["v"].dataType))

    def run(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit(x, ids):
            nonlocal seq
            arrow = None
            cells = _cells(fit.centred(x), columns)
            for col, cell in enumerate(cells):
                values = pa.array(cell.pop("values"))
                m = pa.StructArray.from_arrays(
                    [pa.array([cell["type"]], pa.int8()), pa.array([cell["numRows"]], pa.int32()),
                     pa.array([cell["numCols"]], pa.int32()), pa.nulls(1, pa.list_(pa.int32())),
                     pa.nulls(1, pa.list_(pa.int32())),
                     pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                     pa.array([False])],
                    ["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])
                arrays = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([col], pa.int32()), m]
                names = ["part", "seq", "col", "m"]
                if id_type is not None:
                    if arrow is None:
                        arrow = (pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), fit.deviations(x)))
                    none = [pa.nulls(1, a.type) for a in arrow]
                    arrays += arrow if col == 0 else none
                    names += ["ids", "deviations"]
                yield pa.RecordBatch.from_arrays(arrays, names)
            seq += 1

        def flush(last):
            nonlocal held, size
            if not held:
                return
            x = np.concatenate([h[0] for h in held])
            ids = pa.concat_arrays([h[1] for h in held]) if id_type is not None else None
            stop = len(x) if last else len(x) // rows * rows
            for a in range(0, stop, rows):
                yield from emit(x[a:min(a + rows, stop)], ids.slice(a, min(rows, stop - a)) if ids is not None else None)
            held = [(x[stop:], ids.slice(stop) if ids is not None else None)] if stop < len(x) else []
            size = len(x) - stop

        for batch in batches:
            for x, ids in read(batch, dim):
                held.append((x, ids))
                size += len(x)
                if size >= rows:
                    yield from flush(False)
        yield from flush(True)

    return source.mapInArrow(run, schema)


class _Matrix:
    """Stored blocks as ``BlockMatrix`` objects, one slab at a time."""

    def __init__(self, spark: SparkSession, path: str, rows: int, columns: int, width: int, slab_blocks: int):
        self.spark, self.path, self.rows, self.columns, self.width = spark, path, rows, columns, width
        schema = StructType([StructField("part", IntegerType()), StructField("seq", IntegerType()),
                             StructField("col", IntegerType()), StructField("m", MatrixUDT())])
        self.table = spark.read.schema(schema).parquet(path)
        parts, seqs, self.count = self.table.agg(F.max("part"), F.max("seq"), F.count("*")).first()
        #: Places of blocks: part * per_part + seq, with gaps where a task made fewer.
        self.per_part = (seqs or 0) + 1
        self.parts = -1 if parts is None else parts
        self.slab_parts = max(1, slab_blocks // self.per_part)

    def slabs(self):
        for first in range(0, self.parts + 1, self.slab_parts):
            yield first, self._slab(first)

    def _slab(self, first: int) -> BlockMatrix:
        place = ((F.col("part") - first) * self.per_part + F.col("seq")).cast("bigint")
        df = (self.table.where(F.col("part").between(first, first + self.slab_parts - 1))
              .select(F.struct(place.alias("_1"), F.col("col").cast("bigint").alias("_2")).alias("_1"), "m"))
        span = min(self.slab_parts, self.parts + 1 - first) * self.per_part
        java = callMLlibFunc("createBlockMatrix", df, self.rows, self.columns, span * self.rows, self.width)
        return BlockMatrix(java, self.rows, self.columns)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a x b with the inner dimension dealt to ``splits`` tasks (MLlib's own
    parameter; the Python wrapper leaves it at one)."""
    java = a._java_matrix_wrapper._java_model.multiply(b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def gram(matrix: _Matrix, blocks_a_task: int) -> np.ndarray:
    """Transposed times itself, summed over the slabs."""
    out = np.zeros((matrix.width, matrix.width))
    for _, slab in matrix.slabs():
        splits = max(1, -(-min(matrix.count, matrix.slab_parts * matrix.per_part) // blocks_a_task))
        out += _times(slab.transpose(), slab, splits).toLocalMatrix().toArray()
    return out


def decompose(fit: Fit, scatter: np.ndarray) -> Fit:
    v = scatter / fit.n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    biggest = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None, :], axis=0)
    real = values > fit.dim * np.finfo(float).eps * max(values[0], 0.0)
    return Fit(fit.dim, fit.n, fit.sums, values[real], (vectors * np.sign(biggest))[:, real], float(np.trace(v)))


def _project(matrix: _Matrix, w: np.ndarray, path: str) -> None:
    """Every block times ``w``, stored with the block's place."""
    sc = matrix.spark.sparkContext
    columns = matrix.columns
    parts = [((j // columns, 0), DenseMatrix(len(p), w.shape[1], p.ravel(order="F")))
             for j in range(0, len(w), columns) for p in [w[j:j + columns]]]
    weights = BlockMatrix(sc.parallelize(parts, 1), columns, w.shape[1], len(w), w.shape[1])
    for first, slab in matrix.slabs():
        done = slab.multiply(weights)
        blocks = callMLlibFunc("getMatrixBlocks", done._java_matrix_wrapper._java_model).toDF("at", "m")
        place = F.col("at._1")
        (blocks.select((F.lit(first) + F.floor(place / matrix.per_part)).cast("int").alias("part"),
                       (place % matrix.per_part).cast("int").alias("seq"), F.lit(0).alias("col"), "m")
         .write.options(**LAYOUT).mode("append").parquet(path))


def whiten(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", components: int = 16,
           block_bytes: int = 512 << 10, blocks_a_task: int = 16, slab_blocks: int = 1 << 16,
           columns: int = 512) -> DataFrame:
    """One row per vector and component: (id, dim, component, n, deviation,
    whitened, explained, identity_error)."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    empty = spark.createDataFrame([], StructType([vectors.schema[id_col]] + list(StructType.fromDDL(OUT))))
    stash = Stash(spark, "whitening")
    distinct = stash.put(fit_list(vectors, column))
    found = []
    for fit in sums(distinct):
        rows = max(1, block_bytes // (8 * fit.dim))
        cut = min(fit.dim, columns)

        def read_fit(batch, dim):
            if batch.num_rows:
                yield _unpack(batch.column("x"), dim), None

        def read_all(batch, dim):
            for d, at, x in whole_numbers(batch.column(1)):
                if d == dim:
                    yield x, batch.column(0).take(pa.array(at))

        def stored(df):
            kept = stash.put(df, **LAYOUT)
            return kept, _Matrix(spark, kept._stash_path, rows, cut, fit.dim, slab_blocks)

        fit_blocks, fit_matrix = stored(_blocks(distinct.where(F.col("dim") == fit.dim), fit, read_fit, rows, cut, None))
        fit = decompose(fit, gram(fit_matrix, blocks_a_task))
        k = min(components, len(fit.values))
        if not k:
            stash.drop(fit_blocks)
            continue
        w = fit.vectors[:, :k] / np.sqrt(fit.values[:k])
        _project(fit_matrix, w, f"{stash.root}/fit-{fit.dim}")
        white = _Matrix(spark, f"{stash.root}/fit-{fit.dim}", rows, k, k, slab_blocks)
        # The whitened fit list has mean zero, as its rows were centred.
        error = float(np.abs(gram(white, blocks_a_task) / fit.n - np.eye(k)).max())
        stash.drop(fit_blocks)
        stash.remove(f"{stash.root}/fit-{fit.dim}")
        every, matrix = stored(_blocks(vectors.select(id_col, column), fit, read_all, rows, cut, id_type))
        _project(matrix, w, f"{stash.root}/rows-{fit.dim}")
        found.append(_rows(spark, every, f"{stash.root}/rows-{fit.dim}", vectors.schema[id_col], fit, k, error))
    stash.drop(distinct)
    return reduce(DataFrame.unionByName, found) if found else empty


def _rows(spark: SparkSession, every: DataFrame, path: str, id_field: StructField, fit: Fit, k: int,
          error: float) -> DataFrame:
    """Blocks back to rows: ids and whitened values meet by the block's place."""
    projected = (spark.read.schema(StructType([StructField("part", IntegerType()), StructField("seq", IntegerType()),
                                               StructField("m", MATRIX)])).parquet(path)
                 .select("part", "seq", F.col("m.values").alias("values"), F.col("m.isTransposed").alias("flip")))
    joined = every.where("col = 0").select("part", "seq", "ids", "deviations").join(projected, ["part", "seq"])
    share = fit.values[:k] / fit.total
    schema = StructType([id_field] + list(StructType.fromDDL(OUT)))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, devs, values = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "deviations", "values"))
                m = values.to_numpy(zero_copy_only=False)
                m = m.reshape(-1, k) if batch.column("flip")[i].as_py() else m.reshape(k, -1).T
                n = len(m)
                at = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), pa.array(np.full(n * k, fit.dim, np.int32)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, fit.n, np.int64)), devs.take(at), pa.array(m.ravel()),
                     pa.array(np.tile(share, n)), pa.array(np.full(n * k, error))],
                    [f.name for f in schema])

    return joined.mapInArrow(run, schema)
