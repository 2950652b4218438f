"""Approximate nearest neighbours through shifted space-filling curves.

Each of several curves projects the vectors on a random low-dimensional frame,
scales every axis by quantiles of a bounded sample, shifts the grid by its own
share of the cell range and orders the vectors by Hilbert key. The order is
range-partitioned and stored; a vector's rank is its place in it. A query looks
at the rows within ``window`` ranks on every curve; the blocks of the order that
such a window touches are compared with it in double precision, and the results
of all curves and blocks merge and rerank.

The window is calibrated, not fixed: for at most ``probe`` queries the exact
neighbours are found by one pass over all rows, and the window is the quantile
of the rank distances (the nearest over the curves) that reaches ``recall``.
Vectors that cluster get short windows; vectors that fill their space evenly in
many dimensions get long ones, as any ordering of them must.

Bounds: the sample that fits the scales (``sample``), the probe and a block
(``block`` rows) are fixed; every row is indexed. Crowded query blocks are split
by salt. Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part; vectors of different dimension are not
compared; equal vectors tie and go by smaller id; repeated rows are candidates
of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import Stash, with_row
from .vectors import as_binary, matrix, rotation


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows) with ``bits`` bits per axis, by
    the transposed-index recurrence (exchange and invert low bits, then Gray)."""
    x = grid.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(v: np.ndarray, scales: list[np.ndarray], axes: int, bits: int, curves: int,
               seed: int) -> np.ndarray:
    """(rows, curves) Hilbert keys. ``scales[c]``: per axis the sample's quantiles."""
    out = np.empty((len(v), curves), np.int64)
    for c in range(curves):
        frame = rotation(v.shape[1], seed + c)[:axes]
        y = v @ frame.T
        cells = 1 << (bits - 1)  # the shift takes up the other half of the range
        grid = np.empty(y.shape, np.int64)
        for a in range(y.shape[1]):
            grid[:, a] = np.searchsorted(scales[c][a], y[:, a]) * cells // (len(scales[c][a]) + 1)
        out[:, c] = hilbert_keys(grid + c * cells // curves, bits)
    return out


def nearest(q: np.ndarray, q_row: np.ndarray, x: np.ndarray, x_row: np.ndarray,
            x_id: np.ndarray, k: int):
    """(query index, candidate index, distance) of the k nearest of each query,
    own row excluded, ties by id; distances are computed on the differences."""
    qi, xi, dd = [], [], []
    xx = np.einsum("ij,ij->i", x, x)
    for s in range(0, len(q), 64):
        part = q[s:s + 64]
        rough = np.maximum(np.einsum("ij,ij->i", part, part)[:, None] + xx - 2 * part @ x.T, 0)
        rough[q_row[s:s + 64, None] == x_row] = np.inf
        for n in range(len(part)):
            r = rough[n]
            if len(r) > k:
                kth = np.partition(r, k - 1)[k - 1]
                cand = np.flatnonzero((r <= kth + 1e-9 * (1 + xx.max(initial=0))) & (r < np.inf))
            else:
                cand = np.flatnonzero(r < np.inf)
            d = np.sqrt(((x[cand] - part[n]) ** 2).sum(1))
            best = np.lexsort((x_row[cand], x_id[cand], d))[:k]
            qi.append(np.full(len(best), s + n))
            xi.append(cand[best])
            dd.append(d[best])
    if not qi:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(qi), np.concatenate(xi), np.concatenate(dd)


_HIT = "q_row bigint, query_id bigint, row bigint, vec_id bigint, score double"


def _hits(q: pd.DataFrame, x: pd.DataFrame, k: int) -> pd.DataFrame:
    i, j, d = nearest(matrix(q["vec"].tolist()), q["_row"].to_numpy(), matrix(x["vec"].tolist()),
                      x["_row"].to_numpy(), x["vec_id"].to_numpy(), k)
    return pd.DataFrame({"q_row": q["_row"].to_numpy()[i], "query_id": q["vec_id"].to_numpy()[i],
                         "row": x["_row"].to_numpy()[j], "vec_id": x["vec_id"].to_numpy()[j], "score": d})


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best per query; a candidate met more than once counts once."""
    by = Window.partitionBy("q_row").orderBy("score", "vec_id", "row")
    hits = hits.groupBy("q_row", "query_id", "row", "vec_id").agg(F.min("score").alias("score"))
    return hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def exact(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Neighbours of a bounded set of queries by one pass over all vectors."""
    held = vectors.sparkSession.sparkContext.broadcast(queries.select("_row", "vec_id", "dim", "vec").toPandas())

    def run(batches):
        for pdf in batches:
            for dim, x in pdf.groupby("dim"):
                q = held.value[held.value["dim"] == dim]
                if len(q):
                    yield _hits(q, x, k)

    return _top(vectors.select("_row", "vec_id", "dim", "vec").mapInPandas(run, _HIT), k)


def search(vectors: DataFrame, is_query, k: int = 10, curves: int = 8, axes: int = 8, bits: int = 7,
           recall: float = 0.97, probe: int = 200, sample: int = 10_000, block: int = 1024,
           query_rows: int = 4096, seed: int = 23, id_col: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, window): neighbours of the rows where
    ``is_query`` (a column over ``vec_id``) holds, among all rows but their own."""
    spark = vectors.sparkSession
    stash = Stash(spark, "hilbert")
    rows = as_binary(with_row(vectors.select(F.col(id_col).alias("vec_id"), column)), ["_row", "vec_id"], column)
    rows = stash.put(rows.where("vec is not null and vec_id is not null")
                     .withColumn("query", F.coalesce(is_query, F.lit(False))))
    sizes = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("query").alias("q")).collect()}  # one row per dimension
    parts = [_search_dim(stash, rows.where(F.col("dim") == dim), dim, n, q, k, curves, min(axes, dim), bits,
                         recall, probe, sample, block, query_rows, seed)
             for dim, (n, q) in sorted(sizes.items()) if q]
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, window bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def draw_of(seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(1 << 20))


def _search_dim(stash, rows, dim, n, n_query, k, curves, axes, bits, recall, probe, sample, block,
                query_rows, seed) -> DataFrame:
    spark = rows.sparkSession
    fit = rows.where(draw_of(seed) <= int(min(1.0, sample / n) * (1 << 20))).select("vec").toPandas()
    v = matrix(fit["vec"].tolist()) if len(fit) else np.zeros((1, dim))
    # Quantiles of each axis: 256 numbers per axis and curve, whatever the rows.
    grades = np.linspace(0, 1, 257)[1:-1]
    scales = spark.sparkContext.broadcast(
        [list(np.quantile(v @ rotation(dim, seed + c)[:axes].T, grades, axis=0).T) for c in range(curves)])

    def key(batches):
        for pdf in batches:
            if len(pdf):
                keys = curve_keys(matrix(pdf["vec"].tolist()), scales.value, axes, bits, curves, seed)
                yield pdf.assign(keys=keys.tolist())

    index = (rows.mapInPandas(key, StructType([*rows.schema, StructField("keys", ArrayType(LongType()))]))
             .select("_row", "vec_id", "query", "vec", F.posexplode("keys").alias("curve", "key")))
    width = max(1, math.ceil(n * curves / (16 * block)))
    index = (index.repartitionByRange(width, "curve", "key", "_row").sortWithinPartitions("curve", "key", "_row")
             .withColumn("pid", F.spark_partition_id())
             .withColumn("local", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    index = stash.put(index)
    start = index.groupBy("curve", "pid").agg(F.min("local").alias("first"), F.count("*").alias("c"))
    start = start.withColumn("before", F.sum("c").over(Window.partitionBy("curve").orderBy("pid")) - F.col("c"))
    index = index.join(start.select("curve", "pid", "first", "before"), ["curve", "pid"])
    index = index.withColumn("at", F.col("before") + F.col("local") - F.col("first"))

    probes = rows.where("query").where(draw_of(seed + 1) <= int(min(1.0, probe / n_query) * (1 << 20)))
    truth = stash.put(exact(probes, rows, k))
    at = index.select("_row", "curve", "at")
    apart = (truth.join(at.withColumnRenamed("_row", "q_row").withColumnRenamed("at", "q_at"), "q_row")
             .join(at.withColumnRenamed("_row", "row"), ["row", "curve"])
             .groupBy("q_row", "row").agg(F.min(F.abs(F.col("at") - F.col("q_at"))).alias("d")))
    window = apart.agg(F.percentile("d", F.lit(recall))).first()[0]
    window = max(k, math.ceil(window)) if window is not None else n

    def blk(c):
        return F.floor(c / block).cast("bigint")

    blocks = math.ceil(n / block)
    salts = max(1, math.ceil(n_query * (2 * window / block + 1) / blocks / query_rows))
    asked = index.where("query").withColumn("b", F.explode(F.sequence(
        blk(F.greatest(F.col("at") - window, F.lit(0))), blk(F.least(F.col("at") + window, F.lit(n - 1))))))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    offered = index.withColumn("b", blk(F.col("at"))).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    cols = ["curve", "b", "salt", "_row", "vec_id", "vec"]
    both = asked.select(*cols, F.lit(True).alias("ask")).unionByName(offered.select(*cols, F.lit(False).alias("ask")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ask = pdf["ask"].to_numpy()
        if not ask.any() or ask.all():
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (
                ("q_row", "int64"), ("query_id", "int64"), ("row", "int64"), ("vec_id", "int64"), ("score", "float64"))})
        return _hits(pdf[ask], pdf[~ask], k)

    best = _top(both.groupBy("curve", "b", "salt").applyInPandas(compare, _HIT), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score",
                       F.lit(window).cast("bigint").alias("window"))

