"""Embedding near-duplicates through randomised-rotation binary codes.

A unit vector u is rotated at random and kept as its signs, x = sign(Pu) /
sqrt(D), with the correction factor f = <x, Pu>. For a unit vector v,
<x, Pv> / f is an unbiased estimate of <u, v>, and its error is within
``sigmas`` sqrt((1 - f^2) / f^2) / sqrt(D - 1) but for a vanishing probability
(and never above sqrt((1 - f^2) / f^2)). A pair whose upper bound stays below
the threshold is dropped; every other pair is computed again exactly, in double
precision, so no reported link is below the threshold.

Which pairs are estimated: the signs of several rotations are read as keys of
``b`` bits in L tables, and pairs that share a key in some table are compared.
One sign differs with probability acos(threshold) / pi, so with
L = ln(miss) / ln(1 - p^b) tables a pair at the threshold is missed with
probability ``miss`` (1e-6), a closer one with less. b follows from the largest
label, by the same formula at every size. A bucket of more than ``block`` rows
is compared in pairs of blocks, all of them, in as many tasks.

Equal vectors are one representative with a multiplicity. Links are counted in
the first table that a pair shares, so no pair is emitted: a task returns sums
per vector and a spanning star for the components.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and rows without a label, link with nothing; vectors of
different dimension do not link. Repeated rows (also of vec_id) are rows of
their own and link as equal vectors. A null vec_id is never kept.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import Stash, connected, union_labels, with_row
from .vectors import as_binary, matrix, rotation


def tables_for(rows: int, threshold: float, miss: float = 1e-6, fill: int = 64) -> tuple[int, int]:
    """(bits per key, number of tables) for the largest label's row count."""
    bits = min(30, max(6, math.ceil(math.log2(max(rows, 1) / fill))))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - p))


def keys_of(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One int32 key per table from the signs of random rotations."""
    dim = unit.shape[1]
    signs, r = [], 0
    while sum(s.shape[1] for s in signs) < bits * tables:
        signs.append(unit @ rotation(dim, seed + r).T > 0)
        r += 1
    flat = np.concatenate(signs, axis=1)[:, :bits * tables].reshape(len(unit), tables, bits)
    return (flat @ (1 << np.arange(bits))).astype("<i4")


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, sigmas: float, seed: int):
    """(i, j) with cosine(a[i], b[j]) >= threshold; rows are unit vectors."""
    dim = a.shape[1]
    turn = rotation(dim, seed)
    ra, rb = a @ turn.T, b @ turn.T
    code = np.where(ra > 0, 1.0, -1.0) / math.sqrt(dim)
    f = np.abs(ra).sum(1) / math.sqrt(dim)
    spread = np.sqrt(np.maximum(1 - f * f, 0)) / f
    bound = spread * min(1.0, sigmas / math.sqrt(max(dim - 1, 1))) + 1e-9
    i, j = np.nonzero((code @ rb.T) / f[:, None] + bound[:, None] >= threshold)
    exact = np.empty(len(i))
    for s in range(0, len(i), 1 << 15):  # two blocks of near copies give block^2 pairs
        e = s + (1 << 15)
        exact[s:e] = np.einsum("ij,ij->i", a[i[s:e]], b[j[s:e]])
    keep = exact >= threshold
    return i[keep], j[keep]


def links(vectors: DataFrame, threshold: float = 0.98, sigmas: float = 5.0, seed: int = 11,
          block: int = 1000, task_rows: int = 10_000, id_col: str = "vec_id",
          column: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    stash = Stash(spark, "rabitq")
    rows = as_binary(with_row(vectors.select(F.col(id_col).alias("vec_id"), "label", column)),
                     ["_row", "vec_id", "label"], column)
    rows = rows.withColumn("vec", F.when(F.col("label").isNotNull(), F.col("vec")))
    # Equal vectors of a label: one digest, one representative.
    rows = stash.put(rows.withColumn("same", F.when(F.col("vec").isNotNull(), F.sha2(F.concat_ws(
        "|", F.col("label").cast("string"), F.hex("vec")), 256))))
    reps = rows.where("same is not null").groupBy("same").agg(
        F.min("_row").alias("rep"), F.count("*").alias("mult"))
    reps = stash.put(reps)
    seen = rows.where("same is not null").select("_row", "label", "dim", "vec").join(
        reps.select(F.col("rep").alias("_row"), "mult"), "_row")
    largest = (seen.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]) or 0
    bits, tables = tables_for(largest, threshold)

    def encode(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                v = matrix(part["vec"].tolist())
                unit = v / np.linalg.norm(v, axis=1, keepdims=True)
                keys = keys_of(unit, bits, tables, seed)
                yield part.assign(vec=[u.astype("<f8").tobytes() for u in unit],
                                  code=[k.tobytes() for k in keys], key=[k.tolist() for k in keys])

    schema = StructType([*seen.schema, StructField("code", BinaryType()),
                         StructField("key", ArrayType(IntegerType()))])
    coded = seen.mapInPandas(encode, schema)
    each = stash.put(coded.withColumnRenamed("_row", "rep")).select(
        "rep", "mult", "label", "dim", "vec", "code", F.posexplode("key").alias("t", "k"))
    bucket = ["label", "dim", "t", "k"]
    # Only buckets over the block size are split.
    big = stash.put(each.groupBy(*bucket).agg(F.count("*").alias("size"), F.ceil(F.count("*") / block).cast("int")
                                              .alias("nb")).where("nb > 1"))
    each = each.join(big.drop("size"), bucket, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    each = each.withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    each = each.withColumn("oth", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    each = each.withColumn("p", F.least("blk", "oth")).withColumn("q", F.greatest("blk", "oth"))
    # Rows after the explode: a split bucket's rows count once for every block.
    total = reps.count() * tables + (big.agg(F.sum(F.col("size") * (F.col("nb") - 1))).first()[0] or 0)
    each = each.withColumn("task", F.pmod(F.xxhash64(*bucket, "p", "q"),
                                          F.lit(max(1, math.ceil(total / task_rows)))))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, dim, t, _, p, q), part in pdf.groupby([*bucket, "p", "q"], sort=False):
            if len(part) < 2:
                continue
            unit = matrix(part["vec"].tolist())
            code = np.frombuffer(b"".join(part["code"]), "<i4").reshape(len(part), tables)
            rep, mult, blk = (part[c].to_numpy() for c in ("rep", "mult", "blk"))
            left = np.flatnonzero(blk == p)
            right = np.flatnonzero(blk == q)
            i, j = close_pairs(unit[left], unit[right], threshold, sigmas, seed)
            i, j = left[i], right[j]
            if p == q:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            labels = np.arange(len(part))
            union_labels(labels, i, j)
            child = np.flatnonzero(labels != np.arange(len(part)))
            out.append(pd.DataFrame({"a": rep[child], "b": rep[labels[child]], "n": 0}))
            for s in range(0, len(i), 1 << 18):  # counted where the pair meets first
                x, y = i[s:s + (1 << 18)], j[s:s + (1 << 18)]
                new = ~(code[x, :t] == code[y, :t]).any(axis=1)
                x, y = x[new], y[new]
                n = (np.bincount(x, weights=mult[y], minlength=len(part))
                     + np.bincount(y, weights=mult[x], minlength=len(part))).astype(np.int64)
                has = np.flatnonzero(n)
                out.append(pd.DataFrame({"a": rep[has], "b": rep[has], "n": n[has]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")

    found = stash.put(each.select("task", *bucket, "p", "q", "blk", "rep", "mult", "vec", "code")
                      .groupBy("task").applyInPandas(compare, "a bigint, b bigint, n bigint"))
    degree = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    roots = connected(spark, found.where("a <> b").select("a", "b"), "rabitq-groups")
    reps = (reps.join(degree, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("same", "mult", F.coalesce("others", F.lit(0)).alias("others"),
                    F.coalesce("root", "rep").alias("root")))
    reps = stash.put(reps)
    member = rows.where("same is not null").select("vec_id", "same").join(reps, "same")
    least = member.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = member.join(least, "root").select(
        "vec_id", (F.col("others") + F.col("mult") - 1).alias("n_links"), "component_id")
    alone = rows.where("same is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
