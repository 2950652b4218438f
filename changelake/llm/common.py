"""Helpers shared by the operators: lineage cuts, row ids, linking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import scratch_dir

#: Words are runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


class Stash:
    """Intermediate tables under the shared checkpoint folder.

    ``put`` writes a frame as Parquet and reads it back, which cuts the
    lineage, survives lost executors and fixes nondeterministic row order.
    Tables that a later step has replaced are removed with ``drop``; the ones
    that the returned frame still reads stay under ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_dir(spark, purpose)
        self._n = 0
        self._paths: dict[int, str] = {}

    def put(self, df: DataFrame, at: str | None = None, **options: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{at or f'{self._n:03d}'}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._stash_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = getattr(df, "_stash_path", None)
            if path:
                self.remove(path)

    def remove(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem = "_" + stem
    return stem


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows of a stored table: a long from the file's path and the
    row's place in the file. Every read of the same files gives a row the same
    number, however Spark splits them and however many cores there are.

    The upper bits are as many leading bits of the path's hash as tell all files
    apart (one hash a file comes to the driver, which holds the list of files
    anyway, as Spark's own index); the rest is the place in the file, and a file
    too long for it raises an error. A frame that is not read from files is
    numbered by partition: its numbers hold only while its partitions stay the
    same, so store it first.
    """
    files = df.inputFiles()
    path, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    if files:
        try:
            bits = _path_bits(df.select(F.xxhash64(path)), files)
        except AnalysisException:   # a frame made from files in tasks
            files = []
    if not files:
        return df.withColumn(name, F.monotonically_increasing_id())
    file_no = F.shiftrightunsigned(F.xxhash64(path), 64 - bits)
    fits = F.when(at < (1 << (63 - bits)), at).otherwise(
        F.raise_error(F.lit("a file has more rows than its row numbers can hold")).cast("bigint"))
    return df.withColumn(name, F.shiftleft(file_no, 63 - bits).bitwiseOR(fits))


_bits_of: dict[int, int] = {}


def _path_bits(hashes: DataFrame, files: list[str]) -> int:
    """Leading bits that tell the paths' hashes apart; known per set of files."""
    key = hash(tuple(sorted(files)))
    if key not in _bits_of:
        found = np.array([r[0] for r in hashes.distinct().collect()], np.int64).view(np.uint64)
        _bits_of[key] = next(b for b in range(1, 63) if len(np.unique(found >> np.uint64(64 - b))) == len(found))
    return _bits_of[key]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20):
    """Cut a batch so that ``column`` holds about ``max_bytes`` at most."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def union_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i] in place; a set's label is its least index."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def expand_ranges(lo: np.ndarray, hi: np.ndarray, max_pairs: int = 1 << 21):
    """Pairs (i, j) with lo[i] <= j < hi[i], in chunks of about ``max_pairs``."""
    counts = np.maximum(hi - lo, 0)
    rows = np.flatnonzero(counts)
    done = 0
    ends = np.cumsum(counts[rows])
    while done < len(rows):
        base = ends[done - 1] if done else 0
        first = rows[done]
        if counts[first] > max_pairs:  # one long range: in parts
            for s in range(int(lo[first]), int(hi[first]), max_pairs):
                j = np.arange(s, min(s + max_pairs, int(hi[first])))
                yield np.full(len(j), first), j
            done += 1
            continue
        stop = max(done + 1, int(np.searchsorted(ends, base + max_pairs, side="right")))
        part = rows[done:stop]
        c = counts[part]
        i = np.repeat(part, c)
        within = np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        yield i, lo[i] + within
        done = stop


def connected(spark: SparkSession, edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, root), root the least node.

    Alternating large-star and small-star steps; every step is a grouped minimum
    (combined before the shuffle) and a join that AQE may split, so a node with
    very many links does not pile up in one task. Each round is written to the
    shared folder; the loop ends when a round leaves the links unchanged. Nodes
    without links do not appear.
    """
    stash = Stash(spark, purpose)
    now = stash.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                 F.least("a", "b").alias("v")).distinct())

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = stash.put(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        nxt = stash.put(small)
        stash.drop(now, large)
        now, before, seen = nxt, seen, mark(nxt)
        if seen == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
