"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct hashed words, word pairs and one-word-gap skip-grams
of the whole text, each 1 if present. Training runs in rounds: every shard of
the labelled sample starts from the shared state, makes one FTRL pass with
per-coordinate rates, and the states are averaged; the rarer label counts
``positive`` times. The average is taken on the executors, block by block of the
coordinates, so the driver gets one state a round and not one from every shard. L1 keeps most weights at exactly zero. The state has
``2**bits`` coordinates whatever the corpus, so its broadcast and what comes
back to the driver are bounded (8 MB each a round at 20 bits).

The labelled sample is bounded: about ``sample_rows`` rows, chosen by a hash of
the id. Rows of the held-out fold (crc32(doc_id) mod ``folds`` = 0) are never
learnt from. Scoring reads every row.

Defined results: a null text counts as empty; a text without features gets the
score of the bias alone. Null ids are never learnt from and not held out. Of
several labels for one id the highest counts; null labels are ignored. Without
any labelled document, be there labels or not, every score is 0. Repeated rows are
scored alike.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, fresh, slices

_STRIP = re.compile(r"[\W_]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _word_hash(word: str) -> int:
    word = _STRIP.sub("", word.lower())
    return xxhash.xxh64_intdigest(word) | 1 if word else 0


def doc_features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every n-gram occurrence of a batch of texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.utf8_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    table = np.fromiter(map(_word_hash, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    h = table[words.indices.to_numpy(zero_copy_only=False)] if len(table) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = h != 0
    h, doc = h[real], doc[real]
    down = np.uint64(64 - bits)
    found = [(doc, (h * _MIX[0]) >> down)]
    for gap in (1, 2):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        a, b = h[:-gap][same] if len(same) else h[:0], h[gap:][same] if len(same) else h[:0]
        mixed = (a * _MIX[gap]) ^ (b << np.uint64(17) | b >> np.uint64(47))
        found.append((doc[gap:][same] if len(same) else doc[:0], (mixed * _MIX[0]) >> down))
    return (np.concatenate([x for x, _ in found]),
            np.concatenate([x for _, x in found]).astype(np.int64))


def weights_of(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float):
    return np.where(np.abs(z) <= l1, 0.0,
                    (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def _crc_fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bits: int = 20,
          sample_rows: int = 16_000, shards: int = 4, rounds: int = 8, alpha: float = 1.0,
          beta: float = 1.0, l1: float = 10.0, l2: float = 0.1, positive: float = 3.0,
          folds: int = 5, blocks: int = 16) -> np.ndarray | None:
    """Weights (bias last), or None if there is no labelled document to learn from."""
    spark = docs.sparkSession
    size = (1 << bits) + 1
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
           .where(_crc_fold(F.col("doc_id"), folds) != 0)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    total = ids.count()
    if not total:
        return None
    draw = F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), F.lit(1 << 20))
    chosen = draw < int(min(1.0, sample_rows / total) * (1 << 20))
    rows = (docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & chosen)
            .join(ids.where(chosen), "doc_id")
            .select("y", "text", F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(shards)).alias("shard")))

    def featurise(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                doc, feat = doc_features(part.column("text"), bits)
                pairs = np.unique(doc << np.int64(32) | feat)
                doc, feat = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int32)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(feat))
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("y"), lists], ["shard", "y", "x"])

    rows = Stash(spark, "toxicity").put(
        rows.mapInArrow(featurise, "shard bigint, y int, x array<int>"))
    if not rows.limit(1).count():
        return None   # labels of other documents only
    # Dealt to the shards once for all rounds; lost blocks come back from the table.
    rows = rows.repartition(shards, "shard").persist(StorageLevel.MEMORY_AND_DISK)
    z, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
    edges = [size * b // blocks for b in range(blocks + 1)]
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))

        def one_pass(pdf: pd.DataFrame) -> pd.DataFrame:
            z, n = (v.astype(np.float64) for v in state.value)
            order = np.random.default_rng(7).permutation(len(pdf))
            ys, xs = pdf["y"].to_numpy(), pdf["x"].to_numpy()
            for k in order:
                x = np.append(xs[k], size - 1).astype(np.int64)
                nx, zx = n[x], z[x]
                w = weights_of(zx, nx, alpha, beta, l1, l2)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - ys[k]
                g *= positive if ys[k] else 1.0
                z[x] = zx + g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / alpha * w
                n[x] = nx + g * g
            dz, dn = ((v - old).astype("<f4") for v, old in zip((z, n), state.value))
            return pd.DataFrame({"block": range(blocks), "shard": pdf["shard"].iloc[0],
                                 "dz": [dz[a:b].tobytes() for a, b in zip(edges, edges[1:])],
                                 "dn": [dn[a:b].tobytes() for a, b in zip(edges, edges[1:])]})

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("shard")  # so reruns add in the same order
            dz, dn = (sum(np.frombuffer(x, "<f4").astype(np.float64) for x in pdf[c]) / shards
                      for c in ("dz", "dn"))
            return pd.DataFrame({"block": pdf["block"].iloc[:1], "dz": [dz.astype("<f4").tobytes()],
                                 "dn": [dn.astype("<f4").tobytes()]})

        kind = "block int, dz binary, dn binary"
        # 2**bits + 1 coordinates in all, whatever the input and the shards. They come
        # as Arrow: rows would be unpacked and pickled in the driver's memory first.
        deltas = (rows.select("shard", "y", "x").groupBy("shard").applyInPandas(one_pass, f"shard bigint, {kind}")
                  .groupBy("block").applyInPandas(average, kind)).toArrow()
        state.destroy()
        for block, dz, dn in zip(*deltas.columns):
            at = slice(edges[block.as_py()], edges[block.as_py() + 1])
            z[at] += np.frombuffer(dz.as_buffer(), "<f4")
            n[at] += np.frombuffer(dn.as_buffer(), "<f4")
        del deltas
    rows.unpersist()
    return weights_of(z, n, alpha, beta, l1, l2)


def score(docs: DataFrame, weights: np.ndarray | None, bits: int = 20,
          keep: tuple[str, ...] | None = None, text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` columns (default all) and the score as ``name``; the text is read
    whole."""
    keep = tuple(docs.columns) if keep is None else keep
    if weights is None:
        return docs.select(*keep, F.lit(0.0).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    bias = float(weights[-1])
    whole = fresh(docs, "_t")

    def run(batches):
        w = shared.value
        for batch in batches:
            for part in slices(batch, whole, 2 << 20):
                doc, feat = doc_features(part.column(whole), bits)
                wx = w[feat]
                hit = wx != 0
                pairs = np.unique(doc[hit] << np.int64(32) | feat[hit])
                total = np.bincount(pairs >> 32, weights=w[pairs & 0xFFFFFFFF].astype(np.float64),
                                    minlength=part.num_rows)
                p = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keep] + [pa.array(p)], [*keep, name])

    from pyspark.sql.types import DoubleType, StructField, StructType
    src = docs.select(*keep, F.col(text).alias(whole))
    schema = StructType([src.schema[k] for k in keep] + [StructField(name, DoubleType())])
    return src.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(_crc_fold(F.col(doc_id), folds) == 0, F.lit(False))
