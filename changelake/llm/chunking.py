"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes: h = 2 h + gear[byte], modulo 2^32, so it
depends on the last 32 bytes only. A chunk ends where the hash's upper
``mask_bits`` bits are zero, not before ``least`` and not after ``most`` bytes; an
insertion moves only the chunks around it. Chunks are deduplicated by 128-bit
digest over the whole table: the first place of a digest (least id, then row,
then position) stays, the others are repeats. A document loses a run of
neighbouring repeats if the run has ``min_words`` words or more, so short shared
lines stay.

Defined results: a null text counts as empty and has no chunks; repeated rows
are rows of their own, the later ones repeats of the first; rows with null ids
come after all others. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, fresh, slices, with_row


def gear_table(seed: int = 29) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes, gear: np.ndarray, mask_bits: int, least: int, most: int) -> list[int]:
    """Ends of the chunks, the last one the text's end."""
    n = len(data)
    if not n:
        return []
    # Doubling: the hash over 2 w bytes from two hashes over w bytes.
    h = gear[np.frombuffer(data, np.uint8)]
    w = 1
    while w < 32:
        if n > w:
            h[w:] = h[w:] + (h[:-w] << np.uint32(w))
        w *= 2
    spots = (np.flatnonzero(h >> np.uint32(32 - mask_bits) == 0) + 1).tolist()
    ends, last = [], 0
    for s in spots:
        while s - last > most:
            last += most
            ends.append(last)
        if s - last >= least:
            ends.append(s)
            last = s
    while n - last > most:
        last += most
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunks(docs: DataFrame, mask_bits: int = 5, least: int = 32, most: int = 512,
           seed: int = 29) -> DataFrame:
    """(_row, doc_id, place, digest) of ``docs(_row, doc_id, text)``. ``place`` holds
    a chunk's start, size and number of words in one long: the start from bit 20
    up, then ten bits each, so a chunk has under 1024 bytes."""
    if not 0 < least <= most < 1024:
        raise ValueError("chunks must be under 1024 bytes")

    def run(batches):
        gear = gear_table(seed)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                of, place, digest = [], [], []
                for k, data in enumerate(part.column("text").to_pylist()):
                    last = 0
                    for end in cut_points(data or b"", gear, mask_bits, least, most):
                        piece = data[last:end]
                        of.append(k)
                        place.append(last << 20 | (end - last) << 10 | len(piece.split()))
                        digest.append(xxhash.xxh3_128_digest(piece))
                        last = end
                take = pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row").take(take), part.column("doc_id").take(take),
                     pa.array(place, pa.int64()), pa.array(digest, pa.binary())],
                    ["_row", "doc_id", "place", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("_row", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"_row bigint, doc_id {kind}, place bigint, digest binary")


def repeats(docs: DataFrame, min_words: int = 25, id_col: str = "doc_id", text: str = "text",
            **params) -> DataFrame:
    """One row per document: n_bytes, n_chunks, n_shared (chunks whose digest
    stands elsewhere too), shared_words (words of the longest run of such
    chunks, first occurrences included), n_removed (bytes), spans (removed,
    ``start:end``)."""
    stash = Stash(docs.sparkSession, "chunks")
    src = with_row(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    every = stash.put(chunks(src, **params))
    where = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row", "place")
    firsts = (every.groupBy("digest").agg(F.min(where).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", F.col("first._row").alias("first_row"),
                                     F.col("first.place").alias("first_place")))
    firsts = stash.put(firsts)   # then AQE can split a digest that very many chunks have
    hit = (every.select("_row", "place", "digest").join(firsts, "digest").select("_row", "place", (
        (F.col("first_row") != F.col("_row")) | (F.col("first_place") != F.col("place"))).alias("again")))
    per = hit.groupBy("_row").agg(F.count("*").alias("n_shared"), F.array_sort(F.collect_list(
        F.struct("place", "again"))).alias("found"))

    def joined(found):
        """Runs of neighbouring chunks as [start, end, words]."""
        out = []
        for x in found:
            start, size, words = x["place"] >> 20, x["place"] >> 10 & 1023, x["place"] & 1023
            if out and start == out[-1][1]:
                out[-1] = [out[-1][0], start + size, out[-1][2] + words]
            else:
                out.append([start, start + size, words])
        return out

    def runs(batches):
        for pdf in batches:
            longest, spans, removed = [], [], []
            for found in pdf["found"]:
                longest.append(max(r[2] for r in joined(found)))
                out = [r for r in joined([x for x in found if x["again"]]) if r[2] >= min_words]
                spans.append(",".join(f"{r[0]}:{r[1]}" for r in out))
                removed.append(sum(r[1] - r[0] for r in out))
            yield pd.DataFrame({"_row": pdf["_row"], "n_shared": pdf["n_shared"], "shared_words": longest,
                                "n_removed": removed, "spans": spans})

    per = per.mapInPandas(runs, "_row bigint, n_shared bigint, shared_words bigint, n_removed bigint, spans string")
    total = every.groupBy("_row").agg(F.count("*").alias("n_chunks"))
    base = src.select("_row", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    zero = F.lit(0).cast("bigint")
    return base.join(total, "_row", "left").join(per, "_row", "left").select(
        "_row", "doc_id", "n_bytes", F.coalesce("n_chunks", zero).alias("n_chunks"),
        F.coalesce("n_shared", zero).alias("n_shared"), F.coalesce("shared_words", zero).alias("shared_words"),
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", **params) -> DataFrame:
    """``docs`` with the removed spans cut out of the text's bytes; bytes of a
    character that a cut splits are dropped with it."""
    found = repeats(docs, text=text, **params).where("n_removed > 0")
    row, cuts = fresh(docs, "_row"), fresh(docs, "_cuts")
    found = found.select(F.col("_row").alias(row), F.col("spans").alias(cuts))
    rows = with_row(docs, row).join(found, row, "left")
    schema = docs.schema
    cols = docs.columns

    def cut(batches):
        for pdf in batches:
            new = []
            for t, spans in zip(pdf[text], pdf[cuts]):
                if isinstance(spans, str) and spans:
                    data, last, out = t.encode(), 0, []
                    for s, e in (map(int, x.split(":")) for x in spans.split(",")):
                        out.append(data[last:s])
                        last = e
                    t = b"".join([*out, data[last:]]).decode("utf-8", "ignore")
                new.append(t)
            pdf[text] = new
            yield pdf[cols]

    changed = rows.where(F.col(cuts).isNotNull()).select(*cols, cuts).mapInPandas(cut, schema)
    return rows.where(F.col(cuts).isNull()).select(*cols).unionByName(changed)
