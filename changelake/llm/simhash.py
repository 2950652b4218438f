"""SimHash near-duplicates with pigeonring candidate filtering.

A text's fingerprint has 64 bits: bit i is set if more than half of its
shingles' XXH64 values have bit i set. Two fingerprints within ``max_bits``
differing bits link; groups are the connected components.

The bits are cut into ``max_bits + 1`` segments on a ring. If two fingerprints
differ in at most t of the bits, some segment starts a chain whose first l
segments differ in at most floor(l * t / (t + 1)) = l - 1 bits together, for
every l. So the first segment is equal, the first two differ in at most one
bit, and so on: candidates share the first segment, are met by sending each
fingerprint to the places of its second segment with no or one bit flipped,
must pass the budget of every further prefix of the chain, and only then the
full Hamming check.

Defined results: a null text counts as empty; a text without words has the
fingerprint zero and links like any other; one with fewer words than a shingle
has one shingle. Null doc_ids are allowed (a group of only null ids has a null
component_id). Repeated rows get equal results, one row each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, connected, expand_ranges, fresh, slices, union_labels, with_row

_BIT_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
_BYTE_BASE = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text. ``bytes.lower`` and ``bytes.split`` treat
    exactly A-Z and the six ASCII white-space characters."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(joined[s:e], seed)
                  for s, e in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _BYTE_BASE).ravel(), minlength=2048).reshape(8, 256)
    ones = counts @ _BIT_OF
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, seed: int = 42,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., fp): the fingerprint of every row as a signed long."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_t"):
                fps = np.fromiter((fingerprint(t or b"", shingle, seed)
                                   for t in part.column("_t").to_pylist()), np.uint64, part.num_rows)
                cols = [part.column(k) for k in keep] + [pa.array(fps.view(np.int64))]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "fp"])

    src = docs.select(*keep, F.col(text).cast("binary").alias("_t"))
    fields = ", ".join(f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keep)
    return src.mapInArrow(run, f"{fields}, fp bigint")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments, highest bits first."""
    m = max_bits + 1
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    shifts = [64 - sum(widths[:i + 1]) for i in range(m)]
    return list(zip(shifts, widths))


def near_links(fp: np.ndarray, seg: np.ndarray, flip: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of the rows and their group labels (least index).

    A row asks for one place: the chain that starts at segment ``seg``, with bit
    ``flip`` of the second segment turned (-1: none, the fingerprint's own
    place). Rows of one place are compared unless both only visit it. Candidate
    pairs come in chunks, so memory is bounded by the rows and the chunk, not
    by the pairs.
    """
    segs = _segments(max_bits)
    m = len(segs)
    one = np.uint64(1)
    every, of = np.unique(fp, return_inverse=True)
    labels = np.arange(len(every))
    for first in range(m):
        mine = np.flatnonzero(seg == first)
        ring = [segs[(first + k) % m] for k in range(m)]
        part = [(every >> np.uint64(s)) & ((one << np.uint64(w)) - one) if w < 64 else every for s, w in ring]
        head = part[0][of[mine]]
        visits = flip[mine] >= 0
        if m > 1:
            turned = np.where(visits, one << np.maximum(flip[mine], 0).astype(np.uint64), np.uint64(0))
            head = (head << np.uint64(ring[1][1])) | (part[1][of[mine]] ^ turned)
        order = np.lexsort((visits, head))   # own places before visits
        head, visits, at = head[order], visits[order], of[mine][order]
        hi = np.where(visits, 0, np.searchsorted(head, head, side="right"))
        for i, j in expand_ranges(np.arange(1, len(head) + 1), hi):
            i, j = at[i], at[j]
            apart = labels[i] != labels[j]
            i, j = i[apart], j[apart]
            spent = np.zeros(len(i), dtype=np.int64)
            for length in range(2, m + 1):
                spent = spent + np.bitwise_count(part[length - 1][i] ^ part[length - 1][j])
                ok = spent <= length * max_bits // m
                i, j, spent = i[ok], j[ok], spent[ok]
            ok = np.bitwise_count(every[i] ^ every[j]) <= max_bits
            union_labels(labels, i[ok], j[ok])
    return every, labels


def _places(max_bits: int):
    """The places a fingerprint stands at, as an array of (seg, flip, head): its
    own of every segment, and those with one zero bit of the second segment
    turned to one (so of two neighbours only one visits the other)."""
    segs = _segments(max_bits)
    m = len(segs)
    places = []
    for i, (s, w) in enumerate(segs):
        own = F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1) if w < 64 else F.col("fp")
        flips = [-1]
        if m > 1:
            s2, w2 = segs[(i + 1) % m]
            second = F.shiftrightunsigned("fp", s2).bitwiseAND((1 << w2) - 1)
            own = F.shiftleft(own, w2).bitwiseOR(second)
            flips += range(w2)
        for k in flips:
            place = F.struct(F.lit(i).cast("tinyint").alias("seg"), F.lit(k).cast("tinyint").alias("flip"),
                             (own if k < 0 else own.bitwiseOR(F.lit(1 << k))).cast("bigint").alias("head"))
            places.append(place if k < 0 else F.when(F.shiftright(own, k).bitwiseAND(1) == 0, place))
    return F.array_compact(F.array(*places))


def link_edges(distinct: DataFrame, max_bits: int = 4, task_rows: int = 100_000) -> DataFrame:
    """(a, b) edges that connect every pair of distinct fingerprints within
    ``max_bits``: per bin only a spanning star of each of its components.

    A fingerprint is sent to its place in each segment's order, the first two
    segments together, and to the places one bit away: at most one copy a bit of
    a segment and one more, whatever the size of the table. Places are hashed to
    bins of some ``task_rows / 2`` rows; a bin over ``task_rows`` is compared in
    pairs of blocks, so no task gets a hot place whole.
    """
    rows = distinct.select("fp", F.explode(_places(max_bits)).alias("k")).select("fp", "k.*")
    segs = _segments(max_bits)
    n = distinct.count() * sum(1 + (w + 1) // 2 for _, w in segs)
    bins = max(1, math.ceil(2 * n / task_rows))
    rows = rows.select("fp", "seg", "flip", F.pmod(F.xxhash64("seg", "head"), F.lit(bins)).alias("bin"))
    sizes = rows.groupBy("bin").agg(F.ceil(F.count("*") / task_rows).cast("int").alias("nb")).where("nb > 1")
    rows = rows.join(Stash(distinct.sparkSession, "simhash-bins").put(sizes), "bin", "left")
    nb = F.coalesce("nb", F.lit(1))
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("fp"), nb).cast("int"))
    rows = rows.withColumn("oth", F.explode(F.sequence(F.lit(0), nb - 1)))
    rows = rows.select("fp", "seg", "flip", "bin", F.least("blk", "oth").alias("p"),
                       F.greatest("blk", "oth").alias("q"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, labels = near_links(pdf["fp"].to_numpy().view(np.uint64), pdf["seg"].to_numpy(),
                                pdf["flip"].to_numpy(), max_bits)
        child = np.flatnonzero(labels != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": signed[child], "b": signed[labels[child]]})

    return rows.groupBy("bin", "p", "q").applyInPandas(link, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: _row, id, fp (signed), root (a fingerprint of the
    group), component_id (smallest id of the group)."""
    spark = docs.sparkSession
    stash = Stash(spark, "simhash")
    src = with_row(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    fps = stash.put(fingerprints(src, shingle=shingle, seed=seed, keep=("_row", "doc_id")))
    reps = stash.put(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    groups = connected(spark, link_edges(reps.select("fp"), max_bits), "simhash-groups")
    named = (reps.join(groups, reps.fp == groups.node, "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least_id"))
    named = stash.put(named)
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "root", "component_id")
    return fps.join(by_fp, "fp").select("_row", "doc_id", "fp", "root", "component_id")


def hex_fp(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents of which one per group stays: the least id, and of rows
    with that same id the first. Columns as in ``docs``."""
    found = near_duplicates(docs, **params)
    winners = (found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("w")).select("w._row"))
    row = fresh(docs, "_row")
    return with_row(docs, row).join(winners.withColumnRenamed("_row", row), row, "left_semi").select(*docs.columns)
