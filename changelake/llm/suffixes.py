"""Substring dedup over a logarithmic family of sparse suffix arrays.

Every byte that a ``length``-byte string covers is removed if that string also
starts anywhere else in the table. A full suffix array of the corpus would be
many times its size, so only some suffixes are kept, chosen by content: in every
window of ``length`` bytes the k-byte string with the least hash (the leftmost of
equals) is the window's anchor. Equal windows have their anchor at the same
place, so two windows can only be equal if the suffixes at their anchors begin
with the same k bytes (the ``head``). A suffix also carries the 128-bit digest of
all the bytes that the windows of its anchor span (``body``).

Suffixes arrive in batches. A batch's array is sorted by (head, body) with equal
entries counted; as long as the family's last level has about the same size, the
two are merged, so a family over n batches has about log n levels and a suffix
is rewritten as often. A merge scan of the levels gives

* bodies met twice: all their windows are repeated, whole;
* heads that are met elsewhere with another body: their bodies are compared.

For the latter the bytes are fetched and windows compared by two independent
64-bit hashes, next to one copy of every whole body with that head. Heads with
more than ``hot`` different bodies are compared by a shuffle on the window
instead, so that no task gets them all. The text itself is shuffled once.

Defined results: a null text counts as empty; texts under ``length`` bytes keep
all bytes; matches never cross documents; repeated rows are documents of their
own, so all bytes of both may go. Any id column, null ids included, is carried.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stash, slices, with_row

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def block_hashes(data: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of data[i:i + width] for every i, put
    together from blocks of a power of two."""
    h, w, power = data.astype(np.uint64) + np.uint64(1), 1, base
    out, done = None, 0  # the low bits of width first: they end the window
    n = len(data) - width + 1
    parts = []
    while w <= width:
        if width & w:
            parts.append((w, h, power))
        if w * 2 > width:
            break
        h = h[:-w] * np.uint64(power) + h[w:]
        power = power * power & 0xFFFFFFFFFFFFFFFF
        w *= 2
    for w, part, power in reversed(parts):
        piece = part[done:done + n]
        out = piece if out is None else out * np.uint64(power) + piece
        done += w
    return out


def anchors(data: np.ndarray, length: int, k: int):
    """(head, place, first window, last window) of each anchor of a text."""
    head = block_hashes(data, k, _BASES[0])
    order = ((head ^ (head >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    least = (order << np.uint64(32)) | np.arange(len(order), dtype=np.uint64)
    wide, w = length - k + 1, 1
    while w * 2 <= wide:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if w < wide:
        least = np.minimum(least[:len(least) - (wide - w)], least[wide - w:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    turn = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate(([0], turn))
    last = np.concatenate((turn, [len(place)])) - 1
    return head[place[first]].view(np.int64), place[first], first, last


_SUFFIX = "_row bigint, head bigint, body binary, place int, first int, last int"


def suffixes(docs: DataFrame, length: int, k: int) -> DataFrame:
    """The sampled suffixes of ``docs(_row, text)``, text as binary."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                found = []
                for row, data in zip(part.column("_row").to_pylist(), part.column("text").to_pylist()):
                    if data is None or len(data) < length:
                        continue
                    head, place, first, last = anchors(np.frombuffer(data, np.uint8), length, k)
                    body = [xxhash.xxh3_128_digest(data[f:t + length], p - f) for p, f, t in zip(
                        place.tolist(), first.tolist(), last.tolist())]
                    found.append((np.full(len(place), row), head, np.array(body, object), place, first, last))
                if found:
                    cols = [np.concatenate(c) for c in zip(*found)]
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, kinds)],
                        ["_row", "head", "body", "place", "first", "last"])

    return docs.select("_row", "text").mapInArrow(run, _SUFFIX)


class Family:
    """Levels of sorted suffix tables (head, body, n), merged geometrically."""

    def __init__(self, spark: SparkSession):
        self.stash = Stash(spark, "suffix-levels")
        self.levels: list[tuple[int, DataFrame]] = []

    def _store(self, df: DataFrame) -> tuple[int, DataFrame]:
        level = self.stash.put(df.sortWithinPartitions("head", "body"))
        return level.count(), level

    def add(self, batch: DataFrame) -> None:
        """Take in the suffixes of a batch; merge levels of about its size."""
        size, level = self._store(batch.groupBy("head", "body").agg(F.count("*").alias("n")))
        while self.levels and self.levels[-1][0] <= 1.5 * size:
            _, other = self.levels.pop()
            merged = self._store(level.unionByName(other).groupBy("head", "body").agg(F.sum("n").alias("n")))
            self.stash.drop(level, other)
            size, level = merged
        self.levels.append((size, level))

    def scan(self) -> DataFrame:
        """(head, body, n) over all levels."""
        out = self.levels[0][1]
        for _, level in self.levels[1:]:
            out = out.unionByName(level)
        if len(self.levels) > 1:
            out = out.groupBy("head", "body").agg(F.sum("n").alias("n"))
        return out


def _windows(pdf: pd.DataFrame, length: int):
    """Every window of the rows' bytes: (row index, window start in the text,
    offset of the anchor, two hashes that also cover head and offset)."""
    flat = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
    sizes = pdf["bytes"].str.len().to_numpy()
    begin = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    of = np.repeat(np.arange(len(pdf)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[of] + step
    offset = (pdf["place"] - pdf["first"]).to_numpy()[of] - step
    head = pdf["head"].to_numpy().view(np.uint64)[of]
    salt = (head ^ (offset.astype(np.uint64) * np.uint64(0x94D049BB133111EB))) * np.uint64(0xBF58476D1CE4E5B9)
    h1, h2 = (block_hashes(flat, length, b)[at] for b in _BASES)
    h1 = (h1 ^ (h1 >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + salt
    return of, pdf["first"].to_numpy()[of] + step, offset, h1, h2


def _spans(rows: np.ndarray, starts: np.ndarray, length: int) -> pd.DataFrame:
    """Joined spans of repeated windows, which come sorted by row and start."""
    if not len(rows):
        return pd.DataFrame({"_row": [], "s": [], "e": []}, dtype="int64")
    new = np.concatenate(([True], (np.diff(rows) != 0) | (np.diff(starts) > length)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(rows)])) - 1
    return pd.DataFrame({"_row": rows[first], "s": starts[first], "e": starts[last] + length})


def repeated_spans(docs: DataFrame, text_rows: DataFrame, length: int, k: int, batches: int, hot: int,
                   task_rows: int = 5000) -> DataFrame:
    """(_row, s, e): bytes covered by repeated strings, spans may overlap.

    ``text_rows(_row, doc_id, text)`` is the frame whose shuffle the caller
    shares with this one.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "suffixes")
    every = stash.put(suffixes(text_rows, length, k))
    # A head that is met once starts no repeated string: its suffix goes first.
    often = stash.put(every.groupBy("head").agg(F.count("*").alias("times")).where("times > 1").select("head"))
    some = stash.put(every.join(often, "head", "left_semi").select(*every.columns))
    stash.drop(every, often)
    family = Family(spark)
    for b in range(batches):
        family.add(some.where(F.pmod(F.xxhash64("_row"), F.lit(batches)) == b))
    array = family.scan()
    heads = (array.groupBy("head").agg(F.sum("n").alias("all"), F.count("*").alias("bodies"),
                                       F.count_if(F.col("n") == 1).alias("single"))
             .where("all > 1"))
    # A body is whole if met twice, open if its head has other bodies too.
    known = (array.join(heads, "head").select(
        "head", "body", (F.col("n") > 1).alias("whole"), (F.col("single") > 0).alias("wanted"),
        (F.col("bodies") > hot).alias("crowd")))
    place = stash.put(some.join(known, ["head", "body"]))
    stash.drop(some, *(level for _, level in family.levels))
    whole = place.where("whole").select("_row", F.col("first").cast("bigint").alias("s"),
                                        (F.col("last") + length).cast("bigint").alias("e"))
    one = (place.where("whole and wanted").groupBy("head", "body")
           .agg(F.min(F.struct("_row", "place", "first", "last", "crowd")).alias("x"))
           .select("head", "x.*", F.lit(False).alias("open")))
    need = place.where("not whole").select("head", "_row", "place", "first", "last", "crowd",
                                           F.lit(True).alias("open")).unionByName(one)
    need = need.groupBy("_row").agg(F.collect_list(F.struct(
        "head", "place", "first", "last", "crowd", "open")).alias("need"))

    def fetch(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                out = []
                for row, data, need in zip(part.column("_row").to_pylist(), part.column("text").to_pylist(),
                                           part.column("need").to_pylist()):
                    out += [{**x, "_row": row, "bytes": data[x["first"]:x["last"] + length]} for x in need]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("_row", pa.int64()), ("head", pa.int64()), ("place", pa.int32()), ("first", pa.int32()),
                    ("crowd", pa.bool_()), ("open", pa.bool_()), ("bytes", pa.binary())]))

    bodies = text_rows.join(need, "_row").mapInArrow(
        fetch, "_row bigint, head bigint, place int, first int, crowd boolean, open boolean, bytes binary")
    bodies = stash.put(bodies)
    tasks = max(1, math.ceil(bodies.count() / task_rows))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_row", "first"], ignore_index=True)
        of, start, _, h1, h2 = _windows(pdf, length)
        order = np.argsort(h1, kind="stable")
        a, b = h1[order], h2[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        twice = np.zeros(len(of), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= pdf["open"].to_numpy()[of]
        return _spans(pdf["_row"].to_numpy()[of[twice]], start[twice], length)

    calm = (bodies.where("not crowd").withColumn("task", F.pmod(F.xxhash64("head"), F.lit(tasks)))
            .groupBy("task").applyInPandas(compare, "_row bigint, s bigint, e bigint"))

    def spell(batches):
        for pdf in batches:
            for s in range(0, len(pdf), 2000):
                part = pdf.iloc[s:s + 2000].reset_index(drop=True)
                of, start, offset, h1, h2 = _windows(part, length)
                yield pd.DataFrame({"_row": part["_row"].to_numpy()[of], "s": start, "open": part["open"].to_numpy()[of],
                                    "h1": h1.view(np.int64), "h2": h2.view(np.int64)})

    spelt = bodies.where("crowd").mapInPandas(spell, "_row bigint, s bigint, open boolean, h1 bigint, h2 bigint")
    twice = spelt.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    crowd = spelt.where("open").join(twice, ["h1", "h2"]).select("_row", "s", (F.col("s") + length).alias("e"))
    return whole.unionByName(calm).unionByName(crowd)


def remove(docs: DataFrame, length: int = 200, k: int = 32, batches: int = 2, hot: int = 20_000,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: _row, doc_id, n_bytes, n_removed, n_spans, kept
    (the remaining bytes), kept_sha256. Drop what is not needed."""
    rows = with_row(docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("binary").alias("text")))
    rows = rows.select("_row", "doc_id", "text")
    found = repeated_spans(docs, rows, length, k, batches, hot)
    found = found.groupBy("_row").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = rows.join(found, "_row", "left")

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                cols = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "kept_sha256": []}
                for data, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    data, out, last, n = data or b"", [], 0, 0
                    end = -1
                    for x in sorted((x["s"], x["e"]) for x in spans or []):
                        if x[0] > end:
                            out.append(data[last:x[0]])
                            n += 1
                        end = max(end, x[1])
                        last = end
                    kept = b"".join([*out, data[last:]])
                    for name, v in zip(cols, (len(data), len(data) - len(kept), n, kept,
                                              hashlib.sha256(kept).hexdigest())):
                        cols[name].append(v)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"),
                     *(pa.array(v, t) for v, t in zip(cols.values(), kinds))],
                    ["_row", "doc_id", *cols])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("_row", "doc_id", "text", "spans").mapInArrow(
        cut, f"_row bigint, doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
             "kept binary, kept_sha256 string")
