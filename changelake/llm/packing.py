"""Best-fit packing of token sequences in bulk-synchronous rounds.

A document is its token ids and a closing id; longer ones are cut into full
pieces, which are sequences of their own. The remainders are packed in rounds.
Every round lays the unplaced pieces and the open gaps out by size, largest
first, and makes one distributed sweep: a gap adds one to a running height, a
piece takes one away, so the piece that brings the height down from h takes the
gap that brought it up to h -- the smallest free gap that holds it. Pieces that
want the same gap are thus told apart by their rank. The heights come from
counts per size (at most two numbers per length, which is all that the driver
gets to see) and ranks inside a size, so neither pieces nor gaps ever meet in
one task. A gap that would hold the longest unplaced piece several times is
offered as so many equal parts, so it takes several pieces a round. Matched gaps
shrink, and as many new sequences open as the pieces need at least: those longer
than every gap, and all of them beyond the room that is left. The next round
follows until all are placed; every round runs on Spark alike, whether many
pieces are left or few.

Pieces of at most ``crumb`` tokens come last, in one pass: laid end to end
along the gaps, each reduced by the longest crumb so that none crosses an end.

Defined results: a null or empty text is its closing id alone. Rows are told
apart by their place in the table, so repeated rows and null ids are packed one
by one. An empty table gives no rows.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import Stash, slices, with_row

#: Cached words per worker; beyond it the cache starts anew (same results).
CACHE_WORDS = 600_000
#: Closing punctuation is a pre-token of its own after a letter or digit. Signs
#: that occur in special tokens or contractions are not among these.
CLOSING = ".,!?;:#$%&*()\""


def _word_ids(path: str) -> "WordIds":
    """One cache per worker process. This module's own globals travel with each
    task, so the cache hangs on a module that stays."""
    import tokenizers
    held = tokenizers.__dict__.setdefault("_word_ids", {})
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def _parts(word: str) -> tuple[str, str]:
    """A word as stem and closing signs whose ids simply follow each other; a
    Latin stem in lower case, as the tokenizer's normalizer makes it."""
    if "<" in word:
        return word, ""
    stem = word.rstrip(CLOSING)
    if not stem or not (len(stem[-1].lower()) == 1 and stem[-1].lower().isalnum()):
        stem = word
    return (stem.lower() if _latin(stem) else stem), word[len(stem):]


def _latin(stem: str) -> bool:
    """Letters that have one lower-case letter each, whatever stands beside them."""
    return stem.isascii() or max(stem) < "\u0250" and "\u0130" not in stem


class WordIds:
    """Token ids of whole texts, word by word.

    This tokenizer's pre-tokenizer splits at white space and drops it, so a
    text's ids are its words' ids in a row; each distinct word is encoded once
    and looked up afterwards.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt: dict[int, str] = {}   # letters as the model's byte-level alphabet has them
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {"": 0}
        self.ends = np.zeros(2, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self.clear()
        new = list({w: 0 for w in words if w not in self.index})
        if new:
            ids = self._encode(new)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(lens)))
            self.ids = np.concatenate((self.ids, np.fromiter((i for x in ids for i in x), np.int32)))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words. A run of Latin letters, normal and in lower
        case, is one pre-token and goes to the model directly."""
        out, other = [[] for _ in words], []
        for k, w in enumerate(words):
            if not w.isalpha() or not _latin(w):
                other.append(k)
                continue
            if not w.isascii():
                if not unicodedata.is_normalized("NFC", w):
                    other.append(k)
                    continue
                for c in w:
                    if c > "\x7f" and ord(c) not in self.spelt:
                        self.spelt[ord(c)] = self.byte_level.pre_tokenize_str(c)[0][0]
                w = w.translate(self.spelt)
            out[k] = [t.id for t in self.model.tokenize(w)]
        for s in range(0, len(other), 4096):
            part = other[s:s + 4096]
            for k, e in zip(part, self.tok.encode_batch_fast([words[k] for k in part], add_special_tokens=False)):
                out[k] = e.ids
        return out

    def encode(self, texts: pa.Array, words_at_once: int = 400_000):
        """The ids of each text, one array after the other."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        parts = [p for w in words.dictionary.to_pylist() for p in _parts(w)]
        number = self._numbers(parts).reshape(-1, 2)
        indices = words.indices.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + words_at_once, side="right")) - 1)
            part = number[indices[offsets[first]:offsets[last]]].ravel()
            start, count = self.ends[part], self.ends[part + 1] - self.ends[part]
            ends = np.cumsum(count)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)
            cut = np.concatenate(([0], ends))[2 * (offsets[first + 1:last + 1] - offsets[first])]
            yield from np.split(self.ids[at], cut[:-1])
            first = last


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_row, doc_id, piece, start, length, ids_crc32) of every document."""

    def run(batches):
        tok = _word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", 16 << 20):
                rows, nth, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(tok.encode(part.column("text"))):
                    ids = np.append(ids, closing).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        cut = ids[s:s + capacity]
                        rows.append(k)
                        nth.append(p)
                        start.append(s)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                take = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row").take(take), part.column("doc_id").take(take),
                     pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["_row", "doc_id", "piece", "start", "length", "ids_crc32"])

    src = with_row(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.select("_row", "doc_id", "text").mapInArrow(
        run, f"_row bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def _sub(key: str, subs: int):
    """Hash part of an id; a length of very many pieces is ranked in parts."""
    return F.pmod(F.xxhash64(key), F.lit(subs))


def _counts(state: DataFrame, subs: int) -> tuple[Counter, Counter]:
    """Gaps and pieces of ``state(kind, id, size)`` per (size, hash part): of a
    table of any size at most two rows per length and part."""
    per = state.groupBy("kind", "size", _sub("id", subs).alias("sub")).agg(F.count("*").alias("n")).collect()
    return tuple(Counter({(r["size"], r["sub"]): r["n"] for r in per if r["kind"] == kind}) for kind in (0, 1))


def _table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few longs per length and hash part, for a broadcast join."""
    names = columns.split()
    return F.broadcast(spark.createDataFrame(pa.table(
        [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[] for _ in names])], names)))


def _heights(rooms: Counter, lengths: Counter, most: int) -> list[tuple[int, int, int, int, int]]:
    """(size, kind, sub, nth, height): the order of the sweep and the height
    before each part. Gaps come before pieces of the same size."""
    line = Counter()
    for (room, sub), n in rooms.items():
        parts = max(1, room // most)
        line[-(room // parts), 0, sub] += n * parts
    for (length, sub), n in lengths.items():
        line[-length, 1, sub] += n
    out, height = [], 0
    for nth, (size, kind, sub) in enumerate(sorted(line), 1):
        out.append((-size, kind, sub, nth, height))
        height = max(0, height + (-1 if kind else 1) * line[size, kind, sub])
    return out


def _sweep(line: DataFrame, heights: DataFrame, most: int, subs: int) -> DataFrame:
    """One round over the gaps (kind 0) and pieces (kind 1) of ``line(kind, id,
    size, fresh)``: rows (item, length, seq, room, before, used, nth, fresh) with
    nulls where a side found no partner. ``used`` is what the round puts into the
    sequence, ``before`` the part of it that stands before the item; ``fresh`` says
    that the round opened the sequence."""
    gap = F.col("kind") == 0
    parts = F.when(gap, F.greatest(F.lit(1), F.floor(F.col("size") / most))).otherwise(F.lit(1)).cast("int")
    line = line.select("kind", "id", F.floor(F.col("size") / parts).alias("size"), _sub("id", subs).alias("sub"),
                       F.when(gap, F.col("size")).alias("room"), "fresh",
                       F.explode(F.array_repeat(F.lit(0), parts))).drop("col")
    rank = F.row_number().over(Window.partitionBy("size", "kind", "sub").orderBy("id"))
    line = line.withColumn("rank", rank).join(heights, ["size", "kind", "sub"])
    line = line.withColumn("level", F.when(gap, F.col("height") + F.col("rank"))
                           .otherwise(F.col("height") - F.col("rank") + 1))
    # A piece that finds the stack empty is below all gaps and stays alone.
    by = Window.partitionBy("level").orderBy("nth")
    lost = F.col("level") < 1
    line = line.withColumn("next", F.when(gap & (F.lead("kind").over(by) == 1),
                                          F.struct(F.lead("id").over(by).alias("item"),
                                                   F.lead("size").over(by).alias("length"))))
    line = line.where(gap | lost).select(
        "kind", "id", "room", "fresh", F.when(lost, F.col("id")).otherwise(F.col("next.item")).alias("item"),
        F.when(lost, F.col("size")).otherwise(F.col("next.length")).alias("length"))
    # A sequence has at most capacity / least parts.
    inside = Window.partitionBy("id", "kind").orderBy("item")
    length = F.coalesce("length", F.lit(0))
    return line.select(
        "item", "length", F.when(gap, F.col("id")).alias("seq"), "room",
        F.when(gap, F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - length).alias("before"),
        F.when(gap, F.sum(length).over(Window.partitionBy("id", "kind"))).alias("used"),
        F.when(gap, F.row_number().over(inside)).alias("nth"), "fresh")


def pack(items: DataFrame, capacity: int = 2048, crumb: int = 16, part_rows: int = 20_000_000) -> DataFrame:
    """(item, seq, offset) for ``items(item, length)``, item a unique long.

    A sequence is named after the item that opened it. The driver keeps counts
    per length and hash part; a round is one count and one stored sweep, and the
    places are read from the sweeps of all rounds at once.
    """
    stash = Stash(items.sparkSession, "packing")
    zero = F.lit(0).cast("bigint")
    alone = F.col("length") * 2 > capacity  # no two of these share a sequence
    subs = max(1, math.ceil(items.count() / part_rows))
    state = items.select(F.when(alone, 0).otherwise(1).alias("kind"), F.col("item").alias("id"),
                         F.when(alone, F.lit(capacity) - F.col("length")).otherwise(F.col("length")).alias("size"),
                         alone.alias("fresh"))
    rooms, lengths = _counts(state, subs)
    crumbs = Counter({k: n for k, n in lengths.items() if k[0] <= crumb})
    state, lengths = state.where((F.col("kind") == 0) | (F.col("size") > crumb)), lengths - crumbs
    swept, bounds, shut = f"{stash.root}/sweeps", [], Counter()
    while lengths:
        least, most, widest = min(lengths)[0], max(lengths)[0], max(rooms, default=(0,))[0]
        if bounds:  # gaps too small for every piece left; new ones are swept once, so all are stored
            bounds[-1] = least
            state = state.where((F.col("kind") == 1) | (F.col("size") >= least))
            small = Counter({k: n for k, n in rooms.items() if k[0] < least})
            rooms, shut = rooms - small, shut + small
        need = _total(lengths) - sum(room * n for (room, _), n in rooms.items() if room >= least)
        if widest < most:
            need = max(need, sum(length * n for (length, _), n in lengths.items() if length > widest))
        line = state
        if need > 0:
            opens, opened = _longest(state, lengths, math.ceil(need / capacity), subs)
            line = state.select(F.when(opens, 0).otherwise(F.col("kind")).alias("kind"), "id",
                                F.when(opens, F.lit(capacity) - F.col("size")).otherwise(F.col("size")).alias("size"),
                                (F.col("fresh") | opens).alias("fresh"))
            lengths = lengths - opened
            for (length, sub), n in opened.items():
                rooms[capacity - length, sub] += n
        heights = _table(stash.spark, _heights(rooms, lengths, most), "size kind sub nth height")
        done = stash.put(_sweep(line, heights, most, subs), at=f"sweeps/round={len(bounds)}")
        bounds.append(capacity + 1)
        piece = F.col("seq").isNull()
        state = done.where(piece | (F.col("nth") == 1)).select(
            piece.cast("int").alias("kind"), F.coalesce("seq", "item").alias("id"),
            F.when(piece, F.col("length")).otherwise(F.col("room") - F.col("used")).alias("size"),
            F.lit(False).alias("fresh"))
        rooms, lengths = _counts(state, subs)
    if bounds:
        # One scan over the sweeps of all rounds, so the plan does not grow with them.
        schema = StructType([*done.schema, StructField("round", IntegerType())])
        every = stash.spark.read.schema(schema).parquet(swept).where("seq is not null")
        new = F.when(F.col("fresh") & (F.col("nth") == 1),
                     F.struct(F.col("seq").alias("item"), "seq", zero.alias("offset")))
        hit = F.when(F.col("item").isNotNull(), F.struct("item", "seq", (
            F.lit(capacity) - F.col("room") + F.col("before")).alias("offset")))
        placed = [every.select(F.explode(F.array_compact(F.array(new, hit))).alias("p")).select("p.*")]
        left = F.col("room") - F.col("used")
        gaps = every.where((F.col("nth") == 1) & (left < F.get(F.array(*map(F.lit, bounds)), F.col("round"))))
        gaps = gaps.select("seq", left.alias("room"))
    else:
        placed = [items.where(alone).select("item", F.col("item").alias("seq"), zero.alias("offset"))]
        gaps = state.where("kind = 0").select(F.col("id").alias("seq"), F.col("size").alias("room"))
    if crumbs:
        placed.append(_crumbs(stash, items.where(F.col("length") <= crumb), crumbs, gaps, rooms + shut,
                              capacity, subs))
    return _union(placed)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _total(counts: Counter) -> int:
    return sum(size * n for (size, _), n in counts.items())


def _longest(state: DataFrame, lengths: Counter, count: int, subs: int) -> tuple[Column, Counter]:
    """The ``count`` longest pieces, as a condition on ``state`` and their counts:
    whole lengths, and of the last length whole hash parts and the least ids of
    one more. Only that part is ranked, and one id comes to the driver."""
    opened = Counter()
    for (size, sub), n in sorted(lengths.items(), key=lambda x: (-x[0][0], x[0][1])):
        opened[size, sub] = min(n, count)
        count -= opened[size, sub]
        if not count:
            break
    length, part = F.col("size"), _sub("id", subs)
    inside = (F.col("kind") == 1) & (length == size) & (part == sub)
    opens = (length > size) | (length == size) & (part < sub)
    if opened[size, sub] < n:
        rank = F.row_number().over(Window.partitionBy("size").orderBy("id"))
        edge = state.where(inside).select("size", "id").withColumn("rank", rank)
        last = edge.where(F.col("rank") == opened[size, sub]).first()["id"]
        inside &= F.col("id") <= last
    return (F.col("kind") == 1) & (opens | inside), opened


def _crumbs(stash: Stash, crumbs: DataFrame, sizes: Counter, gaps: DataFrame, rooms: Counter,
            capacity: int, subs: int) -> DataFrame:
    """Lay short pieces end to end along the gaps, widest gaps first."""
    longest = max(sizes)[0]
    spans = Counter({k: n for k, n in rooms.items() if k[0] > longest})
    missing = _total(sizes) - sum((room - longest + 1) * n for (room, _), n in spans.items())
    # New sequences stand first, named by negative numbers that no item has.
    more, whole = max(0, math.ceil(missing / (capacity - longest + 1))), capacity - longest + 1
    span = (F.col("room") - longest + 1).alias("span")
    free = _running(gaps.where(F.col("room") > longest).select("seq", "room", span), "seq", "span", "room",
                    spans, 1 - longest, more * whole, subs)
    if more:
        free = free.unionByName(stash.spark.range(1, more + 1).select(
            (-F.col("id")).alias("seq"), F.lit(capacity).cast("bigint").alias("room"),
            F.lit(whole).cast("bigint").alias("span"), ((F.col("id") - 1) * whole).alias("at")))
    items = _running(crumbs.select("item", "length"), "item", "length", "length", sizes, 0, 0, subs)
    # The gap whose span holds a crumb's start: one range-partitioned sort of
    # gaps and crumbs by start; the nearest gap before each crumb is carried
    # along inside a block of ``width`` tokens, into which gaps are repeated.
    width = max(capacity * 64, 1)
    gap_rows = free.select(F.explode(F.sequence(F.floor(F.col("at") / width),
                                                F.floor((F.col("at") + F.col("span") - 1) / width))).alias("blk"),
                           F.col("at").alias("pos"), F.lit(0).alias("kind"), "seq", "room",
                           F.lit(None).cast("bigint").alias("item"))
    item_rows = items.select(F.floor(F.col("at") / width).alias("blk"), F.col("at").alias("pos"),
                             F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("seq"),
                             F.lit(None).cast("bigint").alias("room"), "item")
    by = Window.partitionBy("blk").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    got = gap_rows.unionByName(item_rows)
    got = (got.withColumn("g", F.last(F.when(F.col("kind") == 0, F.struct("seq", "room", "pos")), True).over(by))
           .where("kind = 1"))
    first = F.min("pos").over(Window.partitionBy("g.seq"))
    return stash.put(got.select("item", F.col("g.seq").alias("seq"),
                                (F.lit(capacity) - F.col("g.room") + F.col("pos") - first).alias("offset")))


def _running(df: DataFrame, key: str, size: str, cls: str, counts: Counter, less: int, start: int,
             subs: int) -> DataFrame:
    """``at``: ``start`` and the sum of ``size`` (``cls`` and ``less``) over the
    rows before, by falling ``cls``, hash part and key."""
    rows = []
    for (c, sub), n in sorted(counts.items(), key=lambda x: (-x[0][0], x[0][1])):
        rows.append((c, sub, start))
        start += (c + less) * n
    inner = F.sum(size).over(Window.partitionBy(cls, "sub").orderBy(key)
                             .rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)
    df = df.withColumn("sub", _sub(key, subs)).withColumn("inner", inner)
    df = df.join(_table(df.sparkSession, rows, f"{cls} sub start"), [cls, "sub"])
    return df.withColumn("at", F.col("start") + F.col("inner")).drop("sub", "inner", "start")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, **params) -> DataFrame:
    """Pieces with sequence_id and offset; columns as named in ``pieces``."""
    spark = docs.sparkSession
    cut = Stash(spark, "pieces").put(pieces(docs, tokenizer, capacity, **params)
                                     .withColumn("item", F.monotonically_increasing_id()))
    full = cut.where(F.col("length") == capacity).select(
        *cut.columns, F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = cut.where(F.col("length") < capacity)
    at = pack(rest.select("item", "length"), capacity)
    rest = rest.join(at.withColumnRenamed("seq", "sequence_id"), "item")
    out = full.unionByName(rest.select(*full.columns))
    return out.select("_row", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
