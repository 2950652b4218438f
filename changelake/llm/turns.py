"""Conversation structure repair by depth-first branch and bound.

A conversation may be kept, re-roled, deleted and inserted into, row by row,
until its role initials read ``(s?(ua)+)?``. ``cheapest`` searches the edits of
one conversation depth first from an explicit stack. A node is (rows consumed,
last role); its prefix is (cost, audit). Prefixes are cut when

* another prefix of the same node is no worse in (cost, audit) -- equal cost at
  a node never makes one audit a prefix of the other, so order is kept by
  whatever follows;
* cost plus a lower bound of the rest exceeds the incumbent's cost, or equals it
  while the audit is already greater than the incumbent's. The bound adds each
  row's least own cost and 2 for every one of the most disjoint neighbours (the
  last role before, the rows that may stay, the end) that cannot stand together.

When the stack is empty the incumbent is optimal. Long conversations go through
in windows of ``WINDOW`` rows that hand on the best prefix of each last role, so
tables stay small; handing on is exact, as only the last role matters to the
rest.

In Spark, one shuffle brings a conversation's rows together in order (sorted by
Spark, spilling; duplicates are numbered by a window over the same partitioning),
a task streams them and keeps one byte a row, and the edits it finds travel with
the rows to a second pass that streams the repaired text into the digest. The
audit and the digest of a conversation are single values, so one task streams
one conversation, however long; texts are never held.

Defined results: a null role, text, id or turn reads as one space where text is
needed; null ids are one conversation; null turns come first. Rows with equal
turns are ordered by role, text and copy after damage. Repeated rows are repeats.
An empty table gives no rows. Longs that would overflow are the largest long.
Extra columns are never looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

BLANKS = " \t\n\v\f\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Last role of what has been put out: nothing, system, user, assistant.
START, S, U, A = range(4)
#: Initial -> (roles it may follow, role it gives).
_KEEP = {"s": ((START,), S), "u": ((START, S, A), U), "a": ((U,), A)}
_BEFORE_U = (START, S, A)
WINDOW = 32
_BIG = 1 << 40
_LONG_MAX = (1 << 63) - 1


def _bounds(codes: str) -> list[tuple[int, int, int, int]]:
    """For each row, and the end: least cost of the rest after each last role."""
    n = len(codes)
    #: matched[i]: most disjoint impossible neighbours among the rows from i on.
    stay = [c.lower() if c != "x" else None for c in codes]
    out = [(0, 2, 2, 0)] * (n + 1)
    own = 0
    nxt, first, second = None, 0, 0     # next row that may stay; pairs from it on; pairs after it
    for i in range(n - 1, -1, -1):
        c = stay[i]
        own += 3 if c is None else (2 if c == "o" else 0) + (codes[i].isupper())
        if c is not None:
            if c == "o":
                clash = 0               # its own cost is counted already
            elif nxt is None:
                clash = c != "a"        # the end asks for an assistant
            else:
                clash = nxt != "o" and c + nxt not in ("su", "ua", "au")
            first, second, nxt = max(first, second + clash), first, c
        row = []
        for state in range(4):
            if nxt is None:
                clash = state in (S, U)
            else:
                clash = nxt in _KEEP and state not in _KEEP[nxt][0]
            row.append(own + 2 * max(first, second + clash if nxt is not None else int(clash)))
        out[i] = tuple(row)
    return out


def _search(codes: str, entries: dict[int, tuple[int, str]], final: bool) -> dict[int, tuple[int, str]]:
    """Best (cost, audit) of each last role after ``codes``; with ``final`` of the
    best accepted one alone (under START or A)."""
    n = len(codes)
    bound = _bounds(codes) if final else [(b,) * 4 for b in _window_bounds(codes)]
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = []
    for state, prefix in entries.items():
        table[0, state] = prefix
        stack.append((prefix[0], prefix[1], 0, state))
    stack.sort(reverse=True)
    best: dict[int, tuple[int, str]] = {}
    limit, inc_audit = _BIG, ""
    while stack:
        cost, audit, i, state = stack.pop()
        if table[i, state] != (cost, audit):
            continue                                     # dominated since it was pushed
        least = cost + bound[i][state]
        if least > limit or final and least == limit and audit > inc_audit[:len(audit)]:
            continue
        if i == n:
            if not final:
                if state not in best or (cost, audit) < best[state]:
                    best[state] = (cost, audit)
                    # Any last role can be turned into an assistant for 4, and
                    # stands in for any other for 3 more.
                    limit = min(limit, cost + 7)
            elif state in (START, A):
                if (cost, audit) < (limit, inc_audit) or limit == _BIG:
                    best = {state: (cost, audit)}
                    limit, inc_audit = cost, audit
        steps = []
        if i < n:
            code = codes[i]
            steps.append((cost + 3, audit + "D", i + 1, state))
            if code != "x":
                late = int(code.isupper())
                keep = _KEEP.get(code.lower())
                if keep and state in keep[0]:
                    steps.append((cost + late, audit + "K", i + 1, keep[1]))
                steps.append((cost + 2 + late, audit + "R", i + 1, A if state == U else U))
        steps.append((cost + 2, audit + "I", i, A if state == U else U))
        ahead = []
        for step in steps:
            c, text, j, to = step
            seen = table.get((j, to))
            if seen is not None and seen <= (c, text):
                continue
            table[j, to] = (c, text)
            ahead.append((c + bound[j][to], text, step))
        # The most promising is taken next: it lies on top of the stack.
        ahead.sort(reverse=True)
        stack.extend(step for _, _, step in ahead)
    return best


def _window_bounds(codes: str) -> list[int]:
    """Least own costs alone, as the window's end accepts every role."""
    out = [0] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        c = codes[i]
        out[i] = out[i + 1] + (3 if c == "x" else (2 if c in "oO" else 0) + c.isupper())
    return out


def _cheapest(codes: str, window: int) -> tuple[int, str]:
    held = {START: (0, "")}
    done: list[tuple[int, str]] = []
    for a in range(0, max(len(codes), 1), window):
        final = a + window >= len(codes)
        held = _search(codes[a:a + window], held, final)
    return min(held.values())


@lru_cache(maxsize=1 << 16)
def _cheapest_short(codes: str, window: int) -> tuple[int, str]:
    return _cheapest(codes, window)


def cheapest(codes: str, window: int = WINDOW) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair; of equal costs the least audit.

    ``codes`` has a letter per row: initial s, u, a or o (any other), upper case
    if the row is truncated, x if it must go."""
    return (_cheapest_short if len(codes) <= 64 else _cheapest)(codes, window)


# ---- Spark --------------------------------------------------------------------

def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copy, alive) after the deterministic damage."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"),
                   F.coalesce(F.col(turn).cast("string"), space))
    d = F.col("d")
    role_, text_ = (F.coalesce(F.col(c).cast("string"), space) for c in (role, text))
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                                role_.alias("role"), text_.alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("d"))
    return rows.select(
        "conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(d == 1, "").when(d == 2, F.translate("text", ".!?", "")).when(d == 0, "").otherwise(F.col("text")).alias("text"),
        F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (d != 0).alias("alive"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` shuffled by conversation and sorted, with each row's first fault
    and its role's initial (o for any but s, u, a)."""
    end = F.rtrim("text", F.lit(BLANKS))
    nth = F.row_number().over(Window.partitionBy("conv_id", "alive", "role", "text")
                              .orderBy(F.col("turn").asc_nulls_first(), "copy"))
    first = F.substring("role", 1, 1)
    return (rows.repartition("conv_id").withColumn("nth", nth)
            .select("*", F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("initial"),
                    F.when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
                    .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK).alias("fault"))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(),
                                  "role", "text", "copy", "nth"))


class _Tally:
    """What is kept of one conversation while its rows stream by."""

    def __init__(self, conv):
        self.conv, self.rows = conv, 0
        self.codes, self.counts = [], [0, 0, 0, 0]
        self.illegal, self.turns, self.least, self.most, self.last = 0, 0, None, None, ""

    def add(self, initials: np.ndarray, faults: np.ndarray, turns: np.ndarray, known: np.ndarray) -> None:
        """One run of rows in order: bytes of initials, fault numbers, turns."""
        if not len(initials):
            return
        self.rows += len(initials)
        self.counts = [a + int(b) for a, b in zip(self.counts, np.bincount(faults, minlength=4))]
        codes = np.where(faults == TRUNCATED, initials - 32, initials)
        codes[(faults == BLANK) | (faults == DUPLICATE)] = ord("x")
        self.codes.append(codes.tobytes())
        line = self.last.encode() + initials.tobytes()
        pairs = np.frombuffer(line, np.uint8)
        two = pairs[:-1].astype(np.int32) << 8 | pairs[1:]
        legal = [ord(p[0]) << 8 | ord(p[1]) for p in ("su", "ua", "au")]
        self.illegal += int((~np.isin(two, legal)).sum())
        self.last = chr(initials[-1])
        t = turns[known]
        if len(t):
            fresh = np.r_[self.most is None or int(t[0]) != self.most, t[1:] != t[:-1]]
            self.turns += int(fresh.sum())
            self.least = int(t[0]) if self.least is None else self.least
            self.most = int(t[-1])

    def result(self) -> tuple:
        cost, audit = cheapest(b"".join(self.codes).decode())
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (min(gaps, _LONG_MAX), self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED],
                self.illegal, cost, audit)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _runs(batch: pa.RecordBatch):
    """(conversation, from, to) of neighbouring rows with one id."""
    ids = batch.column("conv_id").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.column("conv_id")[a].as_py(), a, b


def _edited(marked: DataFrame) -> DataFrame:
    """The rows as they are (numbered), and one row per conversation, number -1,
    with its counts and audit."""
    id_field = marked.schema["conv_id"]
    schema = StructType([id_field, StructField("no", LongType()), StructField("role", StringType()),
                         StructField("text", StringType()), *[StructField(c, LongType()) for c in _COUNTS],
                         StructField("audit", StringType())])
    names = [f.name for f in schema]

    def run(batches):
        tally, seen = None, False

        def closing():
            row = [tally.conv, -1, None, None, *tally.result()]
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]], id_type), pa.array([-1], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
                 *[pa.array([v], pa.int64()) for v in row[4:-1]], pa.array([row[-1]], pa.string())], names)

        for batch in batches:
            id_type = batch.column("conv_id").type
            alive = batch.column("alive").to_numpy(zero_copy_only=False)
            initials = np.frombuffer("".join(batch.column("initial").to_pylist()).encode(), np.uint8)
            fault = batch.column("fault").to_numpy(zero_copy_only=False)
            known = ~batch.column("turn").is_null().to_numpy(zero_copy_only=False)
            turns = batch.column("turn").fill_null(0).to_numpy(zero_copy_only=False)
            numbers = np.full(batch.num_rows, -1, np.int64)
            heads = []
            for conv, a, b in _runs(batch):
                if not seen or conv != tally.conv:
                    if seen:
                        heads.append(closing())
                    tally, seen = _Tally(conv), True
                live = np.arange(a, b)[alive[a:b]]
                numbers[live] = tally.rows + np.arange(len(live))
                tally.add(initials[live], fault[live], turns[live], known[live])
            at = pa.array(np.flatnonzero(numbers >= 0))
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(at), pa.array(numbers).take(at),
                 batch.column("role").take(at), batch.column("text").take(at), *[none] * len(_COUNTS),
                 pa.nulls(len(at), pa.string())], names)
            if heads:
                yield pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
        if seen:
            yield closing()

    return (marked.select("conv_id", "turn", "role", "text", "alive", "initial", "fault")
            .mapInArrow(run, schema))


class _Digest:
    """SHA-256 of a repaired conversation, fed edit by edit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.sha, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        if self.lines:
            self.sha.update(b"\n")
        self.sha.update(role.encode() + b":" + text.encode())
        self.lines += 1

    def _turn(self) -> str:
        self.state = A if self.state == U else U
        return "assistant" if self.state == A else "user"

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._line(self._turn(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
            self.state = _KEEP[role[0]][1]
        elif edit == "R":
            self._line(self._turn(), text)

    def result(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def repair(conversations: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256)."""
    edited = _edited(faults(damage(conversations) if damaged is None else damaged))
    ordered = edited.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "no")
    schema = StructType([edited.schema["conv_id"], *[StructField(c, LongType()) for c in _COUNTS],
                         StructField("audit", StringType()), StructField("repaired_sha256", StringType())])

    def run(batches):
        digest, head = None, None
        for batch in batches:
            done = []
            numbers = batch.column("no").to_numpy(zero_copy_only=False)
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            for i, no in enumerate(numbers.tolist()):
                if no < 0:
                    if head is not None:
                        done.append((head, digest.result()))
                    head = batch.slice(i, 1).select(["conv_id", *_COUNTS, "audit"])
                    digest = _Digest(batch.column("audit")[i].as_py())
                else:
                    digest.row(roles[i], texts[i])
            if done:
                yield _finished(done)
        if head is not None:
            yield _finished([(head, digest.result())])

    def _finished(done):
        table = pa.Table.from_batches([h for h, _ in done]).combine_chunks()
        return table.append_column("repaired_sha256", pa.array([d for _, d in done])).to_batches()[0]

    return ordered.mapInArrow(run, schema)
