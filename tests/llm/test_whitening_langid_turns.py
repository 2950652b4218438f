"""Whitening, language ID and conversation repair against brute force on small
tables with nulls, empty and long texts, ties, repeated rows, an empty table and
extra columns with clashing names."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changelake.llm import langid, queries, turns, whitening

# ---- whitening ----------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, n string, component int, whitened string, part string, ids int"


def _vectors(seed=2, n=300, dim=20):
    r = np.random.default_rng(seed)
    mix = r.standard_normal((dim, dim)) * 0.3
    v = (r.standard_normal((n, dim)) @ mix + 3).astype(np.float32)
    rows = [(i, [float(x) for x in v[i]]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(100)]                     # a hot vector
    rows += [rows[7], (None, rows[8][1])]
    odd = [None, [], [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    rows += [(1000 + i, x) for i, x in enumerate(odd)]
    rows += [(2000, [1.0, 2.0]), (2001, [5.0, 1.0]), (2002, [2.0, -4.0]), (2003, [0.5])]   # other lengths
    return [(a, b, "n", 1, "w", "p", 0) for a, b in rows]


def _brute_whiten(x, k=16):
    u = np.unique(x, axis=0)
    n, s = len(u), [sum(c) for c in u.T.tolist()]
    centred = lambda m: np.array([[(n * v - t) / n for v, t in zip(row, s)] for row in m.tolist()])
    c = centred(u)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    keep = [i for i in reversed(range(len(values))) if values[i] > len(values) * 2.0 ** -52 * values[-1]][:k]
    dev = [sum((n * v - t) ** 2 for v, t in zip(row, s)) for row in x.tolist()]
    return n, dev, centred(x) @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def _check(got, rows, dim):
    ids = [i for i, v in rows]
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(int) + 1_000_000
    n, dev, white, share = _brute_whiten(x)
    assert set(got["n"]) == {n}
    assert len(got) == len(rows) * white.shape[1]
    by_id = defaultdict(list)
    for r in got.itertuples():
        by_id[None if r.vec_id != r.vec_id else int(r.vec_id)].append(r)
    signs = None
    for i, d, w in zip(ids, dev, white):
        mine = sorted(by_id[i], key=lambda r: r.component)[::ids.count(i)]
        assert [r.component for r in mine] == list(range(1, len(w) + 1))
        assert {int(r.deviation) for r in mine} == {d}
        values = np.array([r.whitened for r in mine])
        if signs is None:
            signs = np.sign(values * w)
        assert np.allclose(values * signs, w, atol=1e-8)
        assert np.allclose([r.explained for r in mine], share, rtol=1e-6)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


@pytest.mark.parametrize("small", [False, True])
def test_whitening_equals_brute_force(spark, small):
    """Also in blocks of few rows, cut columns and several slabs."""
    rows = _vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    how = dict(block_bytes=1600, blocks_a_task=3, slab_blocks=8, columns=7) if small else {}
    got = whitening.whiten(df, **how).toPandas()
    usable = [(a, b) for a, b, *_ in rows if b and all(c is not None and np.isfinite(c) for c in b)]
    for dim in (20, 2):
        _check(got[got["dim"] == dim], [x for x in usable if len(x[1]) == dim], dim)
    assert not (got["dim"] == 1).any()      # a single vector has no spread


def test_whitening_edges(spark):
    none = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and "whitened" in none.columns
    same = [(i, [1.0, 2.0], "", 0, "", "", 0) for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, VECTORS)).count() == 0
    flat = [(i, [float(i), 2.0 * i], "", 0, "", "", 0) for i in range(6)]      # rank one
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, VECTORS)).collect()} == {1}


def test_deviation_is_exact_beyond_a_long():
    n = 3_000_000_001
    fit = whitening.Fit(3, n, (n * 1_000_000 + 17, n * 999_990 + n - 1, 5))
    x = np.array([[1_000_064, 999_000, 40], [1 << 53, -(1 << 53), 7]], np.int64)
    want = [sum((n * v - s) ** 2 for v, s in zip(row, fit.sums)) for row in x.tolist()]
    got = [fit.deviations(x[i:i + 1])[0].as_py() for i in range(2)]
    assert got[0] == want[0] and got[1] is None and want[1] >= 10 ** 38


def test_sums_hold_far_entries(spark):
    rows = [(i, [1e30, -1e30 + i, float(i)]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    (fit,) = whitening.sums(whitening.fit_list(df))
    assert fit.n == 4 and fit.sums[0] == 4 * (2 ** 53 + 1_000_000)


# ---- language ID ----------------------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, source string, _t string, lang_pred string, score string"


def _language_docs(seed=4, n=240):
    r = random.Random(seed)
    parts = {"xa": ["lo", "mi", "na", "ter", "ß"], "xb": ["wok", "dra", "kun", "zy"], "": ["éa", "ou", "que", "çi"]}
    rows = []
    for i in range(n):
        lang = r.choice(list(parts))
        text = " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4)))
                        for _ in range(r.randint(3, 40)))
        rows.append((i, text.title() if i % 3 else text + ". 42!", lang))
    rows += [(9001, None, "xa"), (9002, "", "xb"), (9003, " 12 — 34 !?", "xa"), (9004, "wok " * 30000, None),
             (None, "lo mi na", "xa"), rows[3], rows[3]]
    return [(*row, "s", "t", "l", "s") for row in rows]


def _grams(text, longest):
    words = re.sub(r"[\W\d_]+", " ", (text or "").lower()).lstrip(" ")
    words += " " if words and not words.endswith(" ") else ""
    return [words[i:i + n] for n in range(1, longest + 1) for i in range(len(words) - n + 1) if words[i:i + n] != " "]


def test_ngrams_come_once_in_pieces():
    texts = [r[1] for r in _language_docs()][:40] + ["", None, "é", "a1b", "A"]
    for piece in (7, 1000, 1 << 20):
        seen = defaultdict(list)
        for doc, slot in langid.ngrams(pa.array(texts), 30, 4, piece):
            for d, s in zip(doc.tolist(), slot.tolist()):
                seen[d].append(s)
        slot_of = {}
        for d, text in enumerate(texts):
            want = _grams(text, 4)
            assert len(seen[d]) == len(want)
            alone = [s for _, slot in langid.ngrams(pa.array([text]), 30, 4) for s in slot.tolist()]
            assert sorted(alone) == sorted(seen[d])
            slot_of.update({g: None for g in want})
        assert len({s for d in seen.values() for s in d}) == len(slot_of)     # no two n-grams meet at 30 bits


def test_langid_equals_brute_force(spark):
    rows = _language_docs()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    model = langid.train(docs, bits=26, entries=1 << 28)
    got = langid.predict(docs, model, keep=("doc_id", "text")).collect()
    train = [r for r in rows if r[0] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    langs = sorted({r[2] for r in train})
    counts = {v: defaultdict(int) for v in langs}
    for r in train:
        for g in _grams(r[1], 4):
            counts[r[2]][g] += 1
    totals = {v: sum(counts[v].values()) + 0.1 * 2 ** 26 for v in langs}
    assert model.langs == langs and len(got) == len(rows)
    for row in got:
        grams = _grams(row.text, 4)
        if not grams:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        ll = np.array([np.log(sum(r[2] == v for r in train) / len(train))
                       + sum(np.log((counts[v][g] + 0.1) / totals[v]) for g in grams) for v in langs])
        p = np.exp(ll - ll.max())
        assert row.lang_pred == langs[int(ll.argmax())]
        assert abs(row.score - p.max() / p.sum()) < 1e-3 and 0 <= row.score <= 1


def test_langid_edges(spark):
    none = spark.createDataFrame([], DOCS)
    assert langid.train(none) is None
    assert langid.predict(none, None).collect() == []
    unlabelled = spark.createDataFrame([(1, "words here", None, "", "", "", "")], DOCS)
    assert [(r.lang_pred, r.score) for r in langid.predict(unlabelled, langid.train(unlabelled)).collect()] == [("und", 0.0)]
    many = spark.range(40).selectExpr("id as doc_id", "'a b' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError):
        langid.train(many, max_langs=8)
    model = langid.train(many, max_langs=100, entries=1 << 10)
    assert model.log_p.size <= 1 << 10
    # All likelihoods are equal: the least language by code point.
    assert {r.lang_pred for r in langid.predict(many, model).collect()} == {model.langs[0]}


def test_langid_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op12_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null").collect()
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert got.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).count() == 0


# ---- conversation repair -----------------------------------------------------------

def _dijkstra(codes):
    best, heap = {}, [((0, ""), 0, 0)]
    while heap:
        (c, a), i, st = heapq.heappop(heap)
        if (i, st) in best:
            continue
        best[i, st] = (c, a)
        if i < len(codes):
            x = codes[i]
            heapq.heappush(heap, ((c + 3, a + "D"), i + 1, st))
            if x != "x":
                late = x.isupper()
                if (x.lower(), st) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    heapq.heappush(heap, ((c + late, a + "K"), i + 1, "?sua".index(x.lower())))
                heapq.heappush(heap, ((c + 2 + late, a + "R"), i + 1, 3 if st == 2 else 2))
        heapq.heappush(heap, ((c + 2, a + "I"), i, 3 if st == 2 else 2))
    return min(best[len(codes), s] for s in (0, 3) if (len(codes), s) in best)


def _exhaustive(codes):
    best = None

    def rec(i, roles, audit, cost, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 2:
            for r in "ua":
                rec(i, roles + r, audit + "I", cost + 2, inserted + 1)
        if i < len(codes):
            x = codes[i]
            rec(i + 1, roles, audit + "D", cost + 3, 0)
            if x != "x":
                rec(i + 1, roles + x.lower(), audit + "K", cost + x.isupper(), 0)
                for r in "ua":
                    rec(i + 1, roles + r, audit + "R", cost + 2 + x.isupper(), 0)
    rec(0, "", "", 0, 0)
    return best


def test_search_is_optimal_with_least_audit():
    r = random.Random(5)
    for _ in range(40):
        codes = "".join(r.choice("suaoSUAOxua") for _ in range(r.randint(0, 3)))
        assert turns.cheapest(codes) == _dijkstra(codes) == _exhaustive(codes), codes
    for _ in range(300):
        codes = "".join(r.choice("suaoSUAOxuaua") for _ in range(r.randint(0, 40)))
        want = _dijkstra(codes)
        assert turns.cheapest(codes) == want, codes
        for window in (1, 4, 9):
            assert turns.cheapest(codes, window) == want, (codes, window)
    long = "".join(r.choice("suaoSUAOx" + "ua" * 6) for _ in range(900))
    assert turns.cheapest(long) == _dijkstra(long)


def _brute_repair(rows):
    found = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        out = found[conv]
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        if d:
            out += [(turn is not None, turn or 0, role, text, copy) for copy in ((0, 1) if d == 3 else (0,))]
    result = {}
    for conv, lines in found.items():
        lines.sort()
        seen, codes, counts, initials = set(), "", [0, 0, 0, 0], []
        for _, _, role, text, _ in lines:
            end = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = 1 if not end else 2 if (role, text) in seen else 3 if end[0] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            initials.append(role[:1] if role[:1] in ("s", "u", "a") else "o")
            codes += "x" if fault in (1, 2) else initials[-1].upper() if fault == 3 else initials[-1]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = [t for has, t, *_ in lines if has]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = _dijkstra(codes)
        out, state, left = [], 0, iter(lines)
        for edit in audit:
            _, _, role, text, _ = (0, 0, "", "", 0) if edit == "I" else next(left)
            if edit == "K":
                state = "?sua".index(role[0])
                out.append(f"{role}:{text}")
            elif edit in "IR":
                state = 3 if state == 2 else 2
                out.append(("user:" if state == 2 else "assistant:") + text)
        result[conv] = (gaps, *counts[1:], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return result


TURNS = "conv_id bigint, turn bigint, role string, text string, d string, copy string, no int, alive string, nth int"


def _turn_rows():
    r = random.Random(6)
    rows = []
    for conv in range(120):
        n = r.choice([1, 2, 3, 5, 8, 70 if conv == 3 else 4])
        for turn in range(n):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", None])
            text = r.choice(["Yes.", "No!", "word", " \t", "", None, "é? \n", "same.", "x" * 50 + "."])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, 0, None]), role, text))
    rows += [(None, t, "user", "hi.") for t in range(4)] + [(None, None, None, None)]
    rows += rows[:6] + [(500, 3, "user", "t.")] * 40 + [(501, 0, "assistant", "word. " * 20000)]
    dropped = [c for c in range(600, 700) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows += [(c, 0, "user", "gone.") for c in dropped]
    return [(*x, "d", "c", 1, "a", 2) for x in rows]


def test_repair_equals_brute_force(spark):
    rows = _turn_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in turns.repair(df).collect()}
    want = _brute_repair(rows)
    assert got == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want.values()


def test_repair_of_small_batches_and_no_rows(spark):
    rows = _turn_rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.conv_id: tuple(r)[1:] for r in turns.repair(spark.createDataFrame(rows, TURNS)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute_repair(rows)
    assert turns.repair(spark.createDataFrame([], TURNS)).collect() == []


def test_repair_sql_equals_brute_force(tmp_path):
    """The SQL that the driver compares with, on rows with all the edge cases."""
    import duckdb
    import pyarrow.parquet as pq
    rows = [r[:4] for r in _turn_rows() if r[0] != 3 and len(r[3] or "") < 1000]   # SQL carries whole texts along
    columns = list(zip(*rows))
    pq.write_table(pa.table({n: pa.array(c, t) for n, c, t in zip(
        ("conv_id", "turn", "role", "text"), columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))}),
        str(tmp_path / "c.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/c.parquet'")
    got = {r[0]: r[1:] for r in con.sql(queries.ORACLE["op13_turns"]).fetchall()}
    assert got == _brute_repair(rows)


def test_repair_whole_table(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_turns(spark, "/root/testdata/sf0.01").collect()}
    assert got == _brute_repair(rows)
