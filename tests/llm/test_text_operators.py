"""SimHash, PII, mixing, toxicity, chunking, packing and suffix dedup against
brute force on small tables with nulls, empty and long texts, ties, repeated
rows, an empty table and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from changelake.llm import chunking, mixing, packing, pii, queries, simhash, suffixes, toxicity
from changelake.llm.common import with_row

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, "
          "score string, spans string, copies int, fp string, key string")


def _texts(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 120))) for _ in range(n)]
    near = [t + " tail" for t in base[:8]] + [t.upper() for t in base[:4]]
    shared = " ".join(r.choice(vocabulary) for _ in range(90))
    base[10] += "\n" + shared
    base[20] = shared + " end " + base[20] + " " + shared
    return base + near + base[:5] + ["", None, " \t\n", "a", "x" * 5000, "one two three"]


def _docs(spark, texts=None, empty=False):
    texts = _texts() if texts is None else texts
    r = random.Random(3)
    rows = [(i, t, "en", r.choice(["s1", "s1", "s1", "s2", "s3", None]), None, "r", "s", "p", 9, "f", "k")
            for i, t in enumerate(texts)]
    rows += [rows[min(3, len(rows) - 1)], (None, "lost words here", None, None, None, None, None, None, None, None, None),
             (None, None, None, "s2", None, None, None, None, None, None, None)]
    return spark.createDataFrame([] if empty else rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Stored, as the operators number the rows of stored tables."""
    path = str(tmp_path_factory.mktemp("docs") / "t")
    _docs(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    _docs(spark, empty=True).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


# ---- SimHash -----------------------------------------------------------------

def _fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def _groups(fps, linked):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if linked(fps[i], fps[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_groups_equal_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [_fp(t) for _, t in rows]
    root = _groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(list)
    for (i, _), g in zip(rows, root):
        if i is not None:
            least[g].append(i)
    want = Counter((i, f"{f:016x}", min(least[g], default=None)) for (i, _), f, g in zip(rows, fps, root))
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fp().alias("f"), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root))


def test_pigeonring_finds_every_pair_and_splits_hot_groups(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(500)}
    for f in list(fps)[:200]:
        g = f
        for b in r.sample(range(64), r.randint(1, 5)):
            g ^= 1 << b
        fps.add(g)
    centre = r.getrandbits(64)                              # a hot cluster around one value
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    fps = sorted(fps)
    want = _groups_fast(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for rows in (100_000, 300):                             # whole groups, and groups in blocks
        edges = simhash.link_edges(frame, 4, task_rows=rows).collect()
        assert _close(signed, edges) == want


def _groups_fast(fps):
    a = np.array(fps, dtype=np.uint64)
    pairs = [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 4) + i + 1]
    return _merge(len(a), pairs)


def _close(signed, edges):
    at = {f: i for i, f in enumerate(signed)}
    return _merge(len(signed), [(at[e.a], at[e.b]) for e in edges])


def _merge(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).columns == none.columns


# ---- PII ---------------------------------------------------------------------

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum(v - 9 if v > 9 else v for v in (int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def _base(text):
    found = [(m.start(), no, m.end(), k) for no, (k, rx) in enumerate(KINDS.items())
             for m in re.finditer(rx, text or "") if _valid(k, m.group())]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def _pii_texts():
    r = random.Random(9)
    alphabet = list("ab.@+-_% ()0123456789\né😀") + ["a@b.co", "4111 1111 1111 1111", "+1 202-555-0143",
                                                    "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "a@b.co_x@c.de"]
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(300)]
    # zorro stands next to one address only, in different lines; the is common
    out += [f"the mail of zorro {i} is z@mask.org" for i in range(4)] + ["the the the", "Zorro rode", "the end"] * 5
    out += ["zorro left z@mask.org", "the zebra zone zoom"] + [None, "", "x" * 3000 + "@", "1" * 3000, "a@b" + ".c" * 3000]
    return out


@pytest.fixture(scope="module")
def personal(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pii") / "t")
    _docs(spark, _pii_texts()).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_base_spans_equal_brute_force(spark, personal, monkeypatch):
    monkeypatch.setattr(queries, "_table", lambda *_: personal)
    got = queries.op4_pii(spark, "").collect()
    text = Counter((r.doc_id, r.text) for r in personal.select("doc_id", "text").collect())
    want = Counter()
    for (i, t), n in text.items():
        b = _base(t)
        want[(i, *[sum(x[0] == k for x in b) for k in KINDS],
              hashlib.sha256(",".join("%s:%d:%d" % x for x in b).encode()).hexdigest())] += n
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    for r in got:                                           # base spans stay among all spans
        assert r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added == len([s for s in r.spans.split(",") if s])


def _disclosing(texts, alpha=0.9, support=3):
    lines = [(d, k, ln) for d, t in enumerate(texts) for k, ln in enumerate((t or "").split("\n"))]
    words = [set(re.findall(r"[^\W_]{3,}", ln.lower())) for _, _, ln in lines]
    ents = []
    for (d, k, ln) in lines:
        ents.append({f"{kind}:{re.sub('[^0-9]', '', ln[s:e]) if kind in ('card', 'phone') else ln[s:e].lower()}"
                     for kind, s, e in _base(ln)})
    n_t, n_c, n_ct, seen = Counter(), Counter(), Counter(), defaultdict(set)
    for (_, _, ln), ws, es in zip(lines, words, ents):
        n_t.update(ws)
        n_c.update(es)
        for e in es:
            for w in ws:
                n_ct[e, w] += 1
                seen[e, w].add(ln)
    n = len(lines)
    return {(e, w) for (e, w), c in n_ct.items() if len(seen[e, w]) >= support and n_c[e] < n
            and math.log(c * n / (n_c[e] * n_t[w])) >= alpha * math.log(n / n_c[e])}


def test_disclosing_terms_equal_brute_force_and_are_cleared(personal):
    rows = personal.select("text").collect()
    want = _disclosing([r.text for r in rows])
    assert ("email:z@mask.org", "zorro") not in want        # zorro also rides alone
    spans = pii._spans_of(personal, "doc_id", "text")
    each = spans.where(F.size("spans") > 0).select("_row", F.explode("lines").alias("l"), "spans").select(
        "_row", F.col("l.at").alias("at"), F.col("l.line").alias("line"),
        F.explode(F.array_distinct(F.transform(F.filter("spans", lambda s: (s["start"] >= F.col("l.at")) & (
            s["end"] <= F.col("l.at") + F.char_length("l.line"))), pii._entity))).alias("entity"))
    got = {(r.entity, r.term) for r in pii.disclosing(personal, each, 0.9, 3).collect()}
    assert got == want and ("email:z@mask.org", "mask") in got
    out = pii.sanitise(personal)
    assert out.columns == personal.columns and out.count() == personal.count()
    for r in out.collect():
        assert not _base(r.text) or "[" in r.text           # marks can meet digits beside them
    assert out.where("text like '%z@mask.org%'").count() == 0
    assert out.where("text is null").count() == personal.where("text is null").count()
    untouched = personal.where("text = 'the the the'").count()
    assert out.where("text = 'the the the'").count() == untouched


def test_a_term_seen_only_with_an_entity_is_added(spark, tmp_path):
    texts = [f"pad {w}" for w in ("alpha", "beta", "gamma", "delta", "other", "wordy")] * 20
    texts += [f"call quixote{'' if i else ','} now {i} at q@x.org" for i in range(5)]
    path = str(tmp_path / "t")
    _docs(spark, texts).write.parquet(path)
    found = pii.find(spark.read.parquet(path)).where("doc_id >= 120")
    for r in found.collect():
        words = {texts[r.doc_id][s.start:s.end].lower() for s in r.added}
        assert "quixote" in words and all(s.value in ("", "qui*", "now*", "cal*") for s in r.added)
    assert pii.find(spark.read.parquet(path)).where("doc_id < 120 and size(added) > 0").count() == 0


def test_pii_empty_table(none):
    assert pii.find(none).count() == 0 and pii.sanitise(none).columns == none.columns


# ---- mixing ------------------------------------------------------------------

def test_mixing_meets_targets_and_reruns_agree(docs):
    got = mixing.plan(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.plan(docs).collect()), key=str)
    size = Counter()
    for r in got:
        size[r.source] += r["size"]
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    share, level = 1.5 * sum(size.values()), {}
    free = set(order)
    while free:
        lam = (share - sum(2 * size[s] for s in order if s not in free)) / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * lam >= 2 * size[s]}
        if not full:
            break
        free -= full
    for s in order:
        level[s] = weight[s] * lam if s in free else 2.0 * size[s]
    taken, smallest = Counter(), defaultdict(lambda: 10 ** 9)
    for r in got:
        assert r["size"] == len(WORD.findall("" if r.doc_id is None and r["size"] == 0 else _text_of(docs, r)))
        assert r.source_size == size[r.source] and r.target == pytest.approx(level[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
        if r.taken < 2 * r["size"]:
            smallest[r.source] = min(smallest[r.source], r["size"])
    for s in order:                                         # no document that fits the gap was left out
        gap = level[s] - taken[s]
        assert gap > -1e-6 and (gap < smallest[s] or gap < max(r["size"] for r in got if r.source == s))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


_by_row = {}


def _text_of(docs, r):
    if not _by_row:
        _by_row.update({x._n: x.text or "" for x in with_row(docs, "_n").select("_n", "text").collect()})
    return _by_row[r._row]


def test_rows_keep_their_numbers_however_files_are_split(spark, tmp_path):
    """Numbers stored at one parallelism fit a read at another, so spans and cuts
    found at one find their documents at the other."""
    path = str(tmp_path / "t")
    _docs(spark, _texts(seed=8, n=150)).repartition(5).write.option("parquet.block.size", 4096).parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("128m", "3k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            docs = spark.read.parquet(path)
            numbered = with_row(docs, "n")
            rows = {(r.n, r.doc_id, r.text) for r in numbered.collect()}
            assert len({r[0] for r in rows}) == docs.count()
            spans = {tuple(r) for r in chunking.repeats(docs).select("_row", "spans").collect()}
            cuts = {tuple(r) for r in suffixes.remove(docs).select("_row", "doc_id", "kept_sha256").collect()}
            kept = sorted(r.doc_id for r in simhash.keep_one(docs).where("doc_id is not null").collect())
            clean = sorted((r.doc_id or -1, r.text or "") for r in pii.sanitise(docs).collect())
            mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
            seen.append((docs.rdd.getNumPartitions(), rows, spans, cuts, kept, clean, mixed))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0][0] < seen[1][0] and seen[0][1:] == seen[1][1:]


def test_mixing_empty_and_wordless_tables(spark, none, tmp_path):
    assert mixing.plan(none).count() == 0
    path = str(tmp_path / "t")
    _docs(spark, ["", None, " "]).where("coalesce(trim(text), '') = ''").write.parquet(path)
    got = mixing.plan(spark.read.parquet(path)).collect()
    assert got and all(r.taken == 0 and r.target == 0 for r in got)


# ---- toxicity ----------------------------------------------------------------

def test_toxicity_learns_words_and_ignores_held_out_labels(spark, docs, none):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    texts = []
    for i in range(600):
        words = [r.choice(vocabulary) for _ in range(r.randint(5, 60))]
        if i % 5 == 0:
            words.insert(r.randrange(len(words)), r.choice(["Vile!", "vile", "VILE,"]))
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    fold = [zlib.crc32(str(i).encode()) % 5 for i in range(600)]
    labels = [(i, int(i % 5 == 0)) for i in range(600) if fold[i]]
    labels += [(i, 1 - int(i % 5 == 0)) for i in range(600) if not fold[i]] + [(None, 1), (7, None)]
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    weights = toxicity.train(frame, labels)
    got = {x.doc_id: x for x in toxicity.score(frame, weights).select(
        "doc_id", "score", toxicity.held_out().alias("h")).collect()}
    assert all(got[i].h == (fold[i] == 0) for i in got)
    right = [(got[i].score >= 0.5) == (i % 5 == 0) for i in got if got[i].h]
    assert np.mean(right) > 0.97
    # labels of the held-out fold do not change the weights
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(weights, toxicity.train(frame, flipped))
    scored = toxicity.score(docs, weights, name="_s")
    assert scored.columns == [*docs.columns, "_s"] and scored.where("_s between 0 and 1").count() == docs.count()
    assert toxicity.score(none, weights, keep=("doc_id",)).count() == 0
    no = labels.where("false")
    assert toxicity.train(frame, no) is None
    assert toxicity.score(frame, None, keep=("doc_id",)).agg(F.max("score")).first()[0] == 0


def test_toxicity_keeps_its_coordinates_and_averages_in_blocks(spark):
    frame = spark.createDataFrame([(i, f"{'vile' if i % 3 == 0 else 'fine'} word{i % 50}") for i in range(300)],
                                  "doc_id bigint, text string")
    labels = frame.select("doc_id", F.col("text").startswith("vile").cast("int").alias("toxic"))
    assert len(toxicity.train(frame, labels, rounds=1)) == (1 << 20) + 1
    few = [toxicity.train(frame, labels, bits=8, rounds=2, blocks=b) for b in (1, 7)]
    assert np.array_equal(*few) and np.count_nonzero(few[0])


# ---- chunking ----------------------------------------------------------------

def _gear_cuts(data, mask_bits=5, least=32, most=512):
    gear = chunking.gear_table().tolist()
    ends, last, h = [], 0, 0
    for i, b in enumerate(data):
        h = ((h << 1) + gear[b]) & 0xFFFFFFFF
        if i + 1 - last == most or (i + 1 - last >= least and h >> (32 - mask_bits) == 0):
            ends.append(i + 1)
            last = i + 1
    return ends if last == len(data) else [*ends, len(data)]


def test_chunk_cuts_equal_the_rolling_hash():
    for t in _texts():
        data = (t or "").encode()
        assert chunking.cut_points(data, chunking.gear_table(), 5, 32, 512) == _gear_cuts(data)


def test_repeats_equal_brute_force(docs, none):
    rows = with_row(docs, "n").select("n", "doc_id", "text").collect()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n))
    seen, count, per = set(), Counter(), []
    for r in rows:
        data, last, out = (r.text or "").encode(), 0, []
        for e in _gear_cuts(data):
            out.append((last, e, data[last:e]))
            count[data[last:e]] += 1
            last = e
        per.append((r, data, out))
    want = []
    for r, data, out in per:
        again, spans, longest, run = [], [], 0, 0
        for s, e, c in out:
            again.append(c in seen)
            seen.add(c)
            run = run + len(c.split()) if count[c] > 1 else 0
            longest = max(longest, run)
        k = 0
        while k < len(out):
            j = k
            while j < len(out) and again[j]:
                j += 1
            if j > k and sum(len(c.split()) for _, _, c in out[k:j]) >= 25:
                spans.append((out[k][0], out[j - 1][1]))
            k = max(j, k + 1)
        want.append((r.n, r.doc_id, len(data), len(out), sum(count[c] > 1 for _, _, c in out), longest,
                     sum(e - s for s, e in spans), ",".join(f"{s}:{e}" for s, e in spans)))
    got = chunking.repeats(docs).collect()
    assert Counter(map(tuple, got)) == Counter(want) and any(w[6] for w in want)
    out = chunking.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert chunking.repeats(none).count() == 0 and chunking.remove_repeats(none).count() == 0


# ---- packing -----------------------------------------------------------------

def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    path = queries.tokenizer_path()
    r = random.Random(4)
    signs = list("abAB'sStT.,!?<|> \n\té12$#\"()İΣ́") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "\x0b", "\x00", "\u00a0",
                                       "É", "ñ", "ß", "ẞ", "ſ", "Ǆ", "ŉ", "ª", "ö", "Ω", "東"]
    texts = _texts() + ["".join(r.choice(signs) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    want = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    ids = packing.WordIds(path)
    for at_once in (400_000, 50):
        assert [x.tolist() for x in ids.encode(pa.array(texts), at_once)] == [e.ids for e in want]


# Sizes just above a third of a sequence are the hard case: which three fit
# depends on a few tokens, and sequences that open together differ little.
@pytest.mark.parametrize("seed,low,high,slack", [(0, 1, 2047, 1.01), (1, 1, 60, 1.01), (2, 65, 200, 1.02),
                                                 (3, 680, 690, 1.05)])
def test_packing_is_gapless_and_close_to_best(spark, seed, low, high, slack):
    r = random.Random(seed)
    lengths = [r.randint(low, high) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint").repartition(3)
    got = packing.pack(frame).collect()
    by = defaultdict(list)
    for x in got:
        by[x.seq].append((x.offset, lengths[x.item]))
    assert sorted(x.item for x in got) == list(range(3000))
    for rows in by.values():
        end = 0
        for offset, n in sorted(rows):
            assert offset == end
            end += n
        assert end <= 2048
    bins = []                                               # best fit, longest first
    for n in sorted(lengths, reverse=True):
        k = min((b for b in range(len(bins)) if bins[b] >= n), key=lambda b: bins[b], default=None)
        if k is None:
            bins.append(2048 - n)
        else:
            bins[k] -= n
    assert len(by) <= len(bins) * slack + 2


def test_packing_rounds_are_few_jobs(spark):
    """Plans and jobs of the rounds fill the driver's memory: one count and one
    sweep each (38 jobs; 95 when every round also stored what it opened)."""
    r = random.Random(4)
    frame = spark.createDataFrame([(i, r.randint(100, 103)) for i in range(3000)], "item bigint, length bigint")
    sc = spark.sparkContext
    sc.setJobGroup("packing-rounds", "packing rounds")
    try:
        got = packing.pack(frame.repartition(3)).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len({x.item for x in got}) == len(got) == 3000 and len({x.seq for x in got}) <= 153
    assert len(sc.statusTracker().getJobIdsForGroup("packing-rounds")) <= 60


def test_packing_result_scans_all_rounds_at_once(spark):
    """A scan for every round, each with its own broadcast and tasks, fills the
    driver's memory where tables have many partitions."""
    r = random.Random(8)
    lengths = [r.choice((r.randint(1, 40), r.randint(41, 700), r.randint(701, 2000))) for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint")
    got = packing.pack(frame)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 3
    by = {}
    for x in got.collect():
        by.setdefault(x.seq, []).append((x.offset, lengths[x.item]))
    assert sum(map(len, by.values())) == 2000
    for rows in by.values():
        at = sorted(rows)
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 2048


def test_packing_splits_a_length_by_hash_parts(spark):
    frame = spark.createDataFrame([(i, n) for i, n in enumerate([700] * 900 + [5] * 400)], "item bigint, length bigint")
    ends, counts = {}, Counter()
    for x in packing.pack(frame.repartition(3), part_rows=100).collect():
        counts[x.item] += 1
        ends.setdefault(x.seq, []).append((x.offset, 700 if x.item < 900 else 5))
    assert len(counts) == 1300 and set(counts.values()) == {1} and len(ends) == 450
    for rows in ends.values():
        at = sorted(rows)
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 2048


def test_pieces_rebuild_every_document(spark, docs, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path())
    got = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    rows = with_row(docs, "n").select("n", "doc_id", "text").collect()
    by = defaultdict(list)
    for x in got:
        by[x._row].append(x)
    assert set(by) == {r.n for r in rows}
    for r in rows:
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, x in enumerate(sorted(by[r.n], key=lambda x: x.piece)):
            part = ids[x.start:x.start + x.length]
            assert (x.doc_id, x.piece, x.start, x.ids_crc32) == (r.doc_id, k, 2048 * k, zlib.crc32(part.tobytes()))
        assert sum(x.length for x in by[r.n]) == len(ids)
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0


# ---- suffix dedup ------------------------------------------------------------

def _removed(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                hit[i:i + length] = True
        out.append(hit)
    return out


@pytest.mark.parametrize("batches,hot", [(1, 20_000), (2, 20_000), (3, 2)])
def test_suffix_dedup_equals_brute_force(spark, docs, none, batches, hot):
    rows = with_row(docs, "n").select("n", "doc_id", "text").collect()
    texts = [(r.text or "").encode() for r in rows]
    want = []
    for r, t, hit in zip(rows, texts, _removed(texts, 200)):
        kept = bytes(np.frombuffer(t, np.uint8)[~hit])
        runs = int((np.diff(np.concatenate(([0], hit.astype(int)))) == 1).sum())
        want.append((r.n, r.doc_id, len(t), int(hit.sum()), runs, kept, hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove(docs, batches=batches, hot=hot).collect()
    assert Counter((*r[:5], bytes(r.kept), r.kept_sha256) for r in got) == Counter(want)
    assert any(0 < w[3] < w[2] for w in want)
    assert suffixes.remove(none).count() == 0


def test_suffix_dedup_in_shuffled_copies(spark, tmp_path):
    r = random.Random(8)
    source = "".join(r.choice("abcd ") for _ in range(3000))
    texts = [source[a:a + r.randint(150, 700)] + "".join(r.choice("xyz") for _ in range(r.randint(0, 90)))
             + source[b:b + r.randint(0, 500)] for a, b in ((r.randrange(2500), r.randrange(2500)) for _ in range(40))]
    texts += ["z" * 1000, "ab" * 400]                       # repeats inside one text
    path = str(tmp_path / "t")
    _docs(spark, texts).where("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(path)
    got = {x.doc_id: x.n_removed for x in suffixes.remove(spark.read.parquet(path), hot=3).collect()}
    want = {i: int(h.sum()) for i, h in enumerate(_removed([t.encode() for t in texts], 200))}
    assert got == want


def test_bodies_that_share_32_bits_of_a_digest_stay(spark):
    """Two one-window texts with one head whose 64-bit digests agree in their upper half."""
    length, k, rng = 64, 16, np.random.default_rng(2)
    pool = rng.integers(97, 123, (200_000, k), dtype=np.uint8)
    h = suffixes.block_hashes(pool.reshape(-1), k, suffixes._BASES[0])[::k]
    order = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    head = pool[np.argmin(order)].tobytes()
    seen = {}
    for rest in rng.integers(97, 123, (600_000, length - k), dtype=np.uint8):
        text = head + rest.tobytes()
        other = seen.setdefault(xxhash.xxh3_64_intdigest(text) >> 32, text)
        if other != text:
            break
    assert other != text
    one, two = (suffixes.anchors(np.frombuffer(t, np.uint8), length, k) for t in (other, text))
    assert one[0] == two[0] and one[1] == two[1] == [0]
    docs = spark.createDataFrame([(0, other.decode()), (1, text.decode()), (2, "q" + text.decode())],
                                 "doc_id int, text string")
    got = {x.doc_id: x.n_removed for x in suffixes.remove(docs, length, k).collect()}
    assert got == {0: 0, 1: length, 2: length}


def test_levels_merge_geometrically(spark):
    family = suffixes.Family(spark)
    for b in range(5):
        family.add(spark.range(1000).select((F.col("id") + b * 1000).alias("head"), F.lit(1).alias("body")))
    assert [size for size, _ in family.levels] == [4000, 1000]
    assert family.scan().count() == 5000
