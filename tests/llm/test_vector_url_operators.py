"""RaBitQ links, Hilbert search and the URL filter against brute force."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from changelake.llm import hilbert, rabitq, urls
from changelake.llm.common import connected

SCHEMA = "vec_id bigint, embedding array<float>, label int, _row int, rank string, dim string, vec string"


def _vectors(seed=1, n=400, dim=24):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((12, dim))
    v = np.concatenate([r.standard_normal((n // 2, dim)),
                        centres[r.integers(0, 12, n // 2)] + 0.1 * r.standard_normal((n // 2, dim))])
    rows = [(i, [float(np.float32(x)) for x in v[i]], int(i % 3), 1, "r", "d", "v") for i in range(n)]
    rows += [(n + i, rows[-1 - i % 5][1], rows[-1 - i % 5][2], 1, "r", "d", "v") for i in range(20)]  # equal vectors
    odd = [[0.0] * dim, None, [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1), []]
    rows += [(1000 + i, x, 0, None, None, None, None) for i, x in enumerate(odd)]
    rows += [(2000, rows[0][1], None, 0, "", "", ""), (2001, [1.0, 2.0], 0, 0, "", "", ""), (2002, [1.0, 2.0], 0, 0, "", "", "")]
    rows += [rows[7], (None, rows[8][1], rows[8][2], 0, "", "", "")]
    return rows


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vec") / "t")
    spark.createDataFrame(_vectors(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_vectors(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("novec") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def _clean(x):
    if not x or any(c is None or not math.isfinite(c) for c in x) or not any(x):
        return None
    return np.array(x, dtype=float)


def _brute_links(rows):
    vs = [_clean(x[1]) for x in rows]
    n = len(rows)
    deg, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if rows[i][2] is None or rows[i][2] != rows[j][2] or vs[i] is None or vs[j] is None or len(vs[i]) != len(vs[j]):
                continue
            if vs[i] @ vs[j] / math.sqrt((vs[i] @ vs[i]) * (vs[j] @ vs[j])) >= 0.98 - 1e-15:
                deg[i] += 1
                deg[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)].append(rows[i][0])
    comp = [min(least[find(i)], default=None) if deg[i] else rows[i][0] for i in range(n)]
    return Counter((rows[i][0], deg[i], comp[i], rows[i][0] is not None and rows[i][0] == comp[i]) for i in range(n))


def test_link_sql_equals_brute_force(tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq
    from changelake.llm.queries import ORACLE
    rows = [r for r in {r[0]: r for r in _vectors() if r[0] is not None}.values()]    # ids name rows in SQL
    pq.write_table(pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                             "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                             "label": pa.array([r[2] for r in rows], pa.int32())}), str(tmp_path / "e.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/e.parquet'")
    assert Counter(con.sql(ORACLE["op2_rabitq"]).fetchall()) == _brute_links(rows)


def test_links_equal_brute_force(vectors, no_vectors):
    want = _brute_links(_vectors())
    assert Counter(map(tuple, rabitq.links(vectors).collect())) == want
    # hot buckets in blocks, several tasks
    assert Counter(map(tuple, rabitq.links(vectors, block=7, task_rows=50).collect())) == want
    assert rabitq.links(no_vectors).count() == 0


def test_tasks_stay_bounded_on_a_cluster_of_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(4)
    near = rng.normal(size=16) + rng.normal(size=(400, 16)) * 0.005
    frame = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(near)],
                                  "vec_id bigint, label int, embedding array<double>")
    apply, rows = GroupedData.applyInPandas, []

    def counted(self, *args):
        rows.append(self._df.groupBy("task").count().agg(F.max("count")).first()[0])
        return apply(self, *args)

    monkeypatch.setattr(GroupedData, "applyInPandas", counted)
    got = rabitq.links(frame, block=20, task_rows=200).collect()
    assert {x.n_links for x in got} == {399} and {x.component_id for x in got} == {0}
    assert rows and max(rows) <= 4 * 200


def test_two_blocks_of_near_copies_fit_in_memory():
    rng = np.random.default_rng(5)
    near = rng.normal(size=64) + rng.normal(size=(1000, 64)) * 0.005
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    tracemalloc.start()
    i, _ = rabitq.close_pairs(near, near, 0.98, 5.0, 11)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 1000 * 1000 and peak < 200 << 20


def test_estimates_are_unbiased_and_bounds_hold():
    r = np.random.default_rng(3)
    dim, errors = 64, []
    v = r.standard_normal((200, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for seed in range(20):
        from changelake.llm.vectors import rotation
        t = v @ rotation(dim, seed).T
        code = np.where(t > 0, 1, -1) / math.sqrt(dim)
        f = np.abs(t).sum(1) / math.sqrt(dim)
        est = (code @ t.T) / f[:, None]
        err = est - v @ v.T
        bound = 5 / math.sqrt(dim - 1) * np.sqrt(1 - f * f) / f
        assert (np.abs(err) <= bound[:, None] + 1e-9).all()
        errors.append(err)
    assert abs(np.mean(errors)) < 0.003


def test_search_recall_and_exact_distances(spark, vectors, no_vectors):
    rows = _vectors()
    vs = [_clean(x[1]) for x in rows]
    got = defaultdict(list)
    for x in hilbert.search(vectors, F.col("vec_id") % 20 == 0, probe=30, block=64, query_rows=16).collect():
        got[x.query_id].append((x["rank"], x.vec_id, x.score))
    hits = total = 0
    for i, row in enumerate(rows):
        if row[0] is None or row[0] % 20 or vs[i] is None:
            continue
        cand = sorted((float(np.sqrt(((vs[j] - vs[i]) ** 2).sum())), rows[j][0]) for j in range(len(rows))
                      if j != i and vs[j] is not None and len(vs[j]) == len(vs[i]) and rows[j][0] is not None)[:10]
        mine = sorted(got[row[0]])
        assert [m[0] for m in mine] == list(range(1, len(cand) + 1))
        assert [m[2] for m in mine] == sorted(m[2] for m in mine)
        true = {v: d for d, v in cand}
        hits += sum(m[1] in true for m in mine)
        total += len(cand)
        for _, v, d in mine:
            if v in true:
                assert d == pytest.approx(true[v], rel=1e-12, abs=1e-12)
    assert hits / total >= 0.9
    assert hilbert.search(no_vectors, F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_keys_visit_neighbours():
    import itertools
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hilbert.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_components_of_chains_and_stars(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(500)] + [(5, 5), (9000, 9001)]
    r.shuffle(edges)
    got = {x.node: x.root for x in connected(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[2000 + i] == 1000 for i in range(500))
    assert got[9001] == 9000 and len(got) == 301 + 501 + 2


# ---- urls --------------------------------------------------------------------

def _url_rows():
    r = random.Random(6)
    hosts = ["a.example.net", "shop.example.com", "news.org", "x.net", "net", "internet", "example.net", "ftp.example.com"]
    paths = ["/en/1", "/fr/2?x=/", "/de/3#t", "", "/", "/en", "?q=/en/", "#/en/", "/EN/4"]
    out = [f"{r.choice(['http', 'HTTPS'])}://{r.choice(hosts)}{r.choice(paths)}" for _ in range(300)]
    return out + [None, "", "no scheme", "http://", "a://b://c/en/", "://example.net/en/", "http://WWW.Example.NET/en/x",
                  "http://é.org/fr/", "http://" + "long." * 2000 + "org/fr/" + "p" * 3000]


def _host_path(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u[u.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def _scores(texts, order=4):
    """(text -> score) by the model's definition; texts: {text: (allowed, blocked, learn)}."""
    count = [defaultdict(Counter), defaultdict(Counter)]
    for t, (a, b, learn) in texts.items():
        p = "^" * order + t
        for i in range(len(t)):
            for k in range(order + 1):
                tail = p[i + order - k:i + order + 1]
                for c, flag in enumerate((a, b)):
                    if learn and flag:
                        count[c][tail[:-1]][tail[-1]] += 1
    out = {}
    ready = all(any(x[c] and x[2] for x in texts.values()) for c in (0, 1))
    for t in texts:
        p, total = "^" * order + t, 0.0
        for i in range(len(t) if ready else 0):
            prob = [1 / 256, 1 / 256]
            for k in range(order + 1):
                tail = p[i + order - k:i + order + 1]
                if not any(c[tail[:-1]][tail[-1]] for c in count):
                    continue
                for c in (0, 1):
                    n, kinds = sum(count[c][tail[:-1]].values()), sum(v > 0 for v in count[c][tail[:-1]].values())
                    if n:
                        prob[c] = (count[c][tail[:-1]][tail[-1]] + kinds * prob[c]) / (n + kinds)
            total += math.log(prob[0]) - math.log(prob[1])
        out[t] = total / len(t) if t else 0.0
    return out


def test_url_filter_equals_brute_force(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, u, "h", "r", "t") for i, u in enumerate(_url_rows())]
    rows += [rows[0], (None, "http://news.org/fr/9", "h", "r", "t")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, rule string, text string").write.parquet(path)
    got = urls.judge(spark.read.parquet(path)).collect()
    learn = {}
    for x in got:
        t = x.host + x.path
        a, b = (x.rule is not None and x.verdict == v for v in ("allow", "block"))
        old = learn.get(t, (False, False))
        learn[t] = (old[0] or a, old[1] or b)
    fold = {r.text: r.f != 0 for r in spark.createDataFrame([(t,) for t in learn], "text string").select(
        "text", F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(5)).alias("f")).collect()}
    score = _scores({t: (*learn[t], fold[t]) for t in learn})
    assert len(got) == len(rows) and len({x.cut for x in got}) == 1
    for x in got:
        u = rows[0][1] if x.page_id == 0 else ("http://news.org/fr/9" if x.page_id is None else rows[x.page_id][1])
        h, p = _host_path(u)
        fits = [(len(rh + rp), rh + rp, v) for v, rh, rp in urls.RULES
                if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        assert (x.host, x.path, x.rule) == (h, p, max(fits)[1] if fits else None)
        assert x.score == pytest.approx(score[h + p], abs=1e-9)
        assert x.verdict == (max(fits)[2] if fits else "allow" if x.score >= x.cut else "block")


def test_models_agree_with_the_rules_on_left_out_texts(spark):
    got = urls.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    t = urls.model_text(F.col("host"), F.col("path"))
    left_out = got.where(F.col("rule").isNotNull()).where(F.pmod(F.xxhash64(F.lit(3), t), F.lit(5)) == 0)
    right = left_out.select(((F.col("score") >= F.col("cut")) == (F.col("verdict") == "allow")).cast("int").alias("x"))
    assert right.agg(F.avg("x")).first()[0] > 0.9


def test_url_filter_without_rows_or_classes(spark, tmp_path):
    schema = "page_id bigint, url string"
    for k, rows in enumerate(([], [(1, "http://plain.com/x"), (2, None)], [(1, "http://x.net/a"), (2, "http://plain.com/")])):
        path = str(tmp_path / str(k))
        spark.createDataFrame(rows, schema).write.parquet(path)
        got = urls.judge(spark.read.schema(schema).parquet(path)).collect()
        assert len(got) == len(rows) and all(x.verdict == ("block" if x.rule else "allow") for x in got)


def test_url_filter_stays_native(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.org/fr/y")], "page_id bigint, url string")
    plan = urls.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
