"""Numbered manifests: whole versions for readers, one winner among writers."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from changelake.config import Paths, RunConfig
from changelake.plans.metrics import GateError
from changelake.plans.silver_job import run_table
from changelake.plans.specs import FIXTURE_SPECS
from changelake.sinks import versions
from changelake.sinks.parquet import read_metrics, read_table, register_table, write_silver
from changelake.sinks.versions import ROWS, ConcurrentCommit
from changelake.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _write(spark, root, ids, month=1):
    attempt = versions.new_attempt()
    df = spark.createDataFrame([(i, 2024, month) for i in ids], "a int, y int, m int")
    write_silver(df, versions.attempt_path(root, attempt), ["y", "m"])
    return versions.written_section(spark, root, attempt, ROWS, ["y", "m"])


def test_of_two_writers_one_wins(spark, tmp_root):
    root = os.path.join(tmp_root, "t")
    base = versions.commit(spark, root, None, "r0", {ROWS: _write(spark, root, [1])})
    sections = [_write(spark, root, [10 + i]) for i in range(6)]

    def publish(i):
        try:
            return versions.commit(spark, root, base, f"w{i}", {ROWS: sections[i]}).run_id
        except ConcurrentCommit:
            return None
    with ThreadPoolExecutor(6) as pool:
        won = [w for w in pool.map(publish, range(6)) if w]
    assert len(won) == 1
    now = versions.latest(spark, root)
    assert now.version == 2 and now.run_id == won[0]
    assert [r.a for r in read_table(spark, root).collect()] == [10 + int(won[0][1:])]
    assert not [f for f in os.listdir(os.path.join(root, "_log")) if f.endswith(".tmp")]


def test_versions_share_partitions_and_vacuum_keeps_what_is_named(spark, tmp_root):
    root = os.path.join(tmp_root, "t")
    one, two = _write(spark, root, [1], 1), _write(spark, root, [2], 2)
    v1 = versions.commit(spark, root, None, "r1", {ROWS: versions.Section(["y", "m"], {**one.folders, **two.folders})})
    pinned = versions.read_section(spark, root, v1.sections[ROWS])
    new = _write(spark, root, [3], 2)
    v2 = versions.commit(spark, root, v1, "r2", {ROWS: versions.Section(["y", "m"], {**one.folders, **new.folders})})
    assert sorted(r.a for r in read_table(spark, root).collect()) == [1, 3]
    assert sorted(r.a for r in pinned.collect()) == [1, 2]        # a reader on the older version
    running = _write(spark, root, [9], 3)                          # an attempt nobody has published yet
    assert versions.vacuum(spark, root, keep=1) == [f.split("/")[2].split("=")[1] for f in two.folders["y=2024/m=2"]]
    assert versions.versions(spark, root) == [v2.version]
    assert sorted(r.a for r in read_table(spark, root).collect()) == [1, 3]
    assert versions.read_section(spark, root, running).count() == 1
    assert versions.vacuum(spark, root, keep=1, grace_seconds=-1)  # a dead one, by now
    df = read_table(spark, root).filter("m = 2")
    assert "PartitionFilters: [isnotnull(m" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.a for r in df.collect()] == [3]


def test_a_retry_of_the_current_run_never_touches_its_folder(spark, tmp_root):
    spec = FIXTURE_SPECS["dim_product"]
    raw = fx.bronze(spark, SF, "products")
    cfg = RunConfig(Paths.under(tmp_root), run_id="same")
    first = run_table(spark, spec, cfg, raw=raw, parent_specs=FIXTURE_SPECS)
    reader = read_table(spark, cfg.paths.silver_table("dim_product"))
    files = sorted(os.listdir(first.silver_path.replace("file:", "")))
    second = run_table(spark, spec, cfg, raw=raw.where("product_id < 100"), parent_specs=FIXTURE_SPECS)
    assert second.silver_path != first.silver_path
    assert sorted(os.listdir(first.silver_path.replace("file:", ""))) == files
    assert reader.count() == first.valid_rows
    assert read_table(spark, cfg.paths.silver_table("dim_product")).count() == second.valid_rows


def test_run_that_lost_the_race_leaves_nothing(spark, tmp_root, monkeypatch):
    import changelake.plans.silver_job as job
    spec = FIXTURE_SPECS["dim_product"]
    raw = fx.bronze(spark, SF, "products")
    cfg = RunConfig(Paths.under(tmp_root), run_id="a")
    root = cfg.paths.silver_table("dim_product")
    real = job.write_silver

    def slow(df, path, parts=(), **kw):     # another run publishes while this one writes
        real(df, path, parts, **kw)
        monkeypatch.setattr(job, "write_silver", real)
        run_table(spark, spec, RunConfig(Paths.under(tmp_root), run_id="b"), raw=raw, parent_specs=FIXTURE_SPECS)
    monkeypatch.setattr(job, "write_silver", slow)
    with pytest.raises(ConcurrentCommit):
        run_table(spark, spec, cfg, raw=raw.where("product_id < 9"), parent_specs=FIXTURE_SPECS)
    now = versions.latest(spark, root)
    assert now.run_id == "b" and {a for a, _ in versions._attempt_folders(spark, root)} == now.attempts()


def test_gate_runs_before_the_version_is_published(spark, tmp_root):
    spec = FIXTURE_SPECS["fact_orders"]
    raw = fx.bronze(spark, SF, "orders")
    cfg = RunConfig(Paths.under(tmp_root), run_id="a", fail_on_empty=True,
                    metrics_path=os.path.join(tmp_root, "metrics"))
    good = run_table(spark, spec, cfg, raw=raw, parent_specs=FIXTURE_SPECS)
    with pytest.raises(GateError):
        run_table(spark, spec, cfg, raw=raw.where("false"), parent_specs=FIXTURE_SPECS)
    assert read_table(spark, cfg.paths.silver_table("fact_orders")).count() == good.valid_rows
    counts = {r.value for r in read_metrics(spark, cfg.metrics_path).collect() if r.metric_name == "silver_row_count"}
    assert counts == {0.0}                  # the alarm sees the empty run


def test_a_version_registered_again_stays_under_its_view(spark, tmp_root):
    path, other = (os.path.join(tmp_root, n) for n in "ab")
    write_silver(spark.createDataFrame([(1, 2020)], "a int, y int"), path, ["y"])
    register_table(spark, "again_t", path, partition_by=["y"], version="r1")
    held = spark.table("again_t")
    register_table(spark, "again_t", path, partition_by=["y"], version="r1")
    assert held.count() == 1 and spark.table("again_t").count() == 1
    write_silver(spark.createDataFrame([(1, 2020), (2, 2021)], "a int, y int"), other, ["y"])
    register_table(spark, "again_t", other, partition_by=["y"], version="r1")
    assert spark.table("again_t").count() == 2
    spark.sql("DROP VIEW again_t")


def test_gate_reads_only_days_that_can_matter(spark, tmp_root):
    from changelake.plans.metrics import publish_row_count_metric
    path = os.path.join(tmp_root, "m")
    publish_row_count_metric(spark, "t", 3, "proj-dev-x", path, run_id="r1")
    os.makedirs(os.path.join(path, "recorded_on=2020-01-01"))
    for name in os.listdir(path):
        if name.startswith("recorded_on=2") and not name.endswith("2020-01-01"):
            os.system(f"cp -r {path}/{name}/run_id=r1 {path}/recorded_on=2020-01-01/run_id=r0")
    assert read_metrics(spark, path).count() == 2
    recent = read_metrics(spark, path, within_hours=2)
    assert recent.count() == 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recorded_on" in plan
