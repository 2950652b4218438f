"""Silver kept up to date from new files equals a full run after every batch."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from changelake.config import Paths, RunConfig
from changelake.plans.incremental_silver import FILES, QUARANTINE, STATE, apply_new_files, read_late, read_quarantine
from changelake.plans.metrics import GateError
from changelake.plans.replay_job import read_replayed, replay_into_silver
from changelake.plans.silver_job import run_table
from changelake.plans.specs import SPECS, silver_frame
from changelake.operators.quality import annotate, invalid_rows, valid_rows
from changelake.schemas import bronze_schema
from changelake.sinks import versions
from changelake.sinks.parquet import read_table
from changelake.sinks.versions import ROWS

NTZ = TimestampNTZType()
SCHEMAS = {s: bronze_schema(s, NTZ) for s in ("orders", "order_items", "customers", "payments")}


@pytest.fixture
def lake(spark, tmp_root):
    return _Lake(spark, tmp_root)


class _Lake:
    """A raw folder, the incremental tables over it, and full runs to compare."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.config = RunConfig(Paths.under(root), run_id="r", environment="dev")
        self.logs = {}

    def deliver(self, source, rows, name):
        schema = SCHEMAS[source]
        text = [(f.name, f.dataType) for f in schema.fields]
        df = self.spark.createDataFrame(rows, ", ".join(f"{n} string" for n, _ in text))
        df = df.select(*[F.col(n).cast(t).alias(n) for n, t in text])
        path = f"{self.config.paths.bronze_table(source)}/{name}"
        df.coalesce(1).write.mode("overwrite").parquet(path)
        self.logs.setdefault(source, {})[name] = df
        return path

    def apply(self, table, **kw):
        return apply_new_files(self.spark, SPECS[table], self.config, raw_schemas=SCHEMAS, check_schema="error", **kw)

    def raw(self, source):
        logs = list(self.logs[source].values())
        out = logs[0]
        for df in logs[1:]:
            out = out.unionByName(df)
        return out

    def check(self, table, **kw):
        """The table and its quarantine as a full run over all files has them."""
        spec = SPECS[table]
        full = annotate(silver_frame(spec, self.raw(spec.source), {p: self.raw(p) for p in spec.parents},
                                     SPECS, **kw), spec.rules)
        root = self.config.paths.silver_table(table)
        for want, got in ((valid_rows(full), read_table(self.spark, root, valid_rows(full).schema)),
                          (invalid_rows(full), versions.read_section(
                              self.spark, root, versions.latest(self.spark, root).sections[QUARANTINE],
                              invalid_rows(full).schema))):
            got = got.select(*want.columns)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        return read_table(self.spark, root, valid_rows(full).schema)


def _order(op, ts, key, day, status="confirmed", customer="1"):
    return (op, ts, key, customer, day and f"{day} 00:00:00", status, f"{ts}")


def _item(op, ts, key, order, quantity="1"):
    return (op, ts, key, order, "7", quantity, "5.00", "5.00", ts)


T = "2024-0{}-01 00:00:00.000000".format


def test_batches_equal_full_runs(lake):
    lake.deliver("orders", [_order("I", T(1), str(k), f"2023-0{1 + k % 4}-05") for k in range(20)]
                 + [_order("I", T(1), "90", None), _order("I", T(1), None, "2023-01-05")], "load")
    first = lake.apply("fact_orders")
    assert first.files == 1 and first.raw_rows == 22 and len(first.touched) == 5
    lake.check("fact_orders")

    # One order moves from month 1 to month 4, one goes, one is quarantined, one is mended.
    lake.deliver("orders", [_order("U", T(2), "0", "2023-04-09"), _order("D", T(2), "4", "2023-01-05"),
                            _order("U", T(2), "8", "2023-01-05", status=None),
                            _order("U", T(2), "90", "2023-04-30")], "b1")
    second = lake.apply("fact_orders")
    month = "order_year=2023/order_month={}".format
    assert month(1) in second.touched and month(4) in second.touched
    assert month(2) not in second.touched and month(3) not in second.touched
    silver = lake.check("fact_orders")
    assert [r.order_month for r in silver.where("order_id = 0").collect()] == [4]

    # Late events: older than the state's. They change nothing and revive nothing.
    lake.deliver("orders", [_order("U", "2023-12-01 00:00:00.000000", "4", "2023-01-05"),
                            _order("U", "2023-12-01 00:00:00.000000", "0", "2023-02-01")], "late")
    lake.apply("fact_orders")
    silver = lake.check("fact_orders")
    assert silver.where("order_id = 4").count() == 0
    assert lake.apply("fact_orders") is None           # nothing new


def test_only_touched_partitions_and_new_files_are_read_and_written(lake, spark):
    lake.deliver("orders", [_order("I", T(1), str(k), f"2023-0{1 + k % 6}-05") for k in range(60)], "load")
    lake.apply("fact_orders")
    root = lake.config.paths.silver_table("fact_orders")
    before = versions.latest(spark, root)
    lake.deliver("orders", [_order("U", T(2), "0", "2023-01-07")], "b1")
    run = lake.apply("fact_orders")
    after = versions.latest(spark, root)
    assert run.files == 1 and run.raw_rows == 1 and run.touched == ["order_year=2023/order_month=1"]
    for name in (ROWS, STATE):
        changed = {p for p, f in after.sections[name].folders.items() if before.sections[name].folders.get(p) != f}
        assert changed == {"order_year=2023/order_month=1"}
    taken = versions.read_section(spark, root, after.sections[FILES])
    assert taken.count() == 2 and taken.select("path").distinct().count() == 2


def test_children_follow_their_parents(lake):
    lake.deliver("orders", [_order("I", T(1), str(k), f"2023-0{1 + k}-05") for k in range(3)], "load")
    lake.deliver("order_items", [_item("I", T(1), str(10 * k + j), str(k)) for k in range(4) for j in range(3)], "load")
    with pytest.raises(ValueError, match="first"):
        lake.apply("fact_order_items")
    lake.apply("fact_orders")
    lake.apply("fact_order_items")
    lake.check("fact_order_items")
    # Order 0 moves, order 1 goes, order 3 appears: only lines of these change.
    lake.deliver("orders", [_order("U", T(2), "0", "2023-09-05"), _order("D", T(2), "1", "2023-02-05"),
                            _order("I", T(2), "3", "2023-03-15")], "b1")
    lake.apply("fact_orders")
    run = lake.apply("fact_order_items")
    assert run.files == 0 and "order_year=2023/order_month=9" in run.touched
    silver = lake.check("fact_order_items")
    assert {r.order_month for r in silver.where("order_id = 0").collect()} == {9}
    assert silver.where("order_id = 1").count() == 0 and silver.where("order_id = 3").count() == 3
    assert lake.apply("fact_order_items") is None


def test_children_are_all_looked_at_when_the_parent_version_is_gone(lake, spark):
    lake.deliver("orders", [_order("I", T(1), str(k), f"2023-0{1 + k}-05") for k in range(3)], "load")
    lake.deliver("order_items", [_item("I", T(1), str(10 * k), str(k)) for k in range(3)], "load")
    lake.apply("fact_orders")
    lake.apply("fact_order_items")
    for n in range(3):
        lake.deliver("orders", [_order("U", T(2 + n), str(n), f"2022-0{1 + n}-05")], f"b{n}")
        lake.apply("fact_orders", keep_versions=1)
    lake.apply("fact_order_items")
    lake.check("fact_order_items")


def test_tables_without_partitions_and_null_keys(lake, spark):
    def customer(op, ts, key, email="e@x.org"):
        return (op, ts, key, "A", "B", email, "DE", None, "2020-01-01 00:00:00", ts)
    lake.deliver("customers", [customer("I", T(1), str(k)) for k in range(40)]
                 + [customer("I", T(1), None), customer("I", T(1), None, "f@x.org")], "load")
    lake.apply("dim_customer", buckets=8, null_keys="keep", register=True)
    lake.deliver("customers", [customer("U", T(2), "3", None), customer("D", T(2), "4", None),
                               customer("U", T(2), None, "g@x.org")], "b1")
    run = lake.apply("dim_customer", buckets=8, null_keys="keep", register=True)
    assert run.partitions == 8 and len(run.touched) <= 4
    silver = lake.check("dim_customer", null_keys="keep")
    assert silver.count() == 38 and "_bucket" not in silver.columns
    assert read_table(spark, lake.config.paths.silver_table("dim_customer")).columns == silver.columns
    assert spark.table("dim_customer").count() == 38
    spark.sql("DROP VIEW dim_customer")
    assert read_quarantine(spark, lake.config.paths.silver_table("dim_customer")).count() == 4
    with pytest.raises(ValueError, match="built with"):
        lake.apply("dim_customer", buckets=4, null_keys="keep")


def test_many_files_go_in_steps_and_redelivered_files_are_new(lake, spark):
    for n in range(5):
        lake.deliver("orders", [_order("I", T(1), str(10 * n + k), "2023-01-05") for k in range(4)], f"f{n}")
    run = lake.apply("fact_orders", max_files=2)
    assert run.files == 5 and run.version == 3 and run.raw_rows == 20
    lake.check("fact_orders")
    lake.deliver("orders", [_order("U", T(3), "0", "2023-05-05")], "f0")      # other content, new file
    lake.logs["orders"]["f0-before"] = spark.createDataFrame(
        [_order("I", T(1), str(k), "2023-01-05") for k in range(4)],
        ", ".join(f"{f.name} string" for f in SCHEMAS["orders"].fields)).select(
        *[F.col(f.name).cast(f.dataType) for f in SCHEMAS["orders"].fields])
    assert lake.apply("fact_orders").files == 1
    lake.check("fact_orders")


def test_file_lists_are_folded(lake, spark, monkeypatch):
    import changelake.plans.incremental_silver as inc
    monkeypatch.setattr(inc, "FILE_LISTS", 2)
    root = lake.config.paths.silver_table("fact_orders")
    for n in range(4):
        lake.deliver("orders", [_order("I", T(1), str(n), "2023-01-05")], f"f{n}")
        lake.apply("fact_orders", keep_versions=1)
    section = versions.latest(spark, root).sections[FILES]
    assert len(section.folders[""]) <= 2 and versions.read_section(spark, root, section).count() == 4
    assert lake.apply("fact_orders") is None
    lake.check("fact_orders")


def test_a_run_that_dies_loses_and_doubles_nothing(lake, spark, monkeypatch):
    import changelake.plans.incremental_silver as inc
    lake.deliver("orders", [_order("I", T(1), str(k), "2023-01-05") for k in range(6)], "load")
    lake.apply("fact_orders")
    root = lake.config.paths.silver_table("fact_orders")
    lake.deliver("orders", [_order("D", T(2), "1", "2023-01-05"), _order("I", T(2), "9", "2023-02-05")], "b1")

    def die(*_, **__):
        raise RuntimeError("lost")
    monkeypatch.setattr(inc.versions, "commit", die)
    with pytest.raises(RuntimeError, match="lost"):
        lake.apply("fact_orders")
    monkeypatch.undo()
    assert read_table(spark, root).count() == 6            # the old version, whole
    assert lake.apply("fact_orders").files == 1
    silver = lake.check("fact_orders")
    assert silver.count() == 6
    kept = {s for s, _ in versions._attempt_folders(spark, root)}
    assert kept == versions.latest(spark, root).attempts() | versions.manifest(spark, root, 1).attempts()


def test_empty_result_is_not_published(lake, spark):
    lake.config = RunConfig(Paths.under(lake.root), run_id="r", fail_on_empty=True)
    lake.deliver("orders", [_order("I", T(1), "1", "2023-01-05")], "load")
    lake.apply("fact_orders")
    lake.deliver("orders", [_order("D", T(2), "1", "2023-01-05")], "b1")
    with pytest.raises(GateError):
        lake.apply("fact_orders")
    assert read_table(spark, lake.config.paths.silver_table("fact_orders")).count() == 1


def test_drifted_files_are_refused(lake, spark):
    from changelake.functions.schema_diff import DriftError
    lake.deliver("orders", [_order("I", T(1), "1", "2023-01-05")], "load")
    lake.apply("fact_orders")
    bad = lake.raw("orders").drop("order_status")
    bad.coalesce(1).write.parquet(f"{lake.config.paths.bronze_table('orders')}/bad")
    with pytest.raises(DriftError):
        lake.apply("fact_orders")


def test_forgotten_deletes_are_never_revived(lake, spark):
    """The state follows the live keys; within the bound a late event loses to
    the delete, beyond it the event is set aside."""
    how = {"forget_deletes_days": 40}
    root = lake.config.paths.silver_table("fact_orders")

    def state():
        now = versions.latest(spark, root)
        return {r.order_id: r.Op for r in versions.read_section(spark, root, now.sections[STATE]).collect()}
    lake.deliver("orders", [_order("I", T(1), str(k), "2023-01-05") for k in range(6)], "load")
    lake.apply("fact_orders", **how)
    lake.deliver("orders", [_order("D", T(2), str(k), "2023-01-05") for k in range(4)], "b1")
    lake.apply("fact_orders", **how)
    assert state() == {0: "D", 1: "D", 2: "D", 3: "D", 4: "I", 5: "I"}
    lake.deliver("orders", [_order("U", "2024-01-20 00:00:00.000000", "0", "2023-01-05")], "late1")
    lake.apply("fact_orders", **how)                    # within the bound: the delete wins
    lake.check("fact_orders")
    lake.deliver("orders", [_order("U", T(6), "4", "2023-01-05")], "b2")
    lake.apply("fact_orders", **how)                    # the deletes are forgotten
    assert state() == {4: "U", 5: "I"}
    lake.check("fact_orders")
    lake.deliver("orders", [_order("U", "2024-01-25 00:00:00.000000", "1", "2023-01-05"),
                            _order("U", T(2), "5", "2023-01-06"), _order("I", T(6), "7", "2023-01-05")], "late2")
    lake.apply("fact_orders", **how)
    assert state() == {4: "U", 5: "U", 7: "I"}          # key 5 is known, so its old event counts
    assert [r.order_id for r in read_late(spark, root, SCHEMAS["orders"]).collect()] == [1]
    assert {r.order_id for r in read_table(spark, root).collect()} == {4, 5, 7}


@pytest.mark.parametrize("keys", [("order_item_id",), ("order_id", "order_item_id")])
def test_large_batches_equal_full_runs(lake, spark, monkeypatch, keys):
    """Nothing is small enough to broadcast: whole partitions are merged."""
    import changelake.plans.incremental_silver as inc
    monkeypatch.setattr(inc, "fits", lambda *_, **__: False)
    spec = SPECS["fact_order_items"].with_(keys=keys, tie_breakers=("product_id",))
    specs = {**SPECS, "fact_order_items": spec}

    def apply():
        lake.apply("fact_orders")
        run = apply_new_files(spark, spec, lake.config, raw_schemas=SCHEMAS, parent_specs=specs)
        full = annotate(silver_frame(spec, lake.raw("order_items"), {"orders": lake.raw("orders")}, specs), spec.rules)
        root = lake.config.paths.silver_table(spec.name)
        for want, got in ((valid_rows(full), read_table(spark, root)), (invalid_rows(full), read_quarantine(spark, root))):
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        lake.check("fact_orders")
        return run

    lake.deliver("orders", [_order("I", T(1), str(k), f"2023-0{1 + k}-05") for k in range(4)], "load")
    lake.deliver("order_items", [_item("I", T(1), str(10 * k + j), str(k)) for k in range(5) for j in range(3)]
                 + [_item("I", T(1), None, "0"), _item("I", T(1), "99", None)], "load")
    apply()
    # Order 0 moves to a month that no line event names, order 1 goes, order 4 appears; lines
    # change twice, tie, go and come. Month 3 has no event and stays.
    lake.deliver("orders", [_order("U", T(2), "0", "2023-02-09"), _order("D", T(2), "1", "2023-02-05"),
                            _order("I", T(2), "4", "2023-04-15")], "b1")
    lake.deliver("order_items", [_item("U", T(2), "0", "0", "3"), _item("U", T(3), "0", "0", "4"),
                                 _item("U", T(3), "0", "0", "5"), _item("D", T(2), "30", "3"),
                                 _item("U", "2023-12-01 00:00:00.000000", "1", "0", "9"),
                                 _item("I", T(2), "77", "0"), _item("U", T(2), None, "0", "0")], "b1")
    run = apply()
    assert "order_year=2023/order_month=3" not in run.touched
    assert apply() is None
    # Only new lines of a month that has others: these stay.
    lake.deliver("order_items", [_item("I", T(4), "200", "2")], "b2")
    assert apply().touched == ["order_year=2023/order_month=3"]


# ---- replay ---------------------------------------------------------------------

def _payment(op, ts, key, amount, day="2023-01-05"):
    return (op, ts, key, "1", "paypal", amount, "completed", f"{day} 00:00:00", ts)


LOOSE = {k: v for k, v in SPECS["fact_payments"].rules.items() if k != "amount_positive"}
LOOSE["amount_known"] = "amount IS NOT NULL"


@pytest.mark.parametrize("incremental", [True, False])
def test_replay_publishes_once(lake, spark, incremental):
    spec, root = SPECS["fact_payments"], lake.config.paths.silver_table("fact_payments")
    lake.deliver("payments", [_payment("I", T(1), str(k), str(k - 2), f"2023-0{1 + k % 2}-05") for k in range(8)]
                 + [_payment("I", T(1), "50", None)], "load")
    if incremental:
        lake.apply("fact_payments")
    else:
        run_table(spark, spec, lake.config, timestamp_type=NTZ, parent_specs=SPECS)
    assert read_table(spark, root).count() == 5
    run = replay_into_silver(spark, spec, lake.config, LOOSE)
    assert (run.published, run.yielded, run.still_failing) == (3, 0, 1)
    assert read_table(spark, root).count() == 8
    assert {r.replayed_by for r in read_replayed(spark, root).collect()} == {"r"}
    again = replay_into_silver(spark, spec, lake.config, LOOSE)
    assert again.version is None and again.published == 0
    assert versions.latest(spark, root).version == run.version == 2
    if incremental:     # later batches go on from the replayed version, with the corrected rules
        fixed = spec.with_(rules=LOOSE)
        lake.deliver("payments", [_payment("D", T(2), "0", "1"), _payment("I", T(2), "60", "3")], "b1")
        apply_new_files(spark, fixed, lake.config, raw_schemas=SCHEMAS)
        got = {r.payment_id for r in read_table(spark, root).collect()}
        assert got == {1, 2, 3, 4, 5, 6, 7, 60}
        assert versions.latest(spark, root).facts["valid_rows"] == 8


def test_replayed_rows_yield_to_silver_and_stale_replays_fail(lake, spark, monkeypatch):
    spec, root = SPECS["fact_payments"], lake.config.paths.silver_table("fact_payments")
    lake.deliver("payments", [_payment("I", T(1), "1", "5"), _payment("I", T(1), "2", "-5")], "load")
    lake.apply("fact_payments")
    run = replay_into_silver(spark, spec, lake.config, LOOSE, keys=("order_id",))   # both have order 1
    assert (run.published, run.yielded) == (0, 1)
    import changelake.plans.replay_job as job
    now = versions.latest(spark, root)
    lake.deliver("payments", [_payment("I", T(2), "3", "5")], "b1")
    lake.apply("fact_payments")
    real = versions.latest
    monkeypatch.setattr(job.versions, "latest", lambda s, r: now if r == root else real(s, r))
    with pytest.raises(versions.ConcurrentCommit):
        replay_into_silver(spark, spec, lake.config, LOOSE)
    monkeypatch.undo()
    assert {r.payment_id for r in read_table(spark, root).collect()} == {1, 3}
    assert os.path.isdir(root)
