"""On-disk behaviour: recursive raw reads, empty writes, quarantine re-runs,
static overwrite of partitioned Silver, catalog registration."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from changelake.functions.schema_diff import DriftError
from changelake.schemas import bronze_schema
from changelake.sinks.parquet import read_table, register_table, write_quarantine, write_silver
from changelake.sources.bronze import footer_drift, read_bronze
from changelake.sources.fixtures import write_change_log


def _orders_table(rows):
    import datetime as dt
    ts = dt.datetime(2024, 1, 1)
    return pa.table({
        "Op": [r[0] for r in rows], "_dms_timestamp": [r[1] for r in rows],
        "order_id": pa.array([r[2] for r in rows], pa.int32()),
        "customer_id": pa.array([1] * len(rows), pa.int32()),
        "order_date": pa.array([ts] * len(rows), pa.timestamp("us")),
        "order_status": ["x"] * len(rows),
        "updated_at": pa.array([ts] * len(rows), pa.timestamp("us")),
    })


def test_load_file_and_nested_change_files_are_all_read(spark, tmp_root):
    root = os.path.join(tmp_root, "orders")
    os.makedirs(os.path.join(root, "2024", "01", "02"))
    pq.write_table(_orders_table([("I", "2024-01-01 00:00:00.000000", 1)]), os.path.join(root, "LOAD00000001.parquet"))
    pq.write_table(_orders_table([("U", "2024-01-02 00:00:00.000000", 1), ("I", "2024-01-02 00:00:00.000000", 2)]),
                   os.path.join(root, "2024", "01", "02", "20240102-000000-000.parquet"))
    open(os.path.join(root, "_SUCCESS"), "w").close()
    schema = bronze_schema("orders", TimestampNTZType())
    assert read_bronze(spark, root, schema).count() == 3
    # Without the recursive walk only the top-level load file is seen.
    assert spark.read.schema(schema).parquet(root).count() == 1


def test_missing_column_reads_null_unless_checked(spark, tmp_root):
    root = os.path.join(tmp_root, "orders")
    os.makedirs(root)
    t = _orders_table([("I", "2024-01-01 00:00:00.000000", 1)]).drop(["order_status"])
    pq.write_table(t, os.path.join(root, "LOAD00000001.parquet"))
    schema = bronze_schema("orders", TimestampNTZType())
    assert read_bronze(spark, root, schema).first().order_status is None
    drift = {r["column_name"]: r["status"] for r in footer_drift(spark, root, schema)}
    assert drift["order_status"] == "missing" and drift["order_id"] == "ok"
    with pytest.raises(DriftError):
        read_bronze(spark, root, schema, check_schema="error")


def test_write_change_log_layout_round_trips(spark, tmp_root):
    from changelake.sources import fixtures as fx
    raw = fx.bronze(spark, "/root/testdata/sf0.001", "orders")
    root = os.path.join(tmp_root, "raw")
    write_change_log(raw, root, folders="month")
    back = read_bronze(spark, root, bronze_schema("orders", TimestampNTZType()))
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_empty_partitioned_write_reads_back_with_schema(spark, tmp_root):
    df = spark.createDataFrame([], "a int, y int, m int")
    path = os.path.join(tmp_root, "t")
    write_silver(df, path, ["y", "m"])
    assert read_table(spark, path, df.schema).count() == 0


def test_quarantine_rerun_replaces_only_its_run(spark, tmp_root):
    path = os.path.join(tmp_root, "q")
    df = spark.createDataFrame([(1, "e"), (2, "e")], "a int, _validation_errors string")
    write_quarantine(df, path, "run1")
    write_quarantine(df, path, "run2")
    write_quarantine(df.limit(1), path, "run2")   # retry of run2
    counts = {r.run_id: r["count"] for r in read_table(spark, path).groupBy("run_id").count().collect()}
    assert counts == {"run1": 2, "run2": 1}


def test_silver_overwrite_drops_stale_partitions(spark, tmp_root):
    path = os.path.join(tmp_root, "s")
    write_silver(spark.createDataFrame([(1, 2020, 1), (2, 2021, 1)], "a int, y int, m int"), path, ["y", "m"])
    write_silver(spark.createDataFrame([(3, 2022, 1)], "a int, y int, m int"), path, ["y", "m"])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(3, 2022, 1)]


def test_partition_filter_prunes_folders(spark, tmp_root):
    path = os.path.join(tmp_root, "s")
    write_silver(spark.createDataFrame([(1, 2020, 1), (2, 2021, 1)], "a int, y int, m int"), path, ["y", "m"])
    df = read_table(spark, path).filter((F.col("y") == 2021) & (F.col("m") == 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    assert df.count() == 1


def test_register_table(spark, tmp_root):
    path = os.path.join(tmp_root, "reg")
    write_silver(spark.createDataFrame([(1, 2020, 1)], "a int, y int, m int"), path, ["y", "m"])
    register_table(spark, "reg_t", path, partition_by=["y", "m"])
    assert spark.table("reg_t").count() == 1
    other = os.path.join(tmp_root, "reg2")
    write_silver(spark.createDataFrame([(1, 2020, 1), (2, 2021, 1)], "a int, y int, m int"), other, ["y", "m"])
    register_table(spark, "reg_t", other, partition_by=["y", "m"], version="r2")
    assert spark.table("reg_t").count() == 2
    assert [t.name for t in spark.catalog.listTables(pattern="reg_t__*")] == ["reg_t__r2"]
    spark.sql("DROP VIEW reg_t")


def test_drift_is_seen_per_file(spark, tmp_root):
    root = os.path.join(tmp_root, "orders")
    os.makedirs(os.path.join(root, "2024"))
    full = _orders_table([("I", "2024-01-01 00:00:00.000000", 1)])
    pq.write_table(full, os.path.join(root, "LOAD00000001.parquet"))
    pq.write_table(full.drop(["order_status"]), os.path.join(root, "2024", "a.parquet"))
    pq.write_table(full.set_column(2, "order_id", pa.array(["x"])), os.path.join(root, "2024", "b.parquet"))
    schema = bronze_schema("orders", TimestampNTZType())
    got = {(r["column_name"], r["status"]): r["files"] for r in footer_drift(spark, root, schema)}
    assert got[("order_status", "missing")] == 1 and got[("order_status", "ok")] == 2
    assert got[("order_id", "retyped")] == 1 and got[("order_id", "ok")] == 2
    with pytest.raises(DriftError):
        read_bronze(spark, root, schema, check_schema="error")
