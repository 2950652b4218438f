"""Orders and their lines agree on the winner; snapshots, measured broadcasts;
footers by range; zones."""

import os

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from changelake.functions.timefmt import parse_capture_ts
from changelake.operators.joins import attach_parent, measured, stored
from changelake.plans.silver_job import live_snapshot, run_all
from changelake.plans.specs import FIXTURE_SPECS, SPECS, silver_frame
from changelake.config import Paths, RunConfig
from changelake.schemas import bronze_schema
from changelake.sinks.parquet import read_table
from changelake.sources import fixtures as fx
from changelake.sources.bronze import check_layouts, file_schemas, list_files, open_store, store_path

SF = "/root/testdata/sf0.001"
ORDERS = "Op string, _dms_timestamp string, order_id int, customer_id int, order_date timestamp_ntz, order_status string, updated_at timestamp_ntz"
ITEMS = ("Op string, _dms_timestamp string, order_item_id bigint, order_id int, product_id int, quantity int, "
         "unit_price decimal(10,2), line_total decimal(10,2), updated_at timestamp_ntz")


def _frames(spark, orders):
    o = spark.createDataFrame(orders, "Op string, _dms_timestamp string, order_id int, customer_id int, d string, order_status string")
    o = o.select("Op", "_dms_timestamp", "order_id", "customer_id", F.col("d").cast("timestamp_ntz").alias("order_date"),
                 "order_status", F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    i = spark.createDataFrame([("I", "2024-01-01 00:00:00", 1, 1, 1, 1)],
                              "Op string, _dms_timestamp string, order_item_id bigint, order_id int, product_id int, quantity int")
    i = i.select("*", F.lit(5).cast("decimal(10,2)").alias("unit_price"), F.lit(5).cast("decimal(10,2)").alias("line_total"),
                 F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return o, i


def _months(o, i, **kw):
    orders = silver_frame(SPECS["fact_orders"], o, parent_specs=SPECS, **kw).select("order_month").collect()
    items = silver_frame(SPECS["fact_order_items"], i, {"orders": o}, SPECS, **kw).select("order_month").collect()
    return [r[0] for r in orders], [r[0] for r in items]


def test_full_ties_have_one_winner_for_orders_and_lines(spark):
    # Same time and operation; the whole row alone would prefer customer 9 (month 1).
    o, i = _frames(spark, [("U", "2024-01-01 00:00:00", 1, 9, "2024-01-05", "a"),
                           ("U", "2024-01-01 00:00:00", 1, 2, "2024-02-05", "z")])
    assert _months(o, i) == ([2], [2])


def test_lines_follow_the_order_of_their_parent_log(spark):
    # As text "9..." is newest, as time it is the oldest.
    o, i = _frames(spark, [("I", "2024-9-01 00:00:00", 1, 1, "2024-01-05", "a"),
                           ("U", "2024-10-01 00:00:00", 1, 1, "2024-02-05", "a")])
    assert _months(o, i, order_as="string") == ([1], [1])
    assert _months(o, i, order_as="timestamp") == ([2], [2])


def test_parent_whose_ties_do_not_fall_to_borrowed_columns_is_read_whole(spark):
    loose = {**SPECS, "fact_orders": SPECS["fact_orders"].with_(tie_breakers=())}
    o, i = _frames(spark, [("U", "2024-01-01 00:00:00", 1, 9, "2024-01-05", "a"),
                           ("U", "2024-01-01 00:00:00", 1, 2, "2024-02-05", "z")])
    orders = silver_frame(loose["fact_orders"], o, parent_specs=loose).collect()
    items = silver_frame(loose["fact_order_items"], i, {"orders": o}, loose).collect()
    assert orders[0].order_month == items[0].order_month == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_children_join_a_snapshot_without_reconciling_the_parent(spark, tmp_root):
    spec = FIXTURE_SPECS["fact_order_items"]
    raws = {s: fx.bronze(spark, SF, s) for s in ("orders", "order_items")}
    cfg = RunConfig(Paths.under(tmp_root))
    want = silver_frame(spec, raws["order_items"], {"orders": raws["orders"]}, FIXTURE_SPECS)
    for buckets, exchanges in ((4, 2), (None, 3)):
        snapshot, drop = live_snapshot(spark, spec, "orders", cfg, raws, FIXTURE_SPECS["fact_orders"], buckets)
        got = silver_frame(spec, raws["order_items"], parent_specs=FIXTURE_SPECS, live_parents={"orders": snapshot})
        plan = _plan(got)
        assert plan.count("Window [") == 1 and plan.count("Exchange") == exchanges     # two are the lines' own
        assert "ReadSchema: struct<order_id:int,order_date:timestamp_ntz>" in plan
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        drop()


def test_run_all_uses_one_snapshot(spark, tmp_root):
    raws = {s: fx.bronze(spark, SF, s) for s in ("orders", "order_items")}
    specs = {t: FIXTURE_SPECS[t] for t in ("fact_orders", "fact_order_items")}
    for n, buckets in enumerate((None, 4)):
        cfg = RunConfig(Paths.under(os.path.join(tmp_root, str(n))))
        runs = run_all(spark, cfg, specs, raws, parent_buckets=buckets)
        assert runs["fact_order_items"].valid_rows == 2645
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("live_orders")]


def test_broadcast_only_within_the_measured_bound(spark):
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        child = spark.range(1000).selectExpr("id % 400 as k", "id as v")
        parent = spark.range(300).selectExpr("id as k", "repeat('x', 100) as p")
        small = attach_parent(child, parent, "k", broadcast_up_to=1 << 20)
        large = attach_parent(child, parent, "k", broadcast_up_to=30_000)       # 300 rows of 132 bytes
        assert "BroadcastHashJoin" in _plan(small) and "BroadcastHashJoin" not in _plan(large)
        assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
        empty = spark.createDataFrame([], "a int, s array<int>")
        assert "broadcast" in measured(spark, stored(empty, "t"))._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


# ---- footers ------------------------------------------------------------------------

@pytest.mark.parametrize("uri,kind,place", [
    ("file:/a/b c#1?.parquet", pafs.LocalFileSystem, "/a/b c#1?.parquet"),
    ("/a/b.parquet", pafs.LocalFileSystem, "/a/b.parquet"),
    ("s3a://bucket/k/x%20y.parquet", pafs.S3FileSystem, "bucket/k/x%20y.parquet"),
    ("s3://bucket/k/x.parquet", pafs.S3FileSystem, "bucket/k/x.parquet"),
    ("abfss://box@account.dfs.core.windows.net/k/x.parquet", "AzureFileSystem", "box/k/x.parquet"),
    ("gs://bucket/x.parquet", "GcsFileSystem", "bucket/x.parquet"),
])
def test_every_scheme_has_its_store(uri, kind, place):
    assert store_path(uri) == place
    if isinstance(kind, str):
        kind = getattr(pafs, kind, None)
        if kind is None:
            pytest.skip("this build of pyarrow lacks the store")
    if kind in (pafs.LocalFileSystem,):
        assert isinstance(open_store(uri)[0], kind)
    elif kind is pafs.S3FileSystem:
        store = open_store(uri, {"fs.s3a.endpoint.region": "eu-west-1", "fs.s3a.access.key": "a", "fs.s3a.secret.key": "b"})[0]
        assert isinstance(store, kind) and store.region == "eu-west-1"


def test_unknown_scheme_raises():
    with pytest.raises(ValueError, match="nosuch"):
        open_store("nosuch://x/y.parquet")


def test_footers_without_contents(spark, tmp_root):
    root = os.path.join(tmp_root, "raw")
    os.makedirs(os.path.join(root, "2024"))
    schema = bronze_schema("orders", None)
    ts = pa.array([None] * 3, pa.timestamp("us", tz="UTC"))
    table = pa.table({"Op": ["I"] * 3, "_dms_timestamp": ["t"] * 3, "order_id": pa.array([1, 2, 3], pa.int32()),
                      "customer_id": pa.array([1, 2, 3], pa.int32()), "order_date": ts,
                      "order_status": ["a"] * 3, "updated_at": ts})
    pq.write_table(table, os.path.join(root, "LOAD.parquet"))
    pq.write_table(table, os.path.join(root, "2024", "a [1] {b}.parquet"))
    listed = list_files(spark, root)
    assert "content" not in listed.columns and listed.count() == 2
    assert "ReadSchema: struct<path:string>" in _plan(file_schemas(spark, root))
    assert check_layouts(spark, root, schema, "warn") == 6
    names = [r.path for r in listed.select("path").collect()]
    assert check_layouts(spark, names, schema, "warn", recursive=False) == 6


# ---- zones -----------------------------------------------------------------------

def test_zones_are_read_or_refused(spark):
    cases = {"2024-07-02 03:04:05 Europe/Paris": "2024-07-02 01:04:05", "2024-01-02 03:04:05 PST": "2024-01-02 11:04:05",
             "2024-01-02T03:04:05Z": "2024-01-02 03:04:05", "2024-01-02 03:04:05.5+05:30": "2024-01-01 21:34:05.500000",
             "2024-01-02 03:04:05 Mars/Base": None, "2024-01-02 03:04:05": "2024-01-02 03:04:05", "12:30": None,
             "2024-01-02": "2024-01-02 00:00:00", "x": None}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", parse_capture_ts("s").alias("t"))
            assert {r.s: r.t and str(r.t) for r in df.collect()} == cases
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_read_back_of_full_and_incremental_rows_has_one_shape(spark, tmp_root):
    spec = FIXTURE_SPECS["fact_orders"]
    cfg = RunConfig(Paths.under(tmp_root))
    runs = run_all(spark, cfg, {"fact_orders": spec}, {"orders": fx.bronze(spark, SF, "orders")})
    assert read_table(spark, cfg.paths.silver_table("fact_orders")).columns == read_table(
        spark, runs["fact_orders"].silver_path).columns
