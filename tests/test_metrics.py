from datetime import datetime, timezone

import pytest

from changelake.functions.schema_diff import schema_drift_rows
from changelake.plans.metrics import (GateError, age_hours, freshness_metrics, layer_divergence,
                                      require_fresh, require_no_divergence, row_count_metrics,
                                      stale_alerts)
from changelake.schemas import bronze_schema


def test_age_hours(spark):
    df = spark.createDataFrame([("2026-03-01 23:59:59.000000",), ("2026-03-02T23:59:59",), ("junk",), (None,),
                                ("2026-03-02T23:59:59+05:00",), ("2026-03-02 23:59:59Z",)], "t string")
    got = [r.h for r in df.select(age_hours("t").alias("h")).collect()]
    assert got[0] == pytest.approx(24.0) and got[1] == pytest.approx(0.0)
    assert got[2] is None and got[3] is None
    assert got[4] == pytest.approx(5.0) and got[5] == pytest.approx(0.0)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.h for r in df.select(age_hours("t").alias("h")).collect()] == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_unknown_or_missing_age_fails_the_gate(spark):
    mx = spark.createDataFrame([("a", "not a time"), ("b", "2026-03-02 12:00:00")],
                               "table_name string, max_capture_ts string")
    m = freshness_metrics(mx, "dev")
    assert [r.table_name for r in stale_alerts(m).collect()] == ["a"]
    with pytest.raises(GateError, match="a"):
        require_fresh(m)
    with pytest.raises(GateError, match="c .missing"):
        require_fresh(m.filter("table_name = 'b'"), required=["b", "c"])
    require_fresh(m.filter("table_name = 'b'"), required=["b"])


def test_freshness_skips_empty_and_alerts(spark):
    mx = spark.createDataFrame([("a", "2026-03-01 00:00:00"), ("b", "2026-03-02 12:00:00"), ("c", None)],
                               "table_name string, max_capture_ts string")
    m = freshness_metrics(mx, "dev")
    assert m.count() == 2
    assert [r.table_name for r in stale_alerts(m).collect()] == ["a"]
    with pytest.raises(GateError):
        require_fresh(m)
    require_fresh(m.filter("table_name = 'b'"))
    ref = freshness_metrics(mx.limit(1), "dev", datetime(2026, 3, 1, 1, 0, 0, tzinfo=timezone.utc))
    assert ref.first().value == pytest.approx(1.0)


def test_row_count_metric(spark):
    c = spark.createDataFrame([("t", 5)], "table_name string, rows bigint")
    r = row_count_metrics(c, "prod").first()
    assert (r.environment, r.value, r.metric_name) == ("prod", 5.0, "silver_row_count")


def test_layer_divergence_rules(spark):
    up = spark.createDataFrame([("a", 100), ("b", 100), ("c", 0), ("d", 10)], "table_name string, rows bigint")
    lo = spark.createDataFrame([("a", 96), ("b", 90), ("c", 5), ("e", 1)], "table_name string, rows bigint")
    rep = {r.table_name: r for r in layer_divergence(up, lo).collect()}
    assert rep["a"].exceeds is False and rep["a"].divergence == pytest.approx(0.04)
    assert rep["b"].exceeds is True
    assert rep["c"].divergence is None and rep["c"].exceeds is False   # upper = 0: skipped
    assert rep["d"].lower_rows is None and rep["d"].exceeds is False   # missing: skipped
    assert rep["e"].upper_rows is None and rep["e"].exceeds is False
    with pytest.raises(GateError):
        require_no_divergence(layer_divergence(up, lo))


def test_schema_drift_statuses():
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
    expected = bronze_schema("orders")
    actual = StructType([f for f in expected.fields if f.name != "order_status"]
                        + [StructField("extra", StringType())])
    actual = StructType([StructField(f.name, LongType()) if f.name == "customer_id" else
                         StructField(f.name, StringType()) if f.name == "order_id" else f
                         for f in actual.fields])
    got = {r["column_name"]: r["status"] for r in schema_drift_rows(expected, actual)}
    assert got["order_status"] == "missing" and got["extra"] == "extra"
    assert got["order_id"] == "retyped" and got["customer_id"] == "retyped"
    widened = StructType([StructField("customer_id", IntegerType())])
    assert schema_drift_rows(StructType([StructField("customer_id", LongType())]), widened)[0]["status"] == "widened"


def test_row_count_expectations(spark):
    from changelake.operators.dq import row_count_expectations
    counts = spark.createDataFrame([("a", 50), ("b", 5)], "table_name string, rows bigint")
    rep = {r.table_name: r.passed for r in row_count_expectations(
        counts, {"a": (50, 50), "b": (10, None), "c": (None, 3)}).collect()}
    assert rep == {"a": True, "b": False, "c": False}
