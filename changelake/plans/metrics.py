"""Freshness and row-count metrics, alarms and run gates.

Metrics are rows, not network calls: one row per (metric, table) with the
namespace, environment, value, unit, run and recording time, in a metrics table
that any alarm or dashboard can read. Every frame here is a tiny aggregate of the data
(one row per table), so gates may collect them safely.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (DIVERGENCE_THRESHOLD, REFERENCE_TIME, STALE_AFTER_HOURS,
                      environment_from_job_name)
from ..functions.timefmt import hours_between, parse_capture_ts
from ..sinks.parquet import record_metrics

# Metric identities.
FRESHNESS_NAMESPACE = "changelake/freshness"
FRESHNESS_METRIC = "silver_data_age_hours"
ROW_COUNT_NAMESPACE = "changelake/quality"
ROW_COUNT_METRIC = "silver_row_count"
METRIC_UNIT = "Count"
# Fixed value: hours that a recorded point counts as current for a gate.
LATEST_WINDOW_HOURS = 2.0

METRIC_COLUMNS = ["namespace", "metric_name", "table_name", "environment", "value", "unit"]


def reference_instant(reference_time: datetime = REFERENCE_TIME) -> Column:
    """The cut-off as a zone-less UTC wall-clock timestamp."""
    return F.to_timestamp_ntz(F.lit(reference_time.strftime("%Y-%m-%d %H:%M:%S")))


def age_hours(max_capture_ts: Column | str, reference_time: datetime = REFERENCE_TIME) -> Column:
    """Hours from the newest capture time to the cut-off (positive = stale)."""
    return hours_between(parse_capture_ts(max_capture_ts), reference_instant(reference_time))


def freshness_metrics(max_ts: DataFrame, environment: str = "unknown",
                      reference_time: datetime = REFERENCE_TIME) -> DataFrame:
    """``max_ts(table_name, max_capture_ts)`` -> metric rows. Tables whose log
    is empty (NULL max) publish nothing; a time that cannot be read publishes a
    NULL age, which counts as stale."""
    return (max_ts.filter(F.col("max_capture_ts").isNotNull())
            .select(F.lit(FRESHNESS_NAMESPACE).alias("namespace"),
                    F.lit(FRESHNESS_METRIC).alias("metric_name"),
                    "table_name",
                    F.lit(environment).alias("environment"),
                    age_hours("max_capture_ts", reference_time).alias("value"),
                    F.lit(METRIC_UNIT).alias("unit")))


def row_count_metrics(counts: DataFrame, environment: str = "unknown") -> DataFrame:
    """``counts(table_name, rows)`` -> metric rows."""
    return counts.select(F.lit(ROW_COUNT_NAMESPACE).alias("namespace"),
                         F.lit(ROW_COUNT_METRIC).alias("metric_name"),
                         "table_name",
                         F.lit(environment).alias("environment"),
                         F.col("rows").cast("double").alias("value"),
                         F.lit(METRIC_UNIT).alias("unit"))


def stale_alerts(metrics: DataFrame, threshold_hours: float = STALE_AFTER_HOURS) -> DataFrame:
    """Freshness points above the threshold or without a known age."""
    return metrics.filter((F.col("metric_name") == FRESHNESS_METRIC) &
                          (F.col("value").isNull() | (F.col("value") > F.lit(threshold_hours))))


def latest_points(metrics: DataFrame, environment: str | None = None,
                  window_hours: float | None = LATEST_WINDOW_HOURS) -> DataFrame:
    """The last point of every (metric, table, environment) that was recorded
    within the window; of points recorded together the highest value counts.
    One row per table and metric, whatever the number of runs recorded."""
    recent = metrics
    if environment is not None:
        recent = recent.filter(F.col("environment") == environment)
    if window_hours is not None:
        recent = recent.filter(F.col("recorded_at") >= F.current_timestamp()
                               - F.make_dt_interval(hours=F.lit(0), secs=F.lit(window_hours * 3600)))
    last = F.max_by(F.struct("namespace", "value", "unit", "run_id"),
                    F.struct("recorded_at", F.col("value").isNull(), "value"))
    return (recent.groupBy("metric_name", "table_name", "environment").agg(last.alias("p"), F.max("recorded_at").alias("recorded_at"))
            .select("p.namespace", "metric_name", "table_name", "environment", "p.value", "p.unit", "p.run_id", "recorded_at"))


def stale_tables(metrics: DataFrame, required: Sequence[str],
                 threshold_hours: float = STALE_AFTER_HOURS) -> DataFrame:
    """(table_name, value, reason) of every required table that fails the
    freshness gate: ``missing`` (no point), ``unknown age`` or ``stale``."""
    spark = metrics.sparkSession
    want = spark.createDataFrame([(t,) for t in required], "table_name string")
    have = metrics.filter(F.col("metric_name") == FRESHNESS_METRIC).select(
        "table_name", "value", F.lit(True).alias("found"))
    reason = (F.when(F.col("found").isNull(), "missing").when(F.col("value").isNull(), "unknown age")
              .when(F.col("value") > threshold_hours, "stale"))
    return (want.join(have, "table_name", "left").select("table_name", "value", reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def layer_divergence(upper: DataFrame, lower: DataFrame,
                     threshold: float = DIVERGENCE_THRESHOLD) -> DataFrame:
    """Compare two layers' counts per table: ``upper(table_name, rows)`` is the
    reference layer. ``divergence = |upper - lower| / upper``; tables missing
    on either side or with ``upper = 0`` are reported with NULL divergence and
    never flagged."""
    u = upper.select("table_name", F.col("rows").alias("upper_rows"))
    lo = lower.select("table_name", F.col("rows").alias("lower_rows"))
    return divergence_report(u.join(lo, "table_name", "full_outer"), threshold)


def divergence_report(counts: DataFrame, threshold: float = DIVERGENCE_THRESHOLD) -> DataFrame:
    """``counts(table_name, upper_rows, lower_rows)`` with divergence and verdict."""
    div = F.when((F.col("upper_rows") > 0) & F.col("lower_rows").isNotNull(),
                 F.abs(F.col("upper_rows") - F.col("lower_rows")) / F.col("upper_rows"))
    return counts.select("table_name", "upper_rows", "lower_rows", div.alias("divergence"),
                    F.coalesce(div > F.lit(threshold), F.lit(False)).alias("exceeds"))


class GateError(RuntimeError):
    pass


def require_fresh(metrics: DataFrame, threshold_hours: float = STALE_AFTER_HOURS,
                  required: Sequence[str] | None = None) -> None:
    """Fail before building marts when a table is stale, of unknown age or, with
    ``required``, has no point at all. ``metrics`` holds one point per table."""
    if required is None:
        bad = stale_alerts(metrics, threshold_hours).select("table_name", "value", F.lit("stale").alias("reason"))
    else:
        bad = stale_tables(metrics, required, threshold_hours)
    bad = bad.collect()   # one row per table
    if bad:
        raise GateError("stale tables: " + ", ".join(
            f"{r.table_name} ({r.reason}{'' if r.value is None else f', {r.value:.1f} h'})" for r in bad))


def require_rows(table_name: str, rows: int) -> None:
    """Fail the run when a table wrote zero valid rows."""
    if rows == 0:
        raise GateError(f"{table_name}: zero rows written")


def require_no_divergence(report: DataFrame) -> None:
    bad = report.filter("exceeds").collect()
    if bad:
        raise GateError("; ".join(
            f"{r.table_name}: upper={r.upper_rows}, lower={r.lower_rows}, divergence={r.divergence:.1%}"
            for r in bad))


def require_compared(report: DataFrame) -> None:
    """Fail when a layer comparison had nothing to compare."""
    bad = report.filter("upper_rows IS NULL OR lower_rows IS NULL").collect()
    if bad:
        raise GateError("nothing to compare: " + ", ".join(
            f"{r.table_name} (upper={r.upper_rows}, lower={r.lower_rows})" for r in bad))


def publish_freshness_metric(spark, table_name: str, max_capture_ts: str | None, job_name: str,
                             metrics_path: str, reference_time: datetime = REFERENCE_TIME,
                             run_id: str | None = None) -> DataFrame | None:
    """Record one freshness point for ``table_name``; nothing when the raw log
    was empty (``max_capture_ts`` is None). Returns the recorded row."""
    if max_capture_ts is None:
        return None
    one = spark.createDataFrame([(table_name, max_capture_ts)], "table_name string, max_capture_ts string")
    m = freshness_metrics(one, environment_from_job_name(job_name), reference_time)
    record_metrics(m, metrics_path, run_id or uuid.uuid4().hex[:12])
    return m


def publish_row_count_metric(spark, table_name: str, row_count: int, job_name: str,
                             metrics_path: str, run_id: str | None = None) -> DataFrame:
    """Record one row-count point for ``table_name``. Returns the recorded row."""
    one = spark.createDataFrame([(table_name, int(row_count))], "table_name string, rows bigint")
    m = row_count_metrics(one, environment_from_job_name(job_name))
    record_metrics(m, metrics_path, run_id or uuid.uuid4().hex[:12])
    return m
