"""Gold layer: marts built from the written Silver tables.

Order of work: freshness gate on the latest recorded Silver metrics (a table
without a current point fails it), build every mart from the current Silver
versions, write them, then compare what each mart counted with the row count
that Silver published for the mart's table (layer divergence gate): a mart that
loses rows on the way is caught, and so is a count that is missing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DIVERGENCE_THRESHOLD, RunConfig
from ..sinks.parquet import read_metrics, read_table, write_silver
from . import marts
from .metrics import (LATEST_WINDOW_HOURS, ROW_COUNT_METRIC, latest_points, layer_divergence, require_compared,
                      require_fresh, require_no_divergence)

# Mart name -> (builder, Silver tables it reads). Every mart is a small
# aggregate; the product mart pre-aggregates items before its join.
MARTS = {
    "mart_revenue_by_month": (lambda t: marts.revenue_by_month(t["fact_payments"]), ("fact_payments",)),
    "mart_revenue_by_method": (lambda t: marts.revenue_by_method(t["fact_payments"]), ("fact_payments",)),
    "mart_failed_payment_rate": (lambda t: marts.failed_payment_rate(t["fact_payments"]), ("fact_payments",)),
    "mart_refunds_by_month": (lambda t: marts.refunds_by_month(t["fact_payments"]), ("fact_payments",)),
    "mart_delivery_days": (lambda t: marts.delivery_days_by_carrier(t["fact_shipments"]), ("fact_shipments",)),
    "mart_on_time_rate": (lambda t: marts.on_time_rate(t["fact_shipments"]), ("fact_shipments",)),
    "mart_delivery_failure": (lambda t: marts.delivery_failure_rate(t["fact_shipments"]), ("fact_shipments",)),
    "mart_fulfilment": (lambda t: marts.fulfilment_by_month(t["fact_shipments"]), ("fact_shipments",)),
    "mart_product_performance": (lambda t: marts.product_performance(t["fact_order_items"], t["dim_product"]),
                                 ("fact_order_items", "dim_product")),
    "mart_customer_acquisition": (lambda t: marts.customer_acquisition(t["dim_customer"]), ("dim_customer",)),
}


# Marts that count every row of a Silver table: mart -> (table, count column).
CONSERVED = {
    "mart_revenue_by_method": ("fact_payments", "payments"),
    "mart_failed_payment_rate": ("fact_payments", "payments"),
    "mart_delivery_days": ("fact_shipments", "shipments"),
    "mart_delivery_failure": ("fact_shipments", "shipments"),
    "mart_fulfilment": ("fact_shipments", "shipments"),
    "mart_product_performance": ("fact_order_items", "items"),
    "mart_customer_acquisition": ("dim_customer", "customers"),
}


def counted_by_marts(built: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name = mart, rows): Silver rows that each mart accounts for."""
    frames = [df.agg(F.coalesce(F.sum(CONSERVED[name][1]), F.lit(0)).cast("bigint").alias("rows"))
              .select(F.lit(name).alias("table_name"), "rows")
              for name, df in built.items() if name in CONSERVED]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def expected_by_marts(published: DataFrame, names) -> DataFrame:
    """(table_name = mart, rows): what Silver published for each mart's table."""
    spark = published.sparkSession
    pairs = spark.createDataFrame([(n, CONSERVED[n][0]) for n in names if n in CONSERVED],
                                  "mart string, table_name string")
    return (pairs.join(published.select("table_name", "rows"), "table_name", "left")
            .select(F.col("mart").alias("table_name"), "rows"))


def run_gold(spark: SparkSession, config: RunConfig, gold_root: str,
             marts_to_build: Mapping | None = None, check_fresh: bool = True,
             threshold: float = DIVERGENCE_THRESHOLD,
             window_hours: float | None = LATEST_WINDOW_HOURS) -> DataFrame:
    """Build and write the marts; return the divergence report. Raises on a
    stale, unknown or missing table and on a mart that differs from Silver by
    more than ``threshold``. Silver and Gold may run apart: the latest points
    recorded within ``window_hours`` count, whichever run recorded them."""
    if not config.metrics_path:
        raise ValueError("run_gold needs RunConfig.metrics_path (the Silver metrics table)")
    wanted = marts_to_build or MARTS
    needed = sorted({t for _, ts in wanted.values() for t in ts})
    latest = latest_points(read_metrics(spark, config.metrics_path, window_hours), config.environment, window_hours)
    if check_fresh:
        require_fresh(latest, config.stale_after_hours, required=needed)
    silver = {t: read_table(spark, config.paths.silver_table(t)) for t in needed}
    written = {}
    for name, (build, _) in wanted.items():
        path = f"{gold_root.rstrip('/')}/{name}"
        write_silver(build(silver), path)
        written[name] = read_table(spark, path)
    published = (latest.filter(F.col("metric_name") == ROW_COUNT_METRIC)
                 .select("table_name", F.col("value").cast("bigint").alias("rows")))
    report = layer_divergence(expected_by_marts(published, wanted), counted_by_marts(written), threshold)
    require_compared(report)
    require_no_divergence(report)
    return report
