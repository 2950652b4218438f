"""Gold-style summaries over the Silver tables.

Every mart is an aggregate over a fact, grouped by low-cardinality columns
(month, method, carrier, country), so partial aggregation on the map side
shrinks the shuffle to a few rows per task. Money stays decimal; rates and
averages are doubles rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sums of money are as wide as decimals go: summing decimal(28,2) values gives
# decimal(38,2), so no group can overflow a narrower cast.
WIDE_MONEY = "decimal(28,2)"
UNKNOWN_PRODUCT = "(unknown product)"


def _money_sum(col) -> F.Column:
    return F.sum((F.col(col) if isinstance(col, str) else col).cast(WIDE_MONEY))


def _rate(num, den) -> F.Column:
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), 6)


def revenue_by_month(payments: DataFrame) -> DataFrame:
    """Completed payments: revenue and count per payment month."""
    return (payments.filter(F.col("status") == "completed")
            .groupBy("payment_year", "payment_month")
            .agg(_money_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("payments")))


def revenue_by_method(payments: DataFrame) -> DataFrame:
    return (payments.groupBy("method")
            .agg(F.count(F.lit(1)).alias("payments"),
                 _money_sum(F.when(F.col("status") == "completed", F.col("amount")))
                 .alias("completed_revenue")))


def failed_payment_rate(payments: DataFrame) -> DataFrame:
    return (payments.groupBy("payment_year", "payment_month")
            .agg(F.count_if(F.col("status") == "failed").alias("failed"),
                 F.count(F.lit(1)).alias("payments"))
            .withColumn("failed_rate", _rate(F.col("failed"), F.col("payments"))))


def refunds_by_month(payments: DataFrame) -> DataFrame:
    return (payments.filter(F.col("status") == "refunded")
            .groupBy("payment_year", "payment_month")
            .agg(_money_sum("amount").alias("refund_amount"), F.count(F.lit(1)).alias("refunds")))


def delivery_days_by_carrier(shipments: DataFrame) -> DataFrame:
    return (shipments.groupBy("carrier")
            .agg(F.count(F.lit(1)).alias("shipments"),
                 F.count("delivery_days").alias("delivered"),
                 F.round(F.avg("delivery_days"), 6).alias("avg_delivery_days")))


def on_time_rate(shipments: DataFrame, sla_days: int = 5) -> DataFrame:
    """Share of delivered shipments that took at most ``sla_days``."""
    return (shipments.groupBy("carrier")
            .agg(F.count_if(F.col("delivery_days") <= sla_days).alias("on_time"),
                 F.count("delivery_days").alias("delivered"))
            .withColumn("on_time_rate", _rate(F.col("on_time"), F.col("delivered"))))


def delivery_failure_rate(shipments: DataFrame, failed_statuses: Iterable[str] = ("failed",)) -> DataFrame:
    return (shipments.groupBy("carrier")
            .agg(F.count_if(F.col("delivery_status").isin(list(failed_statuses))).alias("failed"),
                 F.count(F.lit(1)).alias("shipments"))
            .withColumn("failure_rate", _rate(F.col("failed"), F.col("shipments"))))


def fulfilment_by_month(shipments: DataFrame) -> DataFrame:
    return (shipments.groupBy("shipped_year", "shipped_month")
            .agg(F.count(F.lit(1)).alias("shipments"),
                 F.count_if(F.col("delivery_status") == "delivered").alias("delivered")))


def items_of_month(items: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one month; on a table partitioned by (order_year, order_month)
    the filter prunes folders at planning time."""
    return items.filter((F.col("order_year") == year) & (F.col("order_month") == month))


def product_performance(items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue, item rows and orders per product. Items are aggregated per
    product *before* the join, so the join sees one row per product. Items of a
    product that is not (or no longer) in the dimension stay, marked as unknown,
    so the mart's revenue is the fact table's."""
    per_product = (items.groupBy("product_id")
                   .agg(F.sum("quantity").cast("bigint").alias("units"),
                        _money_sum("line_total").alias("revenue"),
                        F.count(F.lit(1)).alias("items"),
                        F.count_distinct("order_id").alias("orders")))
    known = products.select("product_id", "name", "category", "brand", F.lit(True).alias("_known"))
    return (per_product.join(known, "product_id", "left")
            .select("product_id", F.when(F.col("_known"), F.col("name")).otherwise(UNKNOWN_PRODUCT).alias("name"),
                    "category", "brand", "units", "revenue", "items", "orders"))


def customer_acquisition(customers: DataFrame) -> DataFrame:
    return (customers.groupBy(F.year("signup_date").alias("signup_year"),
                              F.month("signup_date").alias("signup_month"), "country")
            .agg(F.count(F.lit(1)).alias("customers")))
