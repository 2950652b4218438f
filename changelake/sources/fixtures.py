"""Change-log (Bronze) frames derived from the driver's TPC-H-style tables.

The driver tables carry no capture columns, so each raw log is derived from
them by a fixed rule: every source row yields one or more versions (insert,
updates, delete) whose capture times and values are functions of the row key
only, so every scale factor works and the DuckDB oracle can rebuild the same
rows from the same text.

Every derivation is one scan of its base table: the versions of a row are
built side by side as an array of structs and flattened with ``inline``,
instead of unioning several filtered scans of the same file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import capture_ts_string, plus_days

# Base instant of the synthetic product/customer change times.
BASE_TS = "2024-01-01 00:00:00"


def _base_ts() -> Column:
    return F.to_timestamp_ntz(F.lit(BASE_TS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``), split as its files are."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _versions(df: DataFrame, versions: list[tuple[Column | None, dict[str, Column]]],
              columns: list[str] | None = None) -> DataFrame:
    """Emit, per input row, one output row for each version whose condition
    holds (``None`` = always). All versions must list the same columns;
    ``columns`` narrows the output (Catalyst cannot prune fields out of the
    version structs, so a narrow caller says so here and the scan shrinks).

    Versions whose condition fails become NULL structs and are dropped by a
    plain filter after ``inline`` -- no lambda function, so the whole step
    stays inside one whole-stage-codegen span."""
    names = [n for n in versions[0][1] if columns is None or n in columns]
    structs = []
    for cond, cols in versions:
        s = F.struct(F.lit(True).alias("_keep"), *[cols[n].alias(n) for n in names])
        structs.append(s if cond is None else F.when(cond, s))
    return df.select(F.inline(F.array(*structs))).filter(F.col("_keep")).drop("_keep")


def bronze_orders(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k, od = F.col("o_orderkey"), F.col("o_orderdate")

    def version(op, lag, order_date, status):
        return {
            "Op": F.lit(op),
            "_dms_timestamp": capture_ts_string(plus_days(od, lag)),
            "order_id": k.cast("int"),
            "customer_id": F.col("o_custkey").cast("int"),
            "order_date": order_date,
            "order_status": status,
            "updated_at": plus_days(od, lag),
        }

    status0 = (F.when(F.col("o_orderstatus") == "F", "delivered")
               .when(F.col("o_orderstatus") == "O", "confirmed").otherwise("pending"))
    return _versions(o, [
        (None, version("I", 0, od, status0)),
        (k % 3 == 0, version("U", 1, od, F.lit("shipped"))),
        (k % 5 == 0, version("U", 2, F.when(k % 35 != 0, od),
                             F.when(k % 50 == 0, F.lit(None)).when(k % 45 == 0, "misplaced")
                             .otherwise("delivered"))),
        (k % 11 == 0, version("D", 3, od, F.lit("cancelled"))),
    ], columns)


def bronze_payments(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    k, od, price = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_totalprice")
    method = (F.when(k % 4 == 0, "credit_card").when(k % 4 == 1, "debit_card")
              .when(k % 4 == 2, "paypal").otherwise("bank_transfer"))
    amount = (F.when(k % 43 == 0, F.lit(None).cast("decimal(10,2)"))
              .when(k % 41 == 0, (-price).cast("decimal(10,2)"))
              .otherwise(price.cast("decimal(10,2)")))

    def version(op, lag):
        status = (F.lit("pending") if op == "I" else
                  F.when(k % 10 == 0, "failed").when(k % 10 == 2, "refunded").otherwise("completed"))
        return {
            "Op": F.lit(op),
            "_dms_timestamp": capture_ts_string(plus_days(od, lag)),
            "payment_id": k.cast("int"),
            "order_id": k.cast("int"),
            "method": method,
            "amount": amount,
            "status": status,
            "payment_date": od,
            "updated_at": plus_days(od, lag),
        }

    return _versions(o, [(None, version("I", 0)), (k % 2 == 0, version("U", 1))], columns)


def bronze_shipments(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k, od = F.col("o_orderkey"), F.col("o_orderdate")
    carrier = (F.when(k % 5 == 0, "DHL").when(k % 5 == 1, "FedEx").when(k % 5 == 2, "UPS")
               .when(k % 5 == 3, "Royal Mail").otherwise("DPD"))
    return o.select(
        F.lit("I").alias("Op"),
        capture_ts_string(plus_days(od, 1)).alias("_dms_timestamp"),
        k.cast("int").alias("shipment_id"),
        k.cast("int").alias("order_id"),
        carrier.alias("carrier"),
        F.when(k % 4 == 0, "in_transit").when(k % 13 == 0, "failed").otherwise("delivered")
        .alias("delivery_status"),
        F.when(k % 37 != 0, plus_days(od, 1)).alias("shipped_date"),
        F.when(k % 4 == 0, F.lit(None)).when(k % 9 == 0, plus_days(od, -1))
        .otherwise(plus_days(od, (F.lit(3) + k % 7).cast("int"))).alias("delivered_date"),
        plus_days(od, 1).alias("updated_at"),
    )


def bronze_order_items(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Natural change log: (order_id, line_number) repeats across versions."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    qty = F.col("l_quantity").cast("int")
    price_units = F.lit(900) + pk % 100
    return li.select(
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "N", "I")
        .otherwise("U").alias("Op"),
        capture_ts_string(F.col("l_shipdate")).alias("_dms_timestamp"),
        ok.cast("int").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        (ok * 10 + F.col("l_linenumber")).cast("bigint").alias("order_item_id"),
        pk.cast("int").alias("product_id"),
        F.col("l_suppkey").cast("int").alias("supplier_id"),
        F.when(pk % 71 == 0, F.lit(0)).otherwise(qty).alias("quantity"),
        price_units.cast("decimal(10,2)").alias("unit_price"),
        F.when(pk % 73 != 0,
               (qty * price_units + F.when(ok % 89 == 0, 1).otherwise(0)).cast("decimal(10,2)"))
        .alias("line_total"),
        F.col("l_shipdate").alias("updated_at"),
    )


def bronze_products(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    brand = F.when(k % 31 != 0, F.col("p_brand"))
    price = (F.when(k % 29 == 0, F.lit(None).cast("decimal(10,2)"))
             .when(k % 23 == 0, F.lit(0).cast("decimal(10,2)"))
             .otherwise(F.col("p_retailprice").cast("decimal(10,2)")))

    def version(op, lag):
        at = plus_days(_base_ts(), lag)
        return {
            "Op": F.lit(op),
            "_dms_timestamp": capture_ts_string(at),
            "product_id": k.cast("int"),
            "name": F.col("p_name"),
            "category": F.col("p_type"),
            "brand": brand,
            "unit_price": price,
            "stock_qty": F.col("p_size") - 5 if op == "U" else F.col("p_size"),
            "updated_at": at,
        }

    return _versions(p, [(None, version("I", 0)), (k % 2 == 0, version("U", 1)),
                         (k % 19 == 0, version("D", 2))], columns)


def bronze_customers(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has 25 rows at every scale; shuffling customers on 25 key values
    # would leave at most 25 tasks with rows.
    cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
    k = F.col("c_custkey")
    day0 = k % 365

    def version(op, lag):
        at = plus_days(_base_ts(), day0 + lag)
        country = F.col("n_name") if op != "U" else F.when(k % 26 != 0, F.col("n_name"))
        return {
            "Op": F.lit(op),
            "_dms_timestamp": capture_ts_string(at),
            "customer_id": k.cast("int"),
            "first_name": F.substr(F.col("c_name"), F.lit(1), F.lit(8)),
            "last_name": F.substr(F.col("c_name"), F.lit(10)),
            "email": F.when(k % 13 != 0, F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com"))),
            "country": country,
            "phone": F.lit(None).cast("string"),
            "signup_date": plus_days(_base_ts(), day0),
            "updated_at": at,
        }

    return _versions(cn, [(None, version("I", 0)), (k % 2 == 0, version("U", 400)),
                          (k % 17 == 0, version("D", 800))], columns)


def bronze_events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Stream-shaped log keyed by ``user_id`` (all capture times distinct)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
        .otherwise("U").alias("Op"),
        capture_ts_string(F.col("ts")).alias("_dms_timestamp"),
        "event_id", "user_id", "event_type", "value",
    )


BRONZE_BUILDERS = {
    "customers": bronze_customers,
    "products": bronze_products,
    "orders": bronze_orders,
    "order_items": bronze_order_items,
    "payments": bronze_payments,
    "shipments": bronze_shipments,
    "events": bronze_events,
}


def bronze(spark: SparkSession, sf_dir: str, source: str,
           columns: list[str] | None = None) -> DataFrame:
    """Raw change log of ``source``; ``columns`` narrows it (single-version
    logs are plain projections and prune either way)."""
    df = BRONZE_BUILDERS[source](spark, sf_dir, columns)
    return df.select(*columns) if columns else df


def write_change_log(df: DataFrame, root: str, *, date_col: str = "updated_at",
                     load_op: str = "I", folders: str = "day") -> None:
    """Lay a change log out on disk the way the capture process does: insert
    rows (``Op = load_op``) as full-load files at the top level, every other
    row in dated sub-folders by ``date_col`` (``folders``: ``day`` gives
    ``y=YYYY/m=MM/d=DD``, ``month`` gives ``y=YYYY/m=MM``). Rows are rebalanced
    on the folder columns first, so each folder receives few files instead of
    one per writing task. Used to build raw tables from derived logs."""
    is_load = F.col("Op") == F.lit(load_op)
    d = F.col(date_col)
    parts = {"y": F.date_format(d, "yyyy"), "m": F.date_format(d, "MM")}
    if folders == "day":
        parts["d"] = F.date_format(d, "dd")
    elif folders != "month":
        raise ValueError("folders must be 'day' or 'month'")
    df.filter(is_load).write.mode("overwrite").parquet(root)
    (df.filter(~is_load | F.col("Op").isNull())
       .withColumns(parts)
       .hint("rebalance", *parts)
       .write.mode("overwrite").partitionBy(*parts).parquet(f"{root}/cdc"))
