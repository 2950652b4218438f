"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver runs each Spark query and the SQL text below side by side on the
same Parquet tables. Raw change logs are rebuilt from the driver tables with
the same rules as ``changelake.sources.fixtures``; everything after that is
plain SQL written independently of the Spark code.
"""

from __future__ import annotations


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


BRONZE_SQL = {
    "orders": f"""
select 'I' as Op, {_ts('o_orderdate')} as _dms_timestamp, cast(o_orderkey as int) as order_id, cast(o_custkey as int) as customer_id, o_orderdate as order_date,
  case o_orderstatus when 'F' then 'delivered' when 'O' then 'confirmed' else 'pending' end as order_status, o_orderdate as updated_at from orders
union all select 'U', {_ts('o_orderdate + interval 1 day')}, cast(o_orderkey as int), cast(o_custkey as int), o_orderdate, 'shipped', o_orderdate + interval 1 day from orders where o_orderkey % 3 = 0
union all select 'U', {_ts('o_orderdate + interval 2 day')}, cast(o_orderkey as int), cast(o_custkey as int), case when o_orderkey % 35 = 0 then null else o_orderdate end,
  case when o_orderkey % 50 = 0 then null when o_orderkey % 45 = 0 then 'misplaced' else 'delivered' end, o_orderdate + interval 2 day from orders where o_orderkey % 5 = 0
union all select 'D', {_ts('o_orderdate + interval 3 day')}, cast(o_orderkey as int), cast(o_custkey as int), o_orderdate, 'cancelled', o_orderdate + interval 3 day from orders where o_orderkey % 11 = 0""",
    "payments": f"""
select op as Op, {_ts('o_orderdate + lag * interval 1 day')} as _dms_timestamp, cast(o_orderkey as int) as payment_id, cast(o_orderkey as int) as order_id,
  case o_orderkey % 4 when 0 then 'credit_card' when 1 then 'debit_card' when 2 then 'paypal' else 'bank_transfer' end as method,
  case when o_orderkey % 43 = 0 then null when o_orderkey % 41 = 0 then cast(-o_totalprice as decimal(10,2)) else cast(o_totalprice as decimal(10,2)) end as amount,
  case when op = 'I' then 'pending' when o_orderkey % 10 = 0 then 'failed' when o_orderkey % 10 = 2 then 'refunded' else 'completed' end as status,
  o_orderdate as payment_date, o_orderdate + lag * interval 1 day as updated_at
from orders join (select 'I' as op, 0 as lag union all select 'U', 1) v on op = 'I' or o_orderkey % 2 = 0""",
    "shipments": f"""
select 'I' as Op, {_ts('o_orderdate + interval 1 day')} as _dms_timestamp, cast(o_orderkey as int) as shipment_id, cast(o_orderkey as int) as order_id,
  case o_orderkey % 5 when 0 then 'DHL' when 1 then 'FedEx' when 2 then 'UPS' when 3 then 'Royal Mail' else 'DPD' end as carrier,
  case when o_orderkey % 4 = 0 then 'in_transit' when o_orderkey % 13 = 0 then 'failed' else 'delivered' end as delivery_status,
  case when o_orderkey % 37 = 0 then null else o_orderdate + interval 1 day end as shipped_date,
  case when o_orderkey % 4 = 0 then null when o_orderkey % 9 = 0 then o_orderdate - interval 1 day else o_orderdate + (3 + o_orderkey % 7) * interval 1 day end as delivered_date,
  o_orderdate + interval 1 day as updated_at from orders""",
    "order_items": f"""
select case l_returnflag when 'R' then 'D' when 'N' then 'I' else 'U' end as Op, {_ts('l_shipdate')} as _dms_timestamp, cast(l_orderkey as int) as order_id, l_linenumber as line_number,
  cast(l_orderkey * 10 + l_linenumber as bigint) as order_item_id, cast(l_partkey as int) as product_id, cast(l_suppkey as int) as supplier_id,
  case when l_partkey % 71 = 0 then 0 else cast(l_quantity as int) end as quantity,
  cast(900 + l_partkey % 100 as decimal(10,2)) as unit_price,
  case when l_partkey % 73 = 0 then null else cast(cast(l_quantity as int) * (900 + l_partkey % 100) + case when l_orderkey % 89 = 0 then 1 else 0 end as decimal(10,2)) end as line_total,
  l_shipdate as updated_at from lineitem""",
    "products": f"""
select op as Op, {_ts("timestamp '2024-01-01 00:00:00' + lag * interval 1 day")} as _dms_timestamp, cast(p_partkey as int) as product_id, p_name as name, p_type as category,
  case when p_partkey % 31 = 0 then null else p_brand end as brand,
  case when p_partkey % 29 = 0 then null when p_partkey % 23 = 0 then cast(0 as decimal(10,2)) else cast(p_retailprice as decimal(10,2)) end as unit_price,
  case when op = 'U' then p_size - 5 else p_size end as stock_qty, timestamp '2024-01-01 00:00:00' + lag * interval 1 day as updated_at
from part join (select 'I' as op, 0 as lag union all select 'U', 1 union all select 'D', 2) v on op = 'I' or (op = 'U' and p_partkey % 2 = 0) or (op = 'D' and p_partkey % 19 = 0)""",
    "customers": f"""
select op as Op, {_ts("timestamp '2024-01-01 00:00:00' + (c_custkey % 365 + lag) * interval 1 day")} as _dms_timestamp, cast(c_custkey as int) as customer_id,
  substring(c_name, 1, 8) as first_name, substring(c_name, 10) as last_name,
  case when c_custkey % 13 = 0 then null else concat('c', cast(c_custkey as varchar), '@example.com') end as email,
  case when op = 'U' and c_custkey % 26 = 0 then null else n_name end as country, cast(null as varchar) as phone,
  timestamp '2024-01-01 00:00:00' + (c_custkey % 365) * interval 1 day as signup_date, timestamp '2024-01-01 00:00:00' + (c_custkey % 365 + lag) * interval 1 day as updated_at
from customer join nation on c_nationkey = n_nationkey join (select 'I' as op, 0 as lag union all select 'U', 400 union all select 'D', 800) v on op = 'I' or (op = 'U' and c_custkey % 2 = 0) or (op = 'D' and c_custkey % 17 = 0)""",
    "events": f"""
select case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as Op, {_ts('ts')} as _dms_timestamp, event_id, user_id, event_type, value from events""",
}

# Keys and tie breakers of each raw log as seen by the oracle.
KEYS = {
    "customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
    "order_items": ["order_id", "line_number"], "payments": ["payment_id"],
    "shipments": ["shipment_id"], "events": ["user_id"],
}
TIES = {"order_items": ["product_id desc nulls last", "supplier_id desc nulls last"]}

OP_RANK_SQL = "case Op when 'D' then 3 when 'U' then 2 when 'I' then 1 else 0 end"


def bronze_cte(source: str, name: str | None = None) -> str:
    return f"{name or 'bronze_' + source} as ({BRONZE_SQL[source]}\n)"


def latest_sql(source: str, from_name: str | None = None) -> str:
    """Newest row per key (deletes kept), capture columns kept."""
    frm = from_name or f"bronze_{source}"
    order = ", ".join(["_dms_timestamp desc nulls last", f"{OP_RANK_SQL} desc", *TIES.get(source, [])])
    part = ", ".join(KEYS[source])
    return (f"select * exclude (_rn) from (select *, row_number() over (partition by {part} "
            f"order by {order}) as _rn from {frm}) where _rn = 1")


def live_sql(source: str, from_name: str | None = None) -> str:
    """Live rows: newest per key, deletes dropped, capture columns dropped."""
    return (f"select * exclude (Op, _dms_timestamp) from ({latest_sql(source, from_name)}) "
            f"where Op <> 'D'")


# ---- Silver projections (before validation) --------------------------------

SILVER_SELECT = {
    "dim_customer": ("customers", "select customer_id, first_name, last_name, email, country, phone, signup_date from live_customers"),
    "dim_product": ("products", "select product_id, name, category, brand, unit_price, stock_qty from live_products"),
    "fact_orders": ("orders", "select order_id, customer_id, order_date, order_status, cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month from live_orders"),
    "fact_order_items": ("order_items", """select i.order_item_id, i.order_id, i.product_id, i.quantity, i.unit_price, i.line_total,
  cast(year(o.order_date) as int) as order_year, cast(month(o.order_date) as int) as order_month
  from live_order_items i left join live_orders o on i.order_id = o.order_id"""),
    "fact_payments": ("payments", "select payment_id, order_id, method, amount, status, payment_date, cast(year(payment_date) as int) as payment_year, cast(month(payment_date) as int) as payment_month from live_payments"),
    "fact_shipments": ("shipments", """select shipment_id, order_id, carrier, delivery_status, shipped_date, delivered_date,
  cast(date_diff('day', cast(shipped_date as date), cast(delivered_date as date)) as int) as delivery_days,
  cast(year(shipped_date) as int) as shipped_year, cast(month(shipped_date) as int) as shipped_month from live_shipments"""),
}


def table_ctes(tables, rules_by_table: dict | None = None) -> list[str]:
    """CTEs for the given Silver tables: ``bronze_<src>``, ``live_<src>`` (each
    once), ``silver_<table>`` and, when rules are given, ``annotated_<table>``."""
    seen, ctes = set(), []
    for table in tables:
        source, select = SILVER_SELECT[table]
        for s in [source] + (["orders"] if table == "fact_order_items" else []):
            if s not in seen:
                seen.add(s)
                ctes += [bronze_cte(s), f"live_{s} as ({live_sql(s)})"]
        ctes.append(f"silver_{table} as ({select})")
        if rules_by_table and table in rules_by_table:
            ctes.append(f"annotated_{table} as (select *, {errors_sql(rules_by_table[table])} "
                        f"as _validation_errors from silver_{table})")
    return ctes


def silver_ctes(table: str) -> str:
    """CTE list ending in ``silver_<table>`` (projected, not yet validated)."""
    return ",\n".join(table_ctes([table]))


def errors_sql(rules: dict[str, str]) -> str:
    """SQL for the comma-joined names of rules not TRUE (NULL when all pass)."""
    items = ", ".join(f"case when coalesce(({text}), false) then null else '{name}' end"
                      for name, text in rules.items())
    return f"nullif(concat_ws(', ', {items}), '')"


def annotated_ctes(table: str, rules: dict[str, str]) -> str:
    return ",\n".join(table_ctes([table], {table: rules}))
