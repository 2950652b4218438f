"""Registered queries: one per operator of the build plan.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame computed from the
driver tables (or data Spark derived from them and wrote to the shared
checkpoint folder); ``ORACLE[name]`` is the DuckDB SQL that must give the same
rows. Queries without an oracle entry (streaming, schema drift) are checked
against their batch equivalents in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from ..config import Paths, RunConfig
from ..functions import rules as R
from ..functions.schema_diff import schema_drift_frame
from ..operators import dq
from ..operators.cdc import latest_per_key, reconcile
from ..operators.joins import orphans
from ..operators.quality import ERRORS_COL, annotate, failure_counts, invalid_rows, replay, valid_rows
from ..schemas import CAPTURE_TS_COL, bronze_schema
from ..session import scratch_dir
from ..sinks.parquet import read_metrics, read_table
from ..sources import fixtures as fx
from ..sources.bronze import footer_drift, read_bronze
from ..streaming.incremental import compact, current_state, start_change_stream
from . import marts
from . import oracle_sql as O
from .gold_job import CONSERVED, counted_by_marts, expected_by_marts
from .incremental_silver import apply_new_files, read_quarantine
from .metrics import (divergence_report, freshness_metrics, layer_divergence, row_count_metrics, stale_alerts,
                      stale_tables)
from .replay_job import replay_into_silver
from .silver_job import run_table
from .specs import FIXTURE_SPECS, SILVER_TABLES, silver_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ENVIRONMENT = "dev"
NTZ = TimestampNTZType()
# The month read back through partition pruning, and the
# delivery target in days for the on-time rate.
ONE_MONTH = (1995, 6)
SLA_DAYS = 5


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---- shared building blocks -------------------------------------------------

def raw(spark, sf, source) -> DataFrame:
    return fx.bronze(spark, sf, source)


def _parent_columns(spec, parent: str) -> list[str]:
    pspec = next(s for s in FIXTURE_SPECS.values() if s.source == parent)
    cols = spec.parent_columns.get(parent, ())
    return list(dict.fromkeys(["Op", CAPTURE_TS_COL, *pspec.keys, *pspec.tie_breakers, *cols]))


def silver(spark, sf, table) -> DataFrame:
    spec = FIXTURE_SPECS[table]
    parents = {p: fx.bronze(spark, sf, p, _parent_columns(spec, p)) for p in spec.parents}
    return silver_frame(spec, raw(spark, sf, spec.source), parents, FIXTURE_SPECS)


def annotated(spark, sf, table) -> DataFrame:
    return annotate(silver(spark, sf, table), FIXTURE_SPECS[table].rules)


def valid(spark, sf, table) -> DataFrame:
    return valid_rows(annotated(spark, sf, table))


def quarantined(spark, sf, table) -> DataFrame:
    return invalid_rows(annotated(spark, sf, table))


def live(spark, sf, source) -> DataFrame:
    spec = next(s for s in FIXTURE_SPECS.values() if s.source == source)
    return reconcile(raw(spark, sf, source), spec.keys, tie_breakers=spec.tie_breakers)


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _live_ctes(*sources: str) -> list[str]:
    out = []
    for s in sources:
        out += [O.bronze_cte(s), f"live_{s} as ({O.live_sql(s)})"]
    return out


_RULES = {t: dict(s.rules) for t, s in FIXTURE_SPECS.items()}


def _ctes(tables, annotate_them: bool = True) -> str:
    return _with(*O.table_ctes(tables, _RULES if annotate_them else None))


def _ann(table: str) -> str:
    return _with(O.annotated_ctes(table, dict(FIXTURE_SPECS[table].rules)))


# ---- change-log reconciliation (W1, F1, F2, P1) -----------------------------

@register("cdc_latest", _with(O.bronze_cte("orders")) + O.latest_sql("orders"))
def cdc_latest(spark, sf):
    return latest_per_key(raw(spark, sf, "orders"), ["order_id"])


@register("cdc_reconcile", _with(O.bronze_cte("orders")) + O.live_sql("orders"))
def cdc_reconcile(spark, sf):
    return reconcile(raw(spark, sf, "orders"), "order_id")


@register("cdc_reconcile_composite", _with(O.bronze_cte("order_items")) + O.live_sql("order_items"))
def cdc_reconcile_composite(spark, sf):
    return reconcile(raw(spark, sf, "order_items"), ["order_id", "line_number"],
                     tie_breakers=["product_id", "supplier_id"])


@register("events_current_state", _with(O.bronze_cte("events")) + O.live_sql("events"))
def events_current_state(spark, sf):
    return reconcile(raw(spark, sf, "events"), "user_id")


# ---- Silver projections, validation and quarantine (P2-P4, J1, V1, F3-F6) ----

def _register_table_queries(table: str) -> None:
    register(f"silver_{table}", _with(O.silver_ctes(table)) + f"select * from silver_{table}")(
        lambda spark, sf: silver(spark, sf, table))
    register(f"validate_{table}",
             _ann(table) + f"select * exclude (_validation_errors) from annotated_{table} "
                           "where _validation_errors is null")(
        lambda spark, sf: valid(spark, sf, table))
    register(f"quarantine_{table}",
             _ann(table) + f"select * from annotated_{table} where _validation_errors is not null")(
        lambda spark, sf: quarantined(spark, sf, table))


for _t in SILVER_TABLES:
    _register_table_queries(_t)


@register("orphan_items", _with(*_live_ctes("order_items", "orders")) +
          "select * from live_order_items i where not exists "
          "(select 1 from live_orders o where o.order_id = i.order_id)")
def orphan_items(spark, sf):
    parents = live(spark, sf, "orders").select("order_id")
    return orphans(live(spark, sf, "order_items"), parents, "order_id")


_FACTS = [t for t in SILVER_TABLES if FIXTURE_SPECS[t].partition_by]


def _partition_guard_sql() -> str:
    parts = []
    for t in _FACTS:
        y, m = FIXTURE_SPECS[t].partition_by
        parts.append(
            f"select '{t}' as table_name, "
            f"count(*) filter (where _validation_errors is null and ({y} is null or {m} is null)) as valid_null_partition_rows, "
            f"count(*) filter (where _validation_errors is not null and ({y} is null or {m} is null)) as quarantined_null_partition_rows "
            f"from annotated_{t}")
    ctes = O.table_ctes(_FACTS, _RULES)
    return "with " + ",\n".join(ctes) + "\n" + "\nunion all\n".join(parts)


@register("partition_guard", _partition_guard_sql())
def partition_guard(spark, sf):
    frames = []
    for t in _FACTS:
        y, m = FIXTURE_SPECS[t].partition_by
        a = annotated(spark, sf, t)
        null_part = F.col(y).isNull() | F.col(m).isNull()
        frames.append(a.agg(
            F.count_if(F.col(ERRORS_COL).isNull() & null_part).alias("valid_null_partition_rows"),
            F.count_if(F.col(ERRORS_COL).isNotNull() & null_part).alias("quarantined_null_partition_rows"),
        ).select(F.lit(t).alias("table_name"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---- metrics and gates (A1, A2, M1-M3, M5, V2, K6) -------------------------

_SOURCES = [FIXTURE_SPECS[t].source for t in SILVER_TABLES]


@register("max_capture_ts", _with(*[O.bronze_cte(s) for s in _SOURCES]) + "\nunion all\n".join(
    f"select '{s}' as source_table, max(_dms_timestamp) as max_capture_ts, count(*) as raw_rows "
    f"from bronze_{s}" for s in _SOURCES))
def max_capture_ts(spark, sf):
    return _union_all([
        raw(spark, sf, s).agg(F.max(CAPTURE_TS_COL).alias("max_capture_ts"),
                              F.count(F.lit(1)).alias("raw_rows"))
        .select(F.lit(s).alias("source_table"), "*") for s in _SOURCES])


def _table_counts(spark, sf) -> DataFrame:
    return _union_all([
        annotated(spark, sf, t).agg(
            F.count(F.lit(1)).alias("live_rows"),
            F.count_if(F.col(ERRORS_COL).isNull()).alias("valid_rows"),
            F.count_if(F.col(ERRORS_COL).isNotNull()).alias("quarantined_rows"))
        .select(F.lit(t).alias("table_name"), "*") for t in SILVER_TABLES])


_COUNTS_SQL = "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as live_rows, "
    f"count(*) filter (where _validation_errors is null) as valid_rows, "
    f"count(*) filter (where _validation_errors is not null) as quarantined_rows from annotated_{t}"
    for t in SILVER_TABLES)


@register("row_counts", _ctes(SILVER_TABLES) + _COUNTS_SQL)
def row_counts(spark, sf):
    return _table_counts(spark, sf)


def _max_ts_by_table(spark, sf) -> DataFrame:
    return _union_all([
        raw(spark, sf, FIXTURE_SPECS[t].source).agg(F.max(CAPTURE_TS_COL).alias("max_capture_ts"))
        .select(F.lit(t).alias("table_name"), "max_capture_ts") for t in SILVER_TABLES])


def _freshness(spark, sf) -> DataFrame:
    m = freshness_metrics(_max_ts_by_table(spark, sf), ENVIRONMENT)
    return m.withColumn("value", F.round("value", 6))


_FRESHNESS_SQL = _with(*[O.bronze_cte(s) for s in _SOURCES]) + """, maxes as (
""" + "\nunion all\n".join(
    f"select '{t}' as table_name, max(_dms_timestamp) as max_capture_ts from bronze_{FIXTURE_SPECS[t].source}"
    for t in SILVER_TABLES) + """
), freshness as (
select 'changelake/freshness' as namespace, 'silver_data_age_hours' as metric_name, table_name,
  'dev' as environment,
  round((epoch_us(timestamp '2026-03-02 23:59:59') - epoch_us(cast(max_capture_ts as timestamp))) / 3.6e9, 6) as value,
  'Count' as unit
from maxes where max_capture_ts is not null)
"""


@register("metric_freshness", _FRESHNESS_SQL + "select * from freshness")
def metric_freshness(spark, sf):
    return _freshness(spark, sf)


@register("alert_stale", _FRESHNESS_SQL + "select * from freshness where value is null or value > 24")
def alert_stale(spark, sf):
    return stale_alerts(_freshness(spark, sf))


@register("metric_row_count", _ctes(SILVER_TABLES) + ", counts as (" + _COUNTS_SQL + ")\n"
          "select 'changelake/quality' as namespace, 'silver_row_count' as metric_name, table_name, "
          "'dev' as environment, cast(valid_rows as double) as value, 'Count' as unit from counts")
def metric_row_count(spark, sf):
    counts = _table_counts(spark, sf).select("table_name", F.col("valid_rows").alias("rows"))
    return row_count_metrics(counts, ENVIRONMENT)


@register("layer_divergence", _ctes(SILVER_TABLES) + ", counts as (" + _COUNTS_SQL + ")\n"
          "select table_name, valid_rows as upper_rows, live_rows as lower_rows, "
          "round(case when valid_rows > 0 then abs(valid_rows - live_rows) / valid_rows end, 6) as divergence, "
          "coalesce(abs(valid_rows - live_rows) / valid_rows > 0.05, false) as exceeds from counts")
def layer_divergence_q(spark, sf):
    # Both counts come from one pass, so nothing is joined or computed twice.
    c = _table_counts(spark, sf)
    rep = divergence_report(c.select("table_name", F.col("valid_rows").alias("upper_rows"),
                                     F.col("live_rows").alias("lower_rows")))
    return rep.withColumn("divergence", F.round("divergence", 6))


@register("quarantine_summary", _ctes(SILVER_TABLES) + "\nunion all\n".join(
    f"select '{t}' as table_name, rule_name, count(*) as failed_rows from "
    f"(select unnest(string_split(_validation_errors, ', ')) as rule_name from annotated_{t} "
    f"where _validation_errors is not null) group by rule_name" for t in SILVER_TABLES))
def quarantine_summary(spark, sf):
    return _union_all([failure_counts(quarantined(spark, sf, t))
                       .select(F.lit(t).alias("table_name"), "rule_name", "failed_rows")
                       for t in SILVER_TABLES])


# ---- data-quality checks (Q1-Q7) ---------------------------------------------

@register("dq_unique", _with(O.bronze_cte("order_items")) +
          "select order_id, line_number, count(*) as n from bronze_order_items "
          "group by order_id, line_number having count(*) > 1")
def dq_unique(spark, sf):
    return dq.duplicate_keys(raw(spark, sf, "order_items"), ["order_id", "line_number"])


_PAYMENT_COLS = ["payment_id", "order_id", "method", "amount", "status", "payment_date",
                 "payment_year", "payment_month"]


@register("dq_not_null", _ctes(["fact_payments"], False) + "\nunion all\n".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_rows "
    f"from silver_fact_payments" for c in _PAYMENT_COLS))
def dq_not_null(spark, sf):
    return dq.null_counts(silver(spark, sf, "fact_payments"), _PAYMENT_COLS)


@register("dq_foreign_key", _with(*_live_ctes("payments", "orders")) +
          "select distinct order_id from live_payments p where order_id is not null and not exists "
          "(select 1 from live_orders o where o.order_id = p.order_id)")
def dq_foreign_key(spark, sf):
    return dq.foreign_key_violations(live(spark, sf, "payments"), live(spark, sf, "orders"), "order_id")


@register("dq_line_total", _with(*_live_ctes("order_items")) +
          "select * from live_order_items where line_total <> round(quantity * unit_price, 2)")
def dq_line_total(spark, sf):
    return dq.rows_where(live(spark, sf, "order_items"),
                         "line_total <> round(quantity * unit_price, 2)")


@register("dq_one_per_parent", _with(*_live_ctes("payments", "orders")) + """
, counts as (select order_id, count(*) as n from live_payments where order_id is not null group by order_id)
select coalesce(o.order_id, c.order_id) as order_id, coalesce(c.n, 0) as n_children, o.order_id is not null as parent_exists
from live_orders o full outer join counts c on o.order_id = c.order_id
where coalesce(c.n, 0) <> 1 or o.order_id is null""")
def dq_one_per_parent(spark, sf):
    return dq.children_per_parent(live(spark, sf, "payments"), live(spark, sf, "orders"), "order_id")


@register("dq_conditional_child", _with(*_live_ctes("shipments", "orders")) + """
select s.*, o.order_status as parent_order_status from live_shipments s left join live_orders o on s.order_id = o.order_id
where not coalesce(o.order_status in ('shipped', 'delivered'), false)""")
def dq_conditional_child(spark, sf):
    return dq.conditional_child(live(spark, sf, "shipments"), live(spark, sf, "orders"),
                                "order_id", "order_status", ["shipped", "delivered"])


# Domain checks on the raw item log (name: violation when TRUE).
RANGE_CHECKS = {
    "op_domain": "Op IS NULL OR Op NOT IN ('I', 'U', 'D')",
    "quantity_range": "quantity IS NULL OR quantity NOT BETWEEN 1 AND 50",
    "unit_price_range": "unit_price IS NULL OR unit_price NOT BETWEEN 900 AND 999",
    "capture_ts_missing": "_dms_timestamp IS NULL",
}


@register("dq_range", _with(O.bronze_cte("order_items")) + "\nunion all\n".join(
    f"select '{name}' as check_name, count(*) filter (where coalesce({cond}, false)) as violations "
    f"from bronze_order_items" for name, cond in RANGE_CHECKS.items()))
def dq_range(spark, sf):
    return dq.violation_counts(raw(spark, sf, "order_items"), RANGE_CHECKS)


# ---- marts (G1-G11) --------------------------------------------------------

def _valid_sql(*tables: str) -> str:
    ctes = O.table_ctes(tables, _RULES)
    ctes += [f"valid_{t} as (select * exclude (_validation_errors) from annotated_{t} "
             f"where _validation_errors is null)" for t in tables]
    return _with(*ctes)


@register("mart_revenue_by_month", _valid_sql("fact_payments") + """
select payment_year, payment_month, cast(sum(amount) as decimal(38,2)) as revenue, count(*) as payments
from valid_fact_payments where status = 'completed' group by payment_year, payment_month""")
def mart_revenue_by_month(spark, sf):
    return marts.revenue_by_month(valid(spark, sf, "fact_payments"))


@register("mart_revenue_by_method", _valid_sql("fact_payments") + """
select method, count(*) as payments,
  cast(sum(case when status = 'completed' then amount end) as decimal(38,2)) as completed_revenue
from valid_fact_payments group by method""")
def mart_revenue_by_method(spark, sf):
    return marts.revenue_by_method(valid(spark, sf, "fact_payments"))


@register("mart_failed_payment_rate", _valid_sql("fact_payments") + """
select payment_year, payment_month, count(*) filter (where status = 'failed') as failed, count(*) as payments,
  round(cast(count(*) filter (where status = 'failed') as double) / count(*), 6) as failed_rate
from valid_fact_payments group by payment_year, payment_month""")
def mart_failed_payment_rate(spark, sf):
    return marts.failed_payment_rate(valid(spark, sf, "fact_payments"))


@register("mart_refunds_by_month", _valid_sql("fact_payments") + """
select payment_year, payment_month, cast(sum(amount) as decimal(38,2)) as refund_amount, count(*) as refunds
from valid_fact_payments where status = 'refunded' group by payment_year, payment_month""")
def mart_refunds_by_month(spark, sf):
    return marts.refunds_by_month(valid(spark, sf, "fact_payments"))


@register("mart_delivery_days", _valid_sql("fact_shipments") + """
select carrier, count(*) as shipments, count(delivery_days) as delivered,
  round(avg(delivery_days), 6) as avg_delivery_days
from valid_fact_shipments group by carrier""")
def mart_delivery_days(spark, sf):
    return marts.delivery_days_by_carrier(valid(spark, sf, "fact_shipments"))


@register("mart_on_time_rate", _valid_sql("fact_shipments") + f"""
select carrier, count(*) filter (where delivery_days <= {SLA_DAYS}) as on_time, count(delivery_days) as delivered,
  round(cast(count(*) filter (where delivery_days <= {SLA_DAYS}) as double) / nullif(count(delivery_days), 0), 6) as on_time_rate
from valid_fact_shipments group by carrier""")
def mart_on_time_rate(spark, sf):
    return marts.on_time_rate(valid(spark, sf, "fact_shipments"), SLA_DAYS)


@register("mart_delivery_failure", _valid_sql("fact_shipments") + """
select carrier, count(*) filter (where delivery_status in ('failed')) as failed, count(*) as shipments,
  round(cast(count(*) filter (where delivery_status in ('failed')) as double) / count(*), 6) as failure_rate
from valid_fact_shipments group by carrier""")
def mart_delivery_failure(spark, sf):
    return marts.delivery_failure_rate(valid(spark, sf, "fact_shipments"))


@register("mart_fulfilment", _valid_sql("fact_shipments") + """
select shipped_year, shipped_month, count(*) as shipments,
  count(*) filter (where delivery_status = 'delivered') as delivered
from valid_fact_shipments group by shipped_year, shipped_month""")
def mart_fulfilment(spark, sf):
    return marts.fulfilment_by_month(valid(spark, sf, "fact_shipments"))


@register("mart_product_performance", _valid_sql("fact_order_items", "dim_product") + """
, per_product as (select product_id, cast(sum(quantity) as bigint) as units,
  cast(sum(line_total) as decimal(38,2)) as revenue, count(*) as items, count(distinct order_id) as orders
  from valid_fact_order_items group by product_id)
select p.product_id, case when d.product_id is null then '(unknown product)' else d.name end as name,
  d.category, d.brand, p.units, p.revenue, p.items, p.orders
from per_product p left join valid_dim_product d on p.product_id = d.product_id""")
def mart_product_performance(spark, sf):
    return marts.product_performance(valid(spark, sf, "fact_order_items"),
                                     valid(spark, sf, "dim_product"))


@register("mart_customer_acquisition", _valid_sql("dim_customer") + """
select cast(year(signup_date) as int) as signup_year, cast(month(signup_date) as int) as signup_month,
  country, count(*) as customers
from valid_dim_customer group by 1, 2, 3""")
def mart_customer_acquisition(spark, sf):
    return marts.customer_acquisition(valid(spark, sf, "dim_customer"))


# ---- on-disk sources and sinks (S1-S3, K1-K3, G9) ---------------------------

def _write_raw(spark, sf, root: str, source: str) -> str:
    path = Paths.under(root).bronze_table(source)
    fx.write_change_log(raw(spark, sf, source), path, folders="month")
    return path


def _fixture_schema(source: str):
    extra = ([StructField("line_number", IntegerType()), StructField("supplier_id", IntegerType())]
             if source == "order_items" else None)
    return bronze_schema(source, NTZ, extra=extra)


def _run_to_disk(spark, sf, table: str) -> tuple[RunConfig, object]:
    """Lay the raw logs a table needs out on disk, then run its Silver job."""
    root = scratch_dir(spark, f"run-{table}")
    spec = FIXTURE_SPECS[table]
    for s in (spec.source, *spec.parents):
        _write_raw(spark, sf, root, s)
    cfg = RunConfig(Paths.under(root), environment=ENVIRONMENT)
    raws = {s: read_bronze(spark, cfg.paths.bronze_table(s), _fixture_schema(s))
            for s in (spec.source, *spec.parents)}
    result = run_table(spark, spec, cfg, raw=raws[spec.source],
                       raw_parents={p: raws[p] for p in spec.parents}, parent_specs=FIXTURE_SPECS)
    return cfg, result


@register("scan_typed", _with(O.bronze_cte("orders")) + "select * from bronze_orders")
def scan_typed(spark, sf):
    root = scratch_dir(spark, "scan")
    path = _write_raw(spark, sf, root, "orders")
    return read_bronze(spark, path, _fixture_schema("orders"))


@register("scan_recursive", _with(O.bronze_cte("order_items")) + O.live_sql("order_items"))
def scan_recursive(spark, sf):
    root = scratch_dir(spark, "scan")
    path = _write_raw(spark, sf, root, "order_items")
    spec = FIXTURE_SPECS["fact_order_items"]
    return reconcile(read_bronze(spark, path, _fixture_schema("order_items")), spec.keys,
                     tie_breakers=spec.tie_breakers)


@register("roundtrip_dim", _valid_sql("dim_customer") + "select * from valid_dim_customer")
def roundtrip_dim(spark, sf):
    _, res = _run_to_disk(spark, sf, "dim_customer")
    return read_table(spark, res.silver_path)


@register("roundtrip_fact", _valid_sql("fact_orders") + "select * from valid_fact_orders")
def roundtrip_fact(spark, sf):
    _, res = _run_to_disk(spark, sf, "fact_orders")
    return read_table(spark, res.silver_path)


@register("roundtrip_quarantine", _ann("fact_payments") +
          "select * from annotated_fact_payments where _validation_errors is not null")
def roundtrip_quarantine(spark, sf):
    cfg, res = _run_to_disk(spark, sf, "fact_payments")
    return read_table(spark, res.quarantine_path).filter(F.col("run_id") == cfg.run_id).drop("run_id")


@register("mart_items_one_month", _valid_sql("fact_order_items") +
          f"select * from valid_fact_order_items where order_year = {ONE_MONTH[0]} and order_month = {ONE_MONTH[1]}")
def mart_items_one_month(spark, sf):
    _, res = _run_to_disk(spark, sf, "fact_order_items")
    return marts.items_of_month(read_table(spark, res.silver_path), *ONE_MONTH)


# ---- extensions (X1-X4) ----------------------------------------------------

# The order statuses the source system knows.
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
_X1_RULES = dict(FIXTURE_SPECS["fact_orders"].rules)
_X1_RULES.update(R.rules(R.accepted_values("order_status", ORDER_STATUSES)))


@register("rule_accepted_values", _with(*O.table_ctes(["fact_orders"], {"fact_orders": _X1_RULES})) +
          "select * from annotated_fact_orders where _validation_errors is not null")
def rule_accepted_values(spark, sf):
    return invalid_rows(annotate(silver(spark, sf, "fact_orders"), _X1_RULES))


# A corrected payment rule set: refunds may carry negative amounts, only a
# missing or zero amount fails.
_X2_RULES = {k: v for k, v in FIXTURE_SPECS["fact_payments"].rules.items() if k != "amount_positive"}
_X2_RULES["amount_nonzero"] = "amount IS NOT NULL AND amount <> 0"


@register("quarantine_replay", _ann("fact_payments") + ", replayed as (select * exclude (_validation_errors) "
          "from annotated_fact_payments where _validation_errors is not null)\n"
          f"select *, {O.errors_sql(_X2_RULES)} as _validation_errors from replayed")
def quarantine_replay(spark, sf):
    ok, still_bad = replay(quarantined(spark, sf, "fact_payments"), _X2_RULES)
    return ok.withColumn(ERRORS_COL, F.lit(None).cast("string")).unionByName(still_bad)


# ---- incremental Silver (X3, S2, K1) and replay (X2) --------------------------

# Capture times at which the raw logs are cut into deliveries.
DELIVERY_CUTS = ("1994-01-01", "1996-07-01")


def _deliver(spark, sf, config: RunConfig, source: str, n: int, between: tuple[str, ...]) -> None:
    """Write the n-th delivery of a raw log: events captured between two cuts, and
    with the last one the first delivery's deletes once more (late and known)."""
    log, at = raw(spark, sf, source), F.col(CAPTURE_TS_COL)
    cuts = (None, *between, None)
    part = log
    if cuts[n] is not None:
        part = part.where(at >= cuts[n])
    if cuts[n + 1] is not None:
        part = part.where(at < cuts[n + 1])
    else:
        part = part.unionByName(log.where((at < cuts[1]) & (F.col("Op") == "D")))
    part.write.parquet(f"{config.paths.bronze_table(source)}/delivery{n}")


def _apply_deliveries(spark, sf, tables: list[str], between: tuple[str, ...] = DELIVERY_CUTS) -> RunConfig:
    """Deliver in steps; after each one every table takes in its new files. The
    order lines lag behind the orders, so lines also change with their orders."""
    cfg = RunConfig(Paths.under(scratch_dir(spark, "incremental")), environment=ENVIRONMENT)
    sources = [FIXTURE_SPECS[t].source for t in tables]
    schemas = {s: _fixture_schema(s) for s in sources}
    for n in range(len(between) + 1):
        for s in sources:
            _deliver(spark, sf, cfg, s, n, between)
            for t in tables:
                if FIXTURE_SPECS[t].source == s or (n and FIXTURE_SPECS[t].parents):
                    apply_new_files(spark, FIXTURE_SPECS[t], cfg, raw_schemas=schemas, parent_specs=FIXTURE_SPECS)
    return cfg


@register("incremental_fact_payments", _valid_sql("fact_payments") + "select * from valid_fact_payments")
def incremental_fact_payments(spark, sf):
    cfg = _apply_deliveries(spark, sf, ["fact_payments"])
    return read_table(spark, cfg.paths.silver_table("fact_payments"))


@register("incremental_fact_order_items", _valid_sql("fact_order_items") + "select * from valid_fact_order_items")
def incremental_fact_order_items(spark, sf):
    cfg = _apply_deliveries(spark, sf, ["fact_orders", "fact_order_items"], DELIVERY_CUTS[1:])
    return read_table(spark, cfg.paths.silver_table("fact_order_items"))


@register("incremental_quarantine", _ann("fact_orders") +
          "select * from annotated_fact_orders where _validation_errors is not null")
def incremental_quarantine(spark, sf):
    cfg = _apply_deliveries(spark, sf, ["fact_orders"], DELIVERY_CUTS[1:])
    return read_quarantine(spark, cfg.paths.silver_table("fact_orders"))


@register("silver_after_replay", _ann("fact_payments") + ", replayed as (select * exclude (_validation_errors), "
          f"{O.errors_sql(_X2_RULES)} as errors from annotated_fact_payments where _validation_errors is not null)\n"
          "select * exclude (_validation_errors) from annotated_fact_payments where _validation_errors is null\n"
          "union all select * exclude (errors) from replayed where errors is null")
def silver_after_replay(spark, sf):
    cfg, _ = _run_to_disk(spark, sf, "fact_payments")
    for _ in range(2):      # the second time nothing is left to publish
        replay_into_silver(spark, FIXTURE_SPECS["fact_payments"], cfg, _X2_RULES)
    return read_table(spark, cfg.paths.silver_table("fact_payments"))


@register("stream_current_state", _with(O.bronze_cte("events")) + O.live_sql("events"))
def stream_current_state(spark, sf):
    root = scratch_dir(spark, "stream")
    source = f"{root}/source"
    # Files hold events of all times: spread by event, so out of capture order.
    raw(spark, sf, "events").repartition("event_id").write.parquet(f"{source}/a")
    schema = spark.read.parquet(f"{source}/a").schema
    start_change_stream(spark, source, schema, ["user_id"], f"{root}/state").awaitTermination()
    compact(spark, f"{root}/state", ["user_id"])
    # The deletes are delivered once more, after the snapshot.
    raw(spark, sf, "events").filter("Op = 'D'").write.parquet(f"{source}/b")
    start_change_stream(spark, source, schema, ["user_id"], f"{root}/state").awaitTermination()
    return current_state(spark, f"{root}/state", ["user_id"])


# File layouts of the drift query: folder, share of the orders by key, change.
DRIFT_EXPECTED = StructType([f for f in bronze_schema("orders", NTZ).fields])
_DRIFT_OK = ("Op", "_dms_timestamp", "customer_id", "order_date", "updated_at")


def _drift_sql() -> str:
    types = {f.name: f.dataType.simpleString() for f in DRIFT_EXPECTED.fields}
    n = {k: f"(select count(*) from bronze_orders where order_id % 4 = {k})" for k in range(4)}
    every = "(select count(*) from bronze_orders)"
    rows = [(c, types[c], types[c], "ok", every) for c in _DRIFT_OK]
    rows += [("order_status", "string", "string", "ok", f"{every} - {n[1]}"),
             ("order_status", "string", None, "missing", n[1]),
             ("order_id", "int", "int", "ok", f"{every} - {n[2]}"),
             ("order_id", "int", "string", "retyped", n[2]),
             ("note", None, "string", "extra", n[3])]

    def q(v):
        return "cast(null as varchar)" if v is None else f"'{v}'"
    return "\nunion all\n".join(
        f"select {q(c)} as column_name, {q(e)} as expected_type, {q(a)} as actual_type, "
        f"{q(st)} as status, cast({r} as bigint) as rows"
        for c, e, a, st, r in rows)


@register("schema_drift", _with(O.bronze_cte("orders")) + _drift_sql())
def schema_drift(spark, sf):
    """Every file's footer against the declared layout, with the rows that drift:
    a quarter of the log complete, one without a column, one with a retyped
    column, one with an extra column. (File counts depend on the splits and are
    left out.)"""
    root = scratch_dir(spark, "drift")
    log = raw(spark, sf, "orders")
    changes = [lambda d: d, lambda d: d.drop("order_status"),
               lambda d: d.withColumn("order_id", F.col("order_id").cast(StringType())),
               lambda d: d.withColumn("note", F.lit("x"))]
    for k, change in enumerate(changes):
        change(log.filter(F.col("order_id") % 4 == k)).write.parquet(f"{root}/{k}")
    return schema_drift_frame(spark, footer_drift(spark, root, DRIFT_EXPECTED)).drop("files")


# ---- gates as reports (M3, M5, M6, K6, Q8) -----------------------------------

# A table that no metric was recorded for.
UNRECORDED = "fact_returns"


@register("gate_stale_tables", _FRESHNESS_SQL + f"""
select w.table_name, f.value, case when f.table_name is null then 'missing' when f.value is null then 'unknown age' else 'stale' end as reason
from (select unnest([{', '.join(repr(t) for t in (*SILVER_TABLES, UNRECORDED))}]) as table_name) w
left join freshness f on w.table_name = f.table_name
where f.table_name is null or f.value is null or f.value > 24""")
def gate_stale_tables(spark, sf):
    return stale_tables(_freshness(spark, sf), [*SILVER_TABLES, UNRECORDED])


def _conserved_sql() -> str:
    tables = sorted({t for t, _ in CONSERVED.values()})
    by = {"mart_revenue_by_method": "method", "mart_failed_payment_rate": "payment_year, payment_month",
          "mart_delivery_days": "carrier", "mart_delivery_failure": "carrier",
          "mart_fulfilment": "shipped_year, shipped_month", "mart_product_performance": "product_id",
          "mart_customer_acquisition": "year(signup_date), month(signup_date), country"}
    parts = [f"select '{m}' as table_name, (select count(*) from valid_{t}) as upper_rows, "
             f"(select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from valid_{t} group by {by[m]})) as lower_rows"
             for m, (t, _) in CONSERVED.items()]
    return (_valid_sql(*tables) + ", c as (" + "\nunion all\n".join(parts) + ")\n"
            "select table_name, upper_rows, lower_rows, "
            "round(case when upper_rows > 0 then abs(upper_rows - lower_rows) / upper_rows end, 6) as divergence, "
            "coalesce(abs(upper_rows - lower_rows) / upper_rows > 0.05, false) as exceeds from c")


@register("gold_vs_silver_counts", _conserved_sql())
def gold_vs_silver_counts(spark, sf):
    pay, ship = valid(spark, sf, "fact_payments"), valid(spark, sf, "fact_shipments")
    items, cust = valid(spark, sf, "fact_order_items"), valid(spark, sf, "dim_customer")
    frames = {"fact_payments": pay, "fact_shipments": ship, "fact_order_items": items, "dim_customer": cust}
    published = _union_all([f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
                            for t, f in frames.items()])
    built = {
        "mart_revenue_by_method": marts.revenue_by_method(pay),
        "mart_failed_payment_rate": marts.failed_payment_rate(pay),
        "mart_delivery_days": marts.delivery_days_by_carrier(ship),
        "mart_delivery_failure": marts.delivery_failure_rate(ship),
        "mart_fulfilment": marts.fulfilment_by_month(ship),
        "mart_product_performance": marts.product_performance(items, valid(spark, sf, "dim_product")),
        "mart_customer_acquisition": marts.customer_acquisition(cust),
    }
    rep = layer_divergence(expected_by_marts(published, built), counted_by_marts(built))
    return rep.withColumn("divergence", F.round("divergence", 6))


_METRICS_TABLE = "dim_product"


@register("roundtrip_metrics", _ctes([_METRICS_TABLE]) + f"""
select 'changelake/freshness' as namespace, 'silver_data_age_hours' as metric_name, '{_METRICS_TABLE}' as table_name, 'dev' as environment,
  round((epoch_us(timestamp '2026-03-02 23:59:59') - epoch_us(cast(max(_dms_timestamp) as timestamp))) / 3.6e9, 6) as value, 'Count' as unit
from bronze_products
union all
select 'changelake/quality', 'silver_row_count', '{_METRICS_TABLE}', 'dev',
  cast(count(*) filter (where _validation_errors is null) as double), 'Count' from annotated_{_METRICS_TABLE}""")
def roundtrip_metrics(spark, sf):
    """Metric rows of a run that was retried: written twice, there once."""
    root = scratch_dir(spark, "metrics")
    cfg = RunConfig(Paths.under(root), run_id="r1", environment=ENVIRONMENT, metrics_path=f"{root}/metrics")
    for _ in range(2):
        run_table(spark, FIXTURE_SPECS[_METRICS_TABLE], cfg, raw=raw(spark, sf, "products"),
                  parent_specs=FIXTURE_SPECS)
    return (read_metrics(spark, cfg.metrics_path).drop("recorded_at", "run_id")
            .withColumn("value", F.round("value", 6)))


# Smallest and largest row counts; the last two cannot hold.
EXPECTED_ROWS = {"dim_customer": (1, None), "dim_product": (1, 10_000_000_000),
                 "fact_orders": (None, 1), "fact_returns": (1, None)}


def _expected_sql() -> str:
    def n(v):
        return "cast(null as bigint)" if v is None else f"cast({v} as bigint)"
    want = " union all ".join(f"select '{t}' as table_name, {n(lo)} as min_rows, {n(hi)} as max_rows"
                              for t, (lo, hi) in EXPECTED_ROWS.items())
    return (_ctes(SILVER_TABLES) + ", counts as (" + _COUNTS_SQL + f"), want as ({want})\n"
            "select w.table_name, c.valid_rows as rows, w.min_rows, w.max_rows, "
            "c.valid_rows is not null and (w.min_rows is null or c.valid_rows >= w.min_rows) "
            "and (w.max_rows is null or c.valid_rows <= w.max_rows) as passed "
            "from want w left join counts c on w.table_name = c.table_name")


@register("row_count_expectations", _expected_sql())
def row_count_expectations(spark, sf):
    counts = _table_counts(spark, sf).select("table_name", F.col("valid_rows").alias("rows"))
    return dq.row_count_expectations(counts, EXPECTED_ROWS)
