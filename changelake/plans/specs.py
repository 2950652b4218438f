"""The six Silver tables: key, projection, rules and partitioning of each.

A ``TableSpec`` is declarative; ``silver_frame`` turns a raw change log (plus
the live parent frames a fact needs) into the projected Silver rows *before*
validation. Nothing here triggers a Spark action.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ..functions.timefmt import calendar_days, month_of, year_of
from ..operators.cdc import reconcile
from ..operators.joins import attach_parent

# (live rows, live parents) -> Silver columns
Projector = Callable[..., DataFrame]


@dataclass(frozen=True)
class TableSpec:
    name: str                       # Silver table name
    source: str                     # raw change-log table it is built from
    keys: tuple[str, ...]           # primary key of the source
    project: Projector              # live rows (+ live parents) -> Silver columns
    rules: Mapping[str, str]        # validation rules, in report order
    partition_by: tuple[str, ...] = ()
    tie_breakers: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()   # source tables whose live rows `project` joins
    parent_columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    partition_date: str | None = None   # date (own or borrowed) whose year and month are `partition_by`
    project_borrowed: Callable[[DataFrame], DataFrame] | None = None   # `project` of rows that hold what they borrow

    def with_(self, **changes) -> TableSpec:
        return replace(self, **changes)


# ---- projections (fixed values: output columns and their order) -----------------------------------------------------------

def _dim_customer(live: DataFrame, _parents) -> DataFrame:
    return live.select("customer_id", "first_name", "last_name", "email", "country", "phone",
                       "signup_date")


def _dim_product(live: DataFrame, _parents) -> DataFrame:
    return live.select("product_id", "name", "category", "brand", "unit_price", "stock_qty")


def _fact_orders(live: DataFrame, _parents) -> DataFrame:
    return live.select("order_id", "customer_id", "order_date", "order_status",
                       year_of("order_date").alias("order_year"),
                       month_of("order_date").alias("order_month"))


def _fact_order_items(live: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    items = live.select("order_item_id", "order_id", "product_id", "quantity", "unit_price",
                        "line_total")
    return _dated_items(attach_parent(items, parents["orders"], on="order_id"))


def _dated_items(joined: DataFrame) -> DataFrame:
    return joined.select("order_item_id", "order_id", "product_id", "quantity", "unit_price",
                         "line_total",
                         year_of("order_date").alias("order_year"),
                         month_of("order_date").alias("order_month"))


def _fact_payments(live: DataFrame, _parents) -> DataFrame:
    return live.select("payment_id", "order_id", "method", "amount", "status", "payment_date",
                       year_of("payment_date").alias("payment_year"),
                       month_of("payment_date").alias("payment_month"))


def _fact_shipments(live: DataFrame, _parents) -> DataFrame:
    return live.select("shipment_id", "order_id", "carrier", "delivery_status", "shipped_date",
                       "delivered_date",
                       calendar_days("delivered_date", "shipped_date").alias("delivery_days"),
                       year_of("shipped_date").alias("shipped_year"),
                       month_of("shipped_date").alias("shipped_month"))


# ---- rules -----------------------------------------------------------------
# The validation rules of each Silver table (name: SQL text), in
# report order.

DIM_CUSTOMER_RULES = {
    "customer_id_not_null": "customer_id IS NOT NULL",
    "first_name_not_null": "first_name IS NOT NULL",
    "last_name_not_null": "last_name IS NOT NULL",
    "email_not_null": "email IS NOT NULL",
    "country_not_null": "country IS NOT NULL",
}

DIM_PRODUCT_RULES = {
    "product_id_not_null": "product_id IS NOT NULL",
    "name_not_null": "name IS NOT NULL",
    "category_not_null": "category IS NOT NULL",
    "brand_not_null": "brand IS NOT NULL",
    "unit_price_positive": "unit_price > 0",
    "stock_qty_non_negative": "stock_qty >= 0",
}

FACT_ORDERS_RULES = {
    "order_id_not_null": "order_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "order_date_not_null": "order_date IS NOT NULL",
    "order_status_not_null": "order_status IS NOT NULL",
}

FACT_ORDER_ITEMS_RULES = {
    "order_item_id_not_null": "order_item_id IS NOT NULL",
    "order_id_not_null": "order_id IS NOT NULL",
    "product_id_not_null": "product_id IS NOT NULL",
    "quantity_positive": "quantity > 0",
    "unit_price_positive": "unit_price > 0",
    "line_total_positive": "line_total > 0",
    "order_year_not_null": "order_year IS NOT NULL",
    "order_month_not_null": "order_month IS NOT NULL",
}

FACT_PAYMENTS_RULES = {
    "payment_id_not_null": "payment_id IS NOT NULL",
    "order_id_not_null": "order_id IS NOT NULL",
    "method_not_null": "method IS NOT NULL",
    "amount_positive": "amount > 0",
    "status_not_null": "status IS NOT NULL",
    "payment_date_not_null": "payment_date IS NOT NULL",
    "payment_year_not_null": "payment_year IS NOT NULL",
    "payment_month_not_null": "payment_month IS NOT NULL",
}

FACT_SHIPMENTS_RULES = {
    "shipment_id_not_null": "shipment_id IS NOT NULL",
    "order_id_not_null": "order_id IS NOT NULL",
    "carrier_not_null": "carrier IS NOT NULL",
    "delivery_status_not_null": "delivery_status IS NOT NULL",
    "shipped_date_not_null": "shipped_date IS NOT NULL",
    "shipped_year_not_null": "shipped_year IS NOT NULL",
    "shipped_month_not_null": "shipped_month IS NOT NULL",
    "delivery_days_non_negative": "delivery_days IS NULL OR delivery_days >= 0",
}

# ---- specs -----------------------------------------------------------------

SPECS: dict[str, TableSpec] = {
    "dim_customer": TableSpec("dim_customer", "customers", ("customer_id",), _dim_customer,
                              DIM_CUSTOMER_RULES),
    "dim_product": TableSpec("dim_product", "products", ("product_id",), _dim_product,
                             DIM_PRODUCT_RULES),
    # Order lines borrow the order's date, so ties of orders fall to it first:
    # then a scan of only that column finds the same winner as one of all.
    "fact_orders": TableSpec("fact_orders", "orders", ("order_id",), _fact_orders,
                             FACT_ORDERS_RULES, partition_by=("order_year", "order_month"),
                             tie_breakers=("order_date",), partition_date="order_date"),
    "fact_order_items": TableSpec("fact_order_items", "order_items", ("order_item_id",),
                                  _fact_order_items, FACT_ORDER_ITEMS_RULES,
                                  partition_by=("order_year", "order_month"),
                                  parents=("orders",),
                                  parent_columns={"orders": ("order_id", "order_date")},
                                  partition_date="order_date", project_borrowed=_dated_items),
    "fact_payments": TableSpec("fact_payments", "payments", ("payment_id",), _fact_payments,
                               FACT_PAYMENTS_RULES, partition_by=("payment_year", "payment_month"),
                               partition_date="payment_date"),
    "fact_shipments": TableSpec("fact_shipments", "shipments", ("shipment_id",), _fact_shipments,
                                FACT_SHIPMENTS_RULES,
                                partition_by=("shipped_year", "shipped_month"), partition_date="shipped_date"),
}

# The driver-derived item log repeats (order_id, line_number) across versions
# and has same-time ties; its key is composite and ties fall to the part and
# supplier ids (both descending).
FIXTURE_SPECS: dict[str, TableSpec] = dict(SPECS)
FIXTURE_SPECS["fact_order_items"] = SPECS["fact_order_items"].with_(
    keys=("order_id", "line_number"), tie_breakers=("product_id", "supplier_id"))

SILVER_TABLES = tuple(SPECS)


def live_parent(spec: TableSpec, parent: str, raw_parent: DataFrame,
                parent_spec: TableSpec | None = None, order_as: str = "string") -> DataFrame:
    """Live rows of a parent log, narrowed to the columns the child borrows.

    The newest version must be the one that the parent's own table keeps. Where
    the parent's ties fall to the borrowed columns first, rows that still tie
    agree on them, so the narrow ``select`` goes before the reconciliation and
    the scan reads only the capture columns, the key and the borrowed columns.
    Otherwise all columns are read, as the whole row decides.
    """
    cols = spec.parent_columns.get(parent)
    keys = parent_spec.keys if parent_spec else (cols[0],)
    ties = parent_spec.tie_breakers if parent_spec else ()
    raw = raw_parent
    if cols and set(cols) <= {*keys, *ties}:
        raw = raw_parent.select("Op", "_dms_timestamp", *dict.fromkeys((*keys, *ties, *cols)))
    live = reconcile(raw, keys, tie_breakers=ties, order_as=order_as)
    return live.select(*cols) if cols else live


def silver_frame(spec: TableSpec, raw: DataFrame, raw_parents: Mapping[str, DataFrame] | None = None,
                 parent_specs: Mapping[str, TableSpec] | None = None, *,
                 order_as: str = "string", null_keys: str = "group",
                 live_parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Raw change log -> projected Silver rows (before validation). Parents come
    as raw logs, or as ``live_parents`` that were reconciled before."""
    live = reconcile(raw, spec.keys, tie_breakers=spec.tie_breakers, order_as=order_as,
                     null_keys=null_keys)
    parents = dict(live_parents or {})
    by_source = {s.source: s for s in (parent_specs or {}).values()}
    for p in spec.parents:
        if p not in parents:
            parents[p] = live_parent(spec, p, (raw_parents or {})[p], by_source.get(p), order_as)
    return spec.project(live, parents)


__all__ = ["TableSpec", "SPECS", "FIXTURE_SPECS", "SILVER_TABLES", "silver_frame", "live_parent"]
