"""Typed layouts of the raw change-log (Bronze) tables.

Every change row starts with two capture columns -- the operation code and the
capture time (a string, ``YYYY-MM-DD HH:MM:SS.ffffff``) -- followed by the
source table's columns. Files are always read under one of these schemas, never
inferred. Declared not-null flags are documentation only: Spark makes every
field read from files nullable, so the not-null promises are enforced by
validation rules instead.

``timestamp_type`` lets callers read the same layout with zone-less
timestamps (``TimestampNTZType``), which is how plain Parquet writers store them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

OP_COL = "Op"
CAPTURE_TS_COL = "_dms_timestamp"

# Operation codes written by the capture process.
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"

MONEY = DecimalType(10, 2)

# Column layout of the six source tables, in source order
# (name, type, declared not-null). "ts" stands for the timestamp type.
_LAYOUTS: dict[str, list[tuple[str, object, bool]]] = {
    "customers": [
        ("customer_id", IntegerType(), True),
        ("first_name", StringType(), True),
        ("last_name", StringType(), True),
        ("email", StringType(), True),
        ("country", StringType(), True),
        ("phone", StringType(), False),
        ("signup_date", "ts", True),
        ("updated_at", "ts", True),
    ],
    "products": [
        ("product_id", IntegerType(), True),
        ("name", StringType(), True),
        ("category", StringType(), True),
        ("brand", StringType(), True),
        ("unit_price", MONEY, True),
        ("stock_qty", IntegerType(), True),
        ("updated_at", "ts", True),
    ],
    "orders": [
        ("order_id", IntegerType(), True),
        ("customer_id", IntegerType(), True),
        ("order_date", "ts", True),
        ("order_status", StringType(), True),
        ("updated_at", "ts", True),
    ],
    "order_items": [
        # Wider than the source's int, which would overflow; int32 files read as well.
        ("order_item_id", LongType(), True),
        ("order_id", IntegerType(), True),
        ("product_id", IntegerType(), True),
        ("quantity", IntegerType(), True),
        ("unit_price", MONEY, True),
        ("line_total", MONEY, True),
        ("updated_at", "ts", True),
    ],
    "payments": [
        ("payment_id", IntegerType(), True),
        ("order_id", IntegerType(), True),
        ("method", StringType(), True),
        ("amount", MONEY, True),
        ("status", StringType(), True),
        ("payment_date", "ts", True),
        ("updated_at", "ts", True),
    ],
    "shipments": [
        ("shipment_id", IntegerType(), True),
        ("order_id", IntegerType(), True),
        ("carrier", StringType(), True),
        ("delivery_status", StringType(), True),
        ("shipped_date", "ts", False),
        ("delivered_date", "ts", False),
        ("updated_at", "ts", True),
    ],
}

SOURCE_TABLES = tuple(_LAYOUTS)


def capture_fields() -> list[StructField]:
    return [
        StructField(OP_COL, StringType(), nullable=True),
        StructField(CAPTURE_TS_COL, StringType(), nullable=True),
    ]


def bronze_schema(table: str, timestamp_type: DataType | None = None,
                  extra: list[StructField] | None = None) -> StructType:
    """Schema of one raw change-log table (capture columns first)."""
    ts_type = timestamp_type or TimestampType()
    try:
        layout = _LAYOUTS[table]
    except KeyError:
        raise KeyError(f"unknown source table {table!r}; known: {SOURCE_TABLES}") from None
    fields = capture_fields()
    for name, dtype, not_null in layout:
        fields.append(StructField(name, ts_type if dtype == "ts" else dtype, nullable=not not_null))
    return StructType(fields + list(extra or []))

