"""Schema drift between an expected layout and what the files hold.

Statuses per column:
  ok        same type
  widened   file type is safely read as the expected one (int -> bigint, ...)
  retyped   file type differs and cannot be read as the expected type
  missing   expected column absent from the files (would read as NULL)
  extra     column in the files the layout does not list (ignored on read)

Only the column lists are compared on the driver -- their size is bounded by
the number of columns, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_INT_ORDER = [ByteType(), ShortType(), IntegerType(), LongType()]

DRIFT_SCHEMA = StructType([
    StructField("column_name", StringType()),
    StructField("expected_type", StringType()),
    StructField("actual_type", StringType()),
    StructField("status", StringType()),
    StructField("files", LongType()),
    StructField("rows", LongType()),
])


class DriftError(ValueError):
    def __init__(self, path: str, problems: list[dict]):
        super().__init__(f"schema drift in {path}: {problems}")
        self.problems = problems


def _readable_as(actual: DataType, expected: DataType) -> bool:
    if actual in _INT_ORDER and expected in _INT_ORDER:
        return _INT_ORDER.index(actual) <= _INT_ORDER.index(expected)
    # Zone-less and zoned timestamps are both read as instants.
    ts = (TimestampType(), TimestampNTZType())
    return actual in ts and expected in ts


def schema_drift_rows(expected: StructType, actual: StructType) -> list[dict]:
    actual_by_name = {f.name.lower(): f for f in actual.fields}
    expected_names = {f.name.lower() for f in expected.fields}
    rows = []
    for f in expected.fields:
        a = actual_by_name.get(f.name.lower())
        if a is None:
            status, atype = "missing", None
        elif a.dataType == f.dataType:
            status, atype = "ok", a.dataType.simpleString()
        elif _readable_as(a.dataType, f.dataType):
            status, atype = "widened", a.dataType.simpleString()
        else:
            status, atype = "retyped", a.dataType.simpleString()
        rows.append({"column_name": f.name, "expected_type": f.dataType.simpleString(),
                     "actual_type": atype, "status": status})
    for a in actual.fields:
        if a.name.lower() not in expected_names:
            rows.append({"column_name": a.name, "expected_type": None,
                         "actual_type": a.dataType.simpleString(), "status": "extra"})
    return rows


def schema_drift_frame(spark: SparkSession, drift: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in DRIFT_SCHEMA.fields) for r in drift], DRIFT_SCHEMA)
