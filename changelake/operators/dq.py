"""Data-quality checks that report violations as DataFrames.

Each check is one distributed pass (an aggregate or a join); none collects
data. A clean table gives an empty report (or zero counts).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count ``n``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``column_name``, ``null_rows`` (one scan)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_rows")


def foreign_key_violations(child: DataFrame, parent: DataFrame, fk: str,
                           pk: str | None = None) -> DataFrame:
    """Distinct non-NULL child key values without a parent row."""
    pk = pk or fk
    keys = child.select(F.col(fk)).where(F.col(fk).isNotNull()).distinct()
    return keys.join(parent.select(F.col(pk).alias(fk)), on=fk, how="left_anti")


def rows_where(df: DataFrame, violation: Column | str) -> DataFrame:
    """Rows for which ``violation`` is TRUE."""
    cond = F.expr(violation) if isinstance(violation, str) else violation
    return df.filter(F.coalesce(cond, F.lit(False)))


def children_per_parent(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None,
                        expected: int = 1) -> DataFrame:
    """Parents whose child count differs from ``expected`` and children
    whose parent is missing: (key, ``n_children``, ``parent_exists``).

    Children are counted per key before the join (map-side partial counts), so
    only one row per key meets the parent side."""
    pk = pk or fk
    counts = (child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(pk))
              .agg(F.count(F.lit(1)).alias("n_children")))
    parents = parent.select(pk).withColumn("_parent", F.lit(True))
    j = parents.join(counts, on=pk, how="full_outer")
    out = j.select(pk, F.coalesce("n_children", F.lit(0)).alias("n_children"),
                   F.coalesce("_parent", F.lit(False)).alias("parent_exists"))
    return out.filter((F.col("n_children") != expected) | ~F.col("parent_exists"))


def conditional_child(child: DataFrame, parent: DataFrame, fk: str, parent_col: str,
                      allowed: Iterable, pk: str | None = None) -> DataFrame:
    """Child rows whose parent's ``parent_col`` is not in ``allowed`` (a
    missing parent counts as not allowed)."""
    pk = pk or fk
    p = parent.select(F.col(pk).alias(fk), F.col(parent_col).alias("_parent_value"))
    j = child.join(p, on=fk, how="left")
    ok = F.coalesce(F.col("_parent_value").isin(list(allowed)), F.lit(False))
    return j.filter(~ok).withColumnRenamed("_parent_value", f"parent_{parent_col}")


def violation_counts(df: DataFrame, checks: Mapping[str, Column | str]) -> DataFrame:
    """One row per named check with the number of violating rows (one scan)."""
    cols = []
    for name, cond in checks.items():
        c = F.expr(cond) if isinstance(cond, str) else cond
        cols.append(F.count_if(F.coalesce(c, F.lit(False))).alias(name))
    return df.agg(*cols).unpivot([], list(checks), "check_name", "violations")


def row_count_expectations(counts: DataFrame, expected: Mapping[str, tuple[int | None, int | None]],
                           name_col: str = "table_name", rows_col: str = "rows") -> DataFrame:
    """Check ``counts(table_name, rows)`` against ``{table: (min, max)}``
    (either bound may be None). One row per expected table with the verdict;
    a table missing from ``counts`` fails with NULL rows."""
    spark = counts.sparkSession
    exp = spark.createDataFrame([(t, lo, hi) for t, (lo, hi) in expected.items()],
                                f"{name_col} string, min_rows bigint, max_rows bigint")
    j = exp.join(counts.select(name_col, F.col(rows_col).alias("rows")), name_col, "left")
    ok = (F.col("rows").isNotNull()
          & (F.col("min_rows").isNull() | (F.col("rows") >= F.col("min_rows")))
          & (F.col("max_rows").isNull() | (F.col("rows") <= F.col("max_rows"))))
    return j.select(name_col, "rows", "min_rows", "max_rows", ok.alias("passed"))
