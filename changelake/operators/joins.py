"""Child -> live parent joins.

No join forces a broadcast and none counts its parent to choose a plan. The
child shuffles on the join key; the parent side is already hash-partitioned on
it by its own reconciliation window. At run time AQE turns the join into a
broadcast when the parent's *measured* shuffle size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (bytes, 32 MB in library
sessions) and splits skewed child partitions, such as a parent with a third of
all children, into several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from ..session import scratch_dir
from ..sinks.versions import delete_folder

#: Bytes of a table that a task may hold whole.
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 16


def attach_parent(child: DataFrame, parent: DataFrame, on: str | Sequence[str],
                  broadcast_up_to: int | None = None) -> DataFrame:
    """Left outer join of child rows to their live parent row.

    ``broadcast_up_to`` asks for a broadcast of the parent if its rows, measured
    after they have been computed and stored, take no more than so many bytes;
    beyond the bound the stored parent is joined by a shuffle."""
    if broadcast_up_to is not None:
        parent = measured(child.sparkSession, stored(parent, "parent"), broadcast_up_to)
    return child.join(parent, on=on, how="left")


@contextmanager
def skew_split(spark: SparkSession) -> Iterator[None]:
    """Within it AQE splits a skewed join also where a later step relies on the
    join's partitioning: that step is shuffled anew then, and only then."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def store_bucketed(df: DataFrame, key: str, buckets: int, purpose: str = "live_parent") -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder, bucketed and sorted by ``key``:
    (the table, its catalog name). A join on the key reads it as it lies, without
    an exchange, for every child. Drop the name with ``drop_stored``."""
    path = scratch_dir(df.sparkSession, purpose)
    name = re.sub("[^0-9a-z]", "_", path.rsplit("/", 1)[1].lower())
    (df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name), name


def drop_stored(spark: SparkSession, name: str) -> None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").where("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    delete_folder(spark, rows[0].data_type)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(spark: SparkSession, df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table with a broadcast hint if its rows' bytes, added up from the
    values themselves and not estimated from files, are within the bound."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the bytes of a stored table's rows, added up, are within the bound."""
    sizes = [_bytes_of(f.name, f.dataType) for f in df.schema.fields]
    row = sizes[0]
    for s in sizes[1:]:
        row = row + s
    total = df.agg(F.sum(row + F.lit(_ROW_BYTES))).first()[0] or 0
    return total <= max_bytes


def _bytes_of(name: str, kind) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) + F.lit(8)
    if isinstance(kind, NumericType) or kind.typeName() in ("boolean", "date", "timestamp", "timestamp_ntz"):
        return F.lit(16 if kind.typeName() == "decimal" else 8)
    return F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))) + F.lit(8)


def orphans(child: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Child rows whose key has no live parent (NULL keys are orphans too)."""
    return child.join(parent, on=on, how="left_anti")
