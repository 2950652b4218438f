"""Writing Silver, quarantine and metric tables.

* Silver: partitioned facts are rebalanced on their partition columns first
  (``REBALANCE`` hint, which AQE sizes) so each task writes few partition
  folders -- without it every task may touch every month and the table fills
  with tiny files. NULL partition values are rejected upstream by validation
  rules, so no ``__HIVE_DEFAULT_PARTITION__`` folder appears. Versioned tables
  are in ``versions.py``; ``read_table`` reads either kind.
* Quarantine and metrics: every run writes its own ``run_id=...`` folder by plain
  overwrite, so a re-run replaces exactly its own rows, also when it has none.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType, TimestampType

from .versions import ROWS, Manifest, delete_folder, latest, read_section

RUN_ID_COL = "run_id"
DAY_COL = "recorded_on"

METRICS_SCHEMA = StructType([
    StructField("namespace", StringType()), StructField("metric_name", StringType()),
    StructField("table_name", StringType()), StructField("environment", StringType()),
    StructField("value", DoubleType()), StructField("unit", StringType()),
    StructField("recorded_at", TimestampType()), StructField(RUN_ID_COL, StringType()),
    StructField("part", StringType()), StructField(DAY_COL, DateType()),
])


def write_silver(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 mode: str = "overwrite", rebalance: bool = True) -> None:
    """``rebalance=False`` is for rows that are read from files laid out the same."""
    writer_df = df.hint("rebalance", *partition_by) if partition_by and rebalance else df
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_quarantine(df: DataFrame, path: str, run_id: str) -> None:
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN_ID_COL}={run_id}")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a written table back: a versioned one at its newest version. An
    empty partitioned table holds only ``_SUCCESS``; give the schema to read it
    as zero rows."""
    newest = latest(spark, path)
    if newest is not None:
        return read_section(spark, path, newest.sections.get(ROWS), schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


# ---- metrics -----------------------------------------------------------------

def record_metrics(df: DataFrame, path: str, run_id: str) -> None:
    """Metric rows of one run and table; a retry replaces them. They are laid out
    by the day they were recorded, so readers of recent points read few files."""
    spark = df.sparkSession
    base = path.rstrip("/")
    for name in [r[0] for r in df.select("metric_name").distinct().collect()]:  # a few per table
        one = df.filter(F.col("metric_name") == name).withColumn("recorded_at", F.current_timestamp())
        table, today, before = one.select("table_name", F.current_date().cast("string"),
                                          F.date_sub(F.current_date(), 1).cast("string")).first()
        part = f"{RUN_ID_COL}={run_id}/part={table}-{name}"
        one.drop(RUN_ID_COL).write.mode("overwrite").parquet(f"{base}/{DAY_COL}={today}/{part}")
        delete_folder(spark, f"{base}/{DAY_COL}={before}/{part}")   # a retry after midnight


def read_metrics(spark: SparkSession, path: str, within_hours: float | None = None) -> DataFrame:
    """Metric rows; with ``within_hours`` only the days that can hold points
    recorded since then, by a partition filter."""
    df = spark.read.schema(METRICS_SCHEMA).parquet(path)
    if within_hours is not None:
        df = df.filter(F.col(DAY_COL) >= F.date_sub(F.current_date(), int(within_hours // 24) + 1))
    return df.drop("part", DAY_COL)


# ---- catalog -----------------------------------------------------------------

def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_table(spark: SparkSession, name: str, path: str, schema: StructType | None = None,
                   partition_by: Sequence[str] = (), version: str = "0",
                   folders: Mapping[str, str] | None = None) -> None:
    """Catalog entry ``name`` for the table written at ``path``.

    The entry is a view on a table per version, replaced in one step, so readers
    always find one or the other. A version registered again at the same place is
    refreshed, never dropped under the view; at another place it gets a table of
    its own. The schema is given (or read from the files), so an empty
    partitioned table registers as well. ``folders`` (partition -> folder) says
    where partitions lie if not under ``path``.
    """
    schema = schema or spark.read.parquet(path).schema
    stem = f"{name}__{re.sub('[^0-9a-zA-Z]', '_', version).lower()}"
    known = [t.name for t in spark.catalog.listTables(pattern=f"{name}__*") if t.tableType != "VIEW"]
    place = f"`{stem}`"
    if stem in known and not _lies_at(spark, place, path):
        place = f"`{stem}_{uuid.uuid4().hex[:6]}`"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(map(_quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {place} ({columns}) USING parquet {parts} LOCATION {_text(path)}")
    for part, folder in (folders or {}).items():
        pairs = [x.split("=", 1) for x in part.split("/") if x]
        values = ", ".join(f"{_quoted(k)} = {_text(v)}" for k, v in pairs)
        spark.sql(f"ALTER TABLE {place} ADD IF NOT EXISTS PARTITION ({values}) LOCATION {_text(folder)}")
    if partition_by and folders is None:
        spark.sql(f"MSCK REPAIR TABLE {place}")
    spark.catalog.refreshTable(place)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {place}")
    for other in known:
        if other != place.strip("`"):
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(other)}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lies_at(spark: SparkSession, table: str, path: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    have, want = (fs_path(x).toUri().getPath() for x in (rows[0].data_type, path))
    return have == want


def register_version(spark: SparkSession, name: str, root: str, version: Manifest,
                     schema: StructType) -> None:
    """Catalog entry ``name`` for one version, whose partitions may lie in the
    folders of several attempts. Hidden partition columns cannot be left out of
    a partitioned table, so a table that has them registers as a view on its
    folders."""
    section = version.sections[ROWS]
    base = root.rstrip("/")
    if section.hidden:
        shown = ", ".join(map(_quoted, schema.names))
        sources = [f"SELECT {shown} FROM parquet.`{base}/{f}`" for fs in section.folders.values() for f in fs]
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in schema.fields)
        body = " UNION ALL ".join(sources) or f"SELECT {none} WHERE false"
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS {body}")
        return
    folders = {part: f"{base}/{f}" for part, fs in section.folders.items() for f in fs}
    at = folders.get("", f"{base}/_data")
    register_table(spark, name, at, schema, section.partition_by, version=str(version.version),
                   folders=folders if section.partition_by else None)
