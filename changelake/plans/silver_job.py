"""One Silver table, end to end: read -> reconcile -> project -> validate ->
write valid rows and quarantine -> metrics.

Cost model: the raw log is scanned once. Its newest capture time and row count
are taken with ``observe`` on the way through the main plan (no separate
``max`` job); the valid/quarantined counts are read off the materialized frame,
one narrow column of it. The two writes share
one computation of the annotated frame, materialized one of two ways:

* ``materialize="table"`` (default): written once as a staging table under the
  shared ``spark.checkpoint.dir`` and read back for both writes. The lineage
  is cut there, so a lost executor never replays the scan and the window
  shuffle, and both outputs come from the same bytes.
* ``materialize="persist"``: cached (memory, spilling to disk) and released in
  ``finally``; cheaper for small tables, but lost blocks are recomputed from
  the lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..config import RunConfig
from ..operators.quality import ERRORS_COL, annotate, invalid_rows, valid_rows
from ..schemas import CAPTURE_TS_COL, bronze_schema
from ..session import checkpoint_root, scratch_dir
from ..sinks import versions
from ..sinks.parquet import record_metrics, register_table, register_version, write_quarantine, write_silver
from ..sinks.versions import ROWS, delete_folder
from ..sources.bronze import check_layouts, read_bronze
from .metrics import GateError, freshness_metrics, require_rows, row_count_metrics
from ..operators.joins import drop_stored, measured, store_bucketed, stored
from .specs import SPECS, TableSpec, live_parent, silver_frame


@dataclass
class TableRun:
    table_name: str
    silver_path: str
    quarantine_path: str
    raw_rows: int
    max_capture_ts: str | None
    valid_rows: int
    quarantined_rows: int
    metrics: DataFrame


def _observed(obs: Observation, rows_out: int) -> dict:
    """Observed values. Catalyst may prove an input empty and remove the
    observed plan altogether; only then is a missing observation no fault."""
    try:
        return obs.get
    except Exception:
        if rows_out:
            raise
        return {}


def _counts(annotated: DataFrame) -> tuple[int, int]:
    """(valid, quarantined) rows of a materialized annotated frame."""
    r = annotated.agg(F.count_if(F.col(ERRORS_COL).isNull()), F.count_if(F.col(ERRORS_COL).isNotNull())).first()
    return int(r[0]), int(r[1])


def run_table(spark: SparkSession, spec: TableSpec, config: RunConfig, *,
              raw: DataFrame | None = None, raw_parents: Mapping[str, DataFrame] | None = None,
              live_parents: Mapping[str, DataFrame] | None = None,
              parent_specs: Mapping[str, TableSpec] = SPECS, timestamp_type: DataType | None = None,
              order_as: str = "string", null_keys: str = "group",
              register: bool = False, materialize: str = "table", publish: str = "versioned",
              check_schema: str = "error", broadcast_parents_up_to: int | None = None) -> TableRun:
    """``broadcast_parents_up_to``: join a parent by broadcast if its live rows,
    stored and measured, take no more bytes than this.

    ``check_schema``: what to do when files that the job reads itself lack a
    column or hold one of another type (``error``, ``warn`` or ``off``). Their
    footers then also say how many raw rows there are.

    A versioned table is written and checked (``fail_on_empty``) before its
    version is published: a run that fails leaves the current version as it was.
    It fails with ``ConcurrentCommit`` if another run has published meanwhile.
    """
    paths = config.paths
    counted: dict[str, int] = {}

    def read(source: str) -> DataFrame:
        path, schema = paths.bronze_table(source), bronze_schema(source, timestamp_type)
        if check_schema != "off":
            counted[source] = check_layouts(spark, path, schema, check_schema)
        return read_bronze(spark, path, schema)

    table_root = paths.silver_table(spec.name)
    base = versions.latest(spark, table_root) if publish == "versioned" else None
    if raw is None:
        raw = read(spec.source)
    if raw_parents is None:
        raw_parents = {p: read(p) for p in spec.parents if p not in (live_parents or {})}

    if broadcast_parents_up_to is not None:
        by_source = {s.source: s for s in parent_specs.values()}
        live_parents = {p: measured(spark, stored((live_parents or {}).get(p) or live_parent(
            spec, p, raw_parents[p], by_source.get(p), order_as), f"live-{p}"), broadcast_parents_up_to)
            for p in spec.parents}

    tag = uuid.uuid4().hex[:8]
    raw_obs = Observation(f"raw_{spec.name}_{tag}")
    observed_raw = raw.observe(raw_obs, F.max(CAPTURE_TS_COL).alias("max_capture_ts"),
                               F.count(F.lit(1)).alias("raw_rows"))
    silver = silver_frame(spec, observed_raw, raw_parents, parent_specs, order_as=order_as,
                          null_keys=null_keys, live_parents=live_parents)
    annotated = annotate(silver, spec.rules)
    quarantine_path = paths.quarantine_table(spec.name)
    if publish == "overwrite":
        silver_path = paths.silver_table(spec.name)
    elif publish == "versioned":
        # Each attempt writes its own folder; readers see it once a manifest
        # names it, after the write and the gate.
        attempt = versions.new_attempt()
        silver_path = versions.attempt_path(table_root, attempt)
    else:
        raise ValueError("publish must be 'overwrite' or 'versioned'")
    if materialize == "table":
        # The staging copy belongs to this run alone and goes with it.
        stage_path = f"{checkpoint_root(spark)}/stage/{config.environment}/{config.run_id}/{spec.name}"
        try:
            annotated.write.mode("overwrite").parquet(stage_path)   # fills the observation
            staged = spark.read.schema(annotated.schema).parquet(stage_path)
            valid_n, bad_n = _counts(staged)
            write_quarantine(invalid_rows(staged), quarantine_path, config.run_id)
            write_silver(valid_rows(staged), silver_path, spec.partition_by)
        finally:
            delete_folder(spark, stage_path)
    elif materialize == "persist":
        cached = annotated.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid_n, bad_n = _counts(cached)   # fills the cache and the observation
            write_quarantine(invalid_rows(cached), quarantine_path, config.run_id)
            write_silver(valid_rows(cached), silver_path, spec.partition_by)
        finally:
            cached.unpersist()
    else:
        raise ValueError("materialize must be 'table' or 'persist'")
    # A task that Spark runs again may add its rows to the observed count twice;
    # the footers' count, the newest time and the counts of the outputs cannot
    # be affected.
    raw_stats = _observed(raw_obs, valid_n + bad_n)
    max_ts = raw_stats.get("max_capture_ts")
    small = spark.createDataFrame([(spec.name, max_ts, valid_n)],
                                  "table_name string, max_capture_ts string, rows bigint")
    metrics = freshness_metrics(small, config.environment, config.reference_time).unionByName(
        row_count_metrics(small, config.environment))
    if config.metrics_path:
        record_metrics(metrics, config.metrics_path, config.run_id)
    if config.fail_on_empty:
        try:
            require_rows(spec.name, valid_n)
        except GateError:
            if publish == "versioned":
                versions.drop_attempt(spark, table_root, attempt)
            raise
    schema = valid_rows(annotated).schema
    if publish == "versioned":
        section = versions.written_section(spark, table_root, attempt, ROWS, spec.partition_by)
        try:
            published = versions.commit(spark, table_root, base, config.run_id, {ROWS: section},
                                        {"valid_rows": valid_n, "quarantined_rows": bad_n, "max_capture_ts": max_ts})
        except versions.ConcurrentCommit:
            versions.drop_attempt(spark, table_root, attempt)
            raise
        versions.vacuum(spark, table_root)
        if register:
            register_version(spark, spec.name, table_root, published, schema)
    elif register:
        register_table(spark, spec.name, silver_path, schema, spec.partition_by, version=config.run_id)
    return TableRun(spec.name, silver_path, quarantine_path,
                    counted.get(spec.source, int(raw_stats.get("raw_rows", 0))), max_ts, valid_n, bad_n, metrics)


def run_all(spark: SparkSession, config: RunConfig, specs: Mapping[str, TableSpec] = SPECS,
            raws: Mapping[str, DataFrame] | None = None, parent_buckets: int | None = None,
            **kw) -> dict[str, TableRun]:
    """Every Silver table of ``specs`` (dimensions first).

    The live rows of a parent are computed once, narrowed to what children
    borrow, and stored; every child joins this snapshot without reconciling the
    parent again. ``parent_buckets`` stores it bucketed by its key, so that it is
    not shuffled either (as many buckets as shuffle partitions); the children of
    one hot parent are then one task's, as adaptive execution can split a skewed
    join only where both sides are shuffled. Without it the few bytes a parent
    are shuffled for each child table and a hot parent is split."""
    runs = {}
    by_source = {s.source: s for s in specs.values()}
    snapshots: dict[str, DataFrame] = {}
    drops = []
    try:
        for name in sorted(specs, key=lambda n: (not n.startswith("dim_"), n)):
            spec = specs[name]
            raw = raws.get(spec.source) if raws else None
            for p in spec.parents:
                if p not in snapshots:
                    snapshots[p], drop = live_snapshot(spark, spec, p, config, raws, by_source.get(p),
                                                       parent_buckets, **kw)
                    drops.append(drop)
            runs[name] = run_table(spark, spec, config, raw=raw, parent_specs=specs,
                                   live_parents={p: snapshots[p] for p in spec.parents}, **kw)
    finally:
        for drop in drops:
            drop()
    return runs


def live_snapshot(spark: SparkSession, spec: TableSpec, parent: str, config: RunConfig,
                  raws: Mapping[str, DataFrame] | None, parent_spec: TableSpec | None, buckets: int | None, *,
                  timestamp_type: DataType | None = None, order_as: str = "string",
                  **_) -> tuple[DataFrame, Callable[[], None]]:
    """A parent's live rows as its children borrow them, stored once; and what
    removes them again."""
    raw = raws[parent] if raws else read_bronze(spark, config.paths.bronze_table(parent),
                                                bronze_schema(parent, timestamp_type))
    live = live_parent(spec, parent, raw, parent_spec, order_as)
    if buckets:
        table, name = store_bucketed(live, spec.parent_columns[parent][0], buckets, f"live_{parent}")
        return table, lambda: drop_stored(spark, name)
    path = scratch_dir(spark, f"live-{parent}")
    live.write.parquet(path)
    return spark.read.schema(live.schema).parquet(path), lambda: delete_folder(spark, path)


def validate(df: DataFrame, rules, quarantine_path: str, table_name: str,
             run_id: str | None = None) -> DataFrame:
    """Split-and-quarantine in one call (``validate(df, rules, path, table)``).

    Writes the failing rows (with ``_validation_errors``) to
    ``{quarantine_path}/{table_name}`` under ``run_id=...`` and returns the
    valid rows. The annotated frame stays persisted so the caller's write of
    the returned rows does not recompute it; ``release(returned)`` frees it
    (``run_table`` manages all of this itself). With no rules the input is
    returned unchanged and nothing is written.
    """
    if not rules:
        return df
    annotated = annotate(df, rules).persist(StorageLevel.MEMORY_AND_DISK)
    run = run_id or uuid.uuid4().hex[:12]
    write_quarantine(invalid_rows(annotated), f"{quarantine_path.rstrip('/')}/{table_name}", run)
    out = valid_rows(annotated)
    out._cached_source = annotated
    return out


def release(validated: DataFrame) -> None:
    """Free the frame that ``validate`` keeps for the rows it returned."""
    cached = getattr(validated, "_cached_source", None)
    if cached is not None:
        cached.unpersist()
