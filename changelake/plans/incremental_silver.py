"""Silver tables kept up to date from new change files only.

A table's versions carry, beside the rows, what the next run needs:

* ``state``: the newest event of every key, deletes included, with all raw
  columns and what the row borrows from its parents, laid out in the partitions
  of the Silver table (months, or hash buckets where a table has none);
* ``quarantine``: the rows of the current state that fail a rule;
* ``files``: the change files that were taken in.

A run lists the raw folder, leaves out the files it knows (a file that was
delivered again with another size or time is new) and reads only the others.
Keys of the new events are looked up in the key columns of the state; this names
the partitions that hold them now, the winners name those they belong to, and
only these partitions are read whole and written anew. A key whose newest event
moved it to another month goes from the old one by the same step; an event that
is older than the state's loses to it, deletes included, so a late event never
revives a key. Rows, state, quarantine and file list are published in one
manifest: a run that dies leaves the version as it was and its files new, and
taking an event in twice changes nothing.

A child row also changes when its parent does. The parent's version that the
child has seen is in the child's manifest; the parent partitions that differ
since then say which parents changed, and their children take part as if they
had events. If the older parent version is gone, all children are looked at.

Deletes are kept in the state for good, or with ``forget_deletes_days`` until they
are that much older than the newest event, so that the state follows the live
keys. A later event that is older than this horizon and whose key the state does
not know could belong to a forgotten delete: it is set aside in the ``late``
section, never applied and never lost.

The result equals a full run over all files (tested after every batch). Work per
run: the new files, the key columns of the state, and the touched partitions.

A batch whose keys a task can hold takes its rows out of the state by broadcast.
A larger one is not stored on the way: its events and all rows of the touched
partitions are shuffled by key once (by the parent's key, if that is part of it,
which serves the join as well), and once more into the partitions of the state.
Rows and quarantine are written as the state is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructType

from ..config import RunConfig
from ..functions.timefmt import month_of, parse_capture_ts, year_of
from ..operators.cdc import drop_deleted, latest_per_key
from ..operators.joins import attach_parent, fits, measured, skew_split
from ..operators.quality import ERRORS_COL, annotate, invalid_rows, valid_rows
from ..schemas import CAPTURE_TS_COL, OP_COL, OP_DELETE, bronze_schema
from ..session import scratch_dir
from ..sinks import versions
from ..sinks.parquet import record_metrics, register_version, write_quarantine, write_silver
from ..sinks.versions import ROWS, Manifest, Section, delete_folder
from ..sources.bronze import check_layouts, list_files, read_bronze
from .metrics import freshness_metrics, require_rows, row_count_metrics
from .specs import SPECS, TableSpec

STATE, QUARANTINE, FILES, LATE = "state", "quarantine", "files", "late"
BUCKET = "_bucket"
FILES_SCHEMA = "path string, modified timestamp, bytes bigint"
#: File lists of so many runs are folded into one.
FILE_LISTS = 32


@dataclass
class IncrementalRun:
    table_name: str
    version: int
    files: int                  # taken in by this run
    raw_rows: int
    touched: list[str]          # partitions written
    partitions: int             # partitions of the table's state
    valid_rows: int             # of the whole table
    quarantined_rows: int


def partition_columns(spec: TableSpec) -> tuple[str, ...]:
    return spec.partition_by or (BUCKET,)


def _partition_values(spec: TableSpec, buckets: int) -> dict[str, Column]:
    if spec.partition_by:
        if spec.partition_date is None or len(spec.partition_by) != 2:
            raise ValueError(f"{spec.name}: partition_date must name the date of {spec.partition_by}")
        year, month = spec.partition_by
        return {year: year_of(spec.partition_date), month: month_of(spec.partition_date)}
    return {BUCKET: F.pmod(F.xxhash64(*spec.keys), F.lit(buckets)).cast("int")}


def _borrowed(spec: TableSpec, raw: StructType, parent_schemas: Mapping[str, StructType]) -> StructType:
    """Columns that a state row keeps from its parents."""
    fields = []
    for p in spec.parents:
        key, *cols = spec.parent_columns[p]
        for c in cols:
            if c in raw.names:
                raise ValueError(f"{spec.name}: {c} is a column of its own and of its parent {p}")
            fields.append(parent_schemas[p][c])
    return StructType(fields)


def state_schema(spec: TableSpec, raw: StructType, parent_schemas: Mapping[str, StructType]) -> StructType:
    out = StructType(list(raw.fields) + list(_borrowed(spec, raw, parent_schemas).fields))
    for c in partition_columns(spec):
        out = out.add(c, IntegerType())
    return out


def _null_key(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _same_key(a: str, b: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


class _Steps:
    """Intermediate tables of one run, in the shared folder, gone with it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_dir(spark, f"apply-{name}"), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.root}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{self.n}")

    def close(self) -> None:
        delete_folder(self.spark, self.root)


def new_files(spark: SparkSession, raw_path: str, root: str, base: Manifest | None) -> DataFrame:
    """Files under ``raw_path`` that no published version has taken in."""
    listed = list_files(spark, raw_path)
    taken = versions.read_section(spark, root, base.sections.get(FILES) if base else None,
                                  StructType.fromDDL(FILES_SCHEMA))
    return listed.join(taken, ["path", "modified", "bytes"], "left_anti")


def _parts_of(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """Partitions that rows belong to: a row per partition reaches the driver."""
    return {versions.part_name(columns, r) for r in df.select(*columns).distinct().collect()}


def live_parent_state(spark: SparkSession, spec: TableSpec, parent: str, root: str, version: Manifest,
                      schema: StructType, parts: Sequence[str] | None = None) -> DataFrame:
    """Borrowed columns of a parent's live rows, read from its published state:
    one row per key, reconciled once for the parent and all its children."""
    state = versions.read_section(spark, root, version.sections[STATE], schema, parts)
    return drop_deleted(state).select(*spec.parent_columns[parent])


def changed_parents(spark: SparkSession, spec: TableSpec, parent: str, root: str, seen: Manifest, now: Manifest,
                    schema: StructType) -> DataFrame:
    """Keys of the parents that look different to a child in version ``now`` than
    in ``seen``; only partitions whose folders differ are read."""
    key, *cols = spec.parent_columns[parent]
    before, after = seen.sections[STATE].folders, now.sections[STATE].folders
    parts = [p for p in {*before, *after} if before.get(p) != after.get(p)]
    old = live_parent_state(spark, spec, parent, root, seen, schema, parts)
    new = live_parent_state(spark, spec, parent, root, now, schema, parts)
    joined = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    differ = F.lit(False)
    for c in cols:
        differ = differ | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    return joined.where(differ).select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key)).where(
        F.col(key).isNotNull()).distinct()


def _merge(spec: TableSpec, events: DataFrame, held: DataFrame, null_keys: str, order_as: str) -> DataFrame:
    """Newest of the new events and the state's rows of the same keys."""
    return _newest_rows(spec, events.unionByName(held), null_keys, order_as)


def _newest_rows(spec: TableSpec, both: DataFrame, null_keys: str, order_as: str) -> DataFrame:
    """Newest row of every key."""
    if null_keys == "keep":
        # Rows without a key are rows of their own: all of them stay.
        none = _null_key(spec.keys)
        return latest_per_key(both.where(~none), spec.keys, tie_breakers=spec.tie_breakers,
                              order_as=order_as).unionByName(both.where(none))
    return latest_per_key(both, spec.keys, tie_breakers=spec.tie_breakers, order_as=order_as)


def apply_new_files(spark: SparkSession, spec: TableSpec, config: RunConfig, *,
                    raw_schemas: Mapping[str, StructType] | None = None,
                    parent_specs: Mapping[str, TableSpec] = SPECS, timestamp_type: DataType | None = None,
                    order_as: str = "string", null_keys: str = "group", check_schema: str = "error",
                    max_files: int = 10_000, buckets: int = 16, register: bool = False,
                    keep_versions: int = 4, forget_deletes_days: float | None = None) -> IncrementalRun | None:
    """Take in change files that no version of the Silver table has seen.

    At most ``max_files`` (oldest first) go into one version; runs are repeated
    until none is left, so the list that the driver holds is bounded and a long
    catch-up is published in steps. None if there was nothing to do. A parent's
    table must have been brought up to date the same way before.
    """
    done = None
    while True:
        step = _apply_once(spark, spec, config, raw_schemas, parent_specs, timestamp_type, order_as, null_keys,
                           check_schema, max_files, buckets, register, keep_versions, forget_deletes_days)
        if step is None:
            return done
        if done is not None:
            step.files, step.raw_rows = step.files + done.files, step.raw_rows + done.raw_rows
            step.touched = sorted({*step.touched, *done.touched})
        done = step


def apply_all(spark: SparkSession, config: RunConfig, specs: Mapping[str, TableSpec] = SPECS,
              **kw) -> dict[str, IncrementalRun | None]:
    """New files of every table of ``specs``, parents before their children."""
    done = {}
    for name in sorted(specs, key=lambda n: (len(specs[n].parents), not n.startswith("dim_"), n)):
        done[name] = apply_new_files(spark, specs[name], config, parent_specs=specs, **kw)
    return done


def _apply_once(spark, spec, config, raw_schemas, parent_specs, timestamp_type, order_as, null_keys, check_schema,
                max_files, buckets, register, keep_versions, forget_deletes_days) -> IncrementalRun | None:
    paths = config.paths
    root = paths.silver_table(spec.name)
    by_source = {s.source: s for s in parent_specs.values()}

    def schema_of(source: str) -> StructType:
        return (raw_schemas or {}).get(source) or bronze_schema(source, timestamp_type)

    raw = schema_of(spec.source)
    parent_schemas = {p: schema_of(p) for p in spec.parents}
    columns = partition_columns(spec)
    schema = state_schema(spec, raw, parent_schemas)
    base = versions.latest(spark, root)
    held = base.sections.get(STATE) if base else None      # None: first run, or a version of a full run
    how = {"order_as": order_as, "null_keys": null_keys, "buckets": buckets}
    if held is not None and base.facts["how"] != how:
        raise ValueError(f"{spec.name}: the state was built with {base.facts['how']}, not {how}")
    state = versions.read_section(spark, root, held, schema)

    parents: dict[str, tuple[str, Manifest, StructType]] = {}
    for p in spec.parents:
        parent_root = paths.silver_table(by_source[p].name)
        now = versions.latest(spark, parent_root)
        if now is None or STATE not in now.sections:
            raise ValueError(f"{spec.name}: apply {by_source[p].name} first")
        parents[p] = (parent_root, now, state_schema(by_source[p], parent_schemas[p], {}))
    seen = base.facts.get("parents", {}) if held is not None else {}
    moved = [p for p, (_, now, _) in parents.items() if held is not None and seen.get(p) != now.version]

    steps = _Steps(spark, spec.name)
    attempt = versions.new_attempt()
    try:
        base_files = base if held is not None else None
        taken = steps.put(new_files(spark, paths.bronze_table(spec.source), root, base_files)
                          .orderBy("modified", "path").limit(max_files))
        names = [r.path for r in taken.select("path").collect()]    # at most max_files
        if not names and not moved and held is not None:
            steps.close()
            return None
        raw_rows = check_layouts(spark, names, raw, check_schema, recursive=False) \
            if names and check_schema != "off" else None

        events = read_bronze(spark, names, raw, recursive=False) if names else spark.createDataFrame([], raw)
        if raw_rows is None:
            raw_rows = events.count()
        batch_max = events.agg(F.max(CAPTURE_TS_COL)).first()[0]
        horizon = base.facts.get("horizon") if held is not None else None
        has_key = ~_null_key(spec.keys) if null_keys == "keep" else F.lit(True)

        # Each key's newest event of the batch; a large batch is not stored once
        # more, its older events go when it is merged with the state.
        small = fits(events.select(*spec.keys))
        fresh = steps.put(_merge(spec, events, spark.createDataFrame([], raw), null_keys, order_as)) \
            if small or horizon is not None else events

        # The state's rows of these keys, found by key columns alone.
        wanted = fresh.select(*spec.keys).where(has_key)
        narrow = state.select(*spec.keys, *columns)
        hits = narrow.alias("s").join(F.broadcast(wanted.alias("w")) if small else wanted.alias("w"),
                                      _same_key("s", "w", spec.keys), "left_semi").select(*spec.keys, *columns)
        late = None
        if horizon is not None:
            hits = steps.put(hits)
            old_event = parse_capture_ts(CAPTURE_TS_COL) < F.lit(horizon).cast("timestamp_ntz")
            unknown = fresh.where(old_event).alias("f").join(
                hits.alias("h"), _same_key("f", "h", spec.keys), "left_anti")
            late = steps.put(unknown.where(has_key))
            fresh = steps.put(fresh.alias("f").join(late.alias("l"), _same_key("f", "l", spec.keys), "left_anti")
                              if null_keys == "group" else
                              fresh.where(_null_key(spec.keys)).unionByName(
                                  fresh.where(has_key).alias("f").join(
                                      late.alias("l"), _same_key("f", "l", spec.keys), "left_anti")))
            wanted = fresh.select(*spec.keys).where(has_key)
        for p in moved:
            parent_root, now, parent_schema = parents[p]
            was = versions.manifest(spark, parent_root, seen[p]) if p in seen else None
            key = spec.parent_columns[p][0]
            narrow = state.select(*spec.keys, *columns, key)
            if was is None or STATE not in was.sections:
                hits, small = hits.unionByName(narrow.select(*spec.keys, *columns)), False
            else:
                changed = steps.put(changed_parents(spark, spec, p, parent_root, was, now, parent_schema))
                small = fits(changed) and small
                hits = hits.unionByName(narrow.join(measured(spark, changed), key, "left_semi")
                                        .select(*spec.keys, *columns))
        if small:
            hits = steps.put(hits.distinct())
            all_keys = steps.put(wanted.unionByName(hits.select(*spec.keys)).distinct())
            small = fits(all_keys)
        touched = _parts_of(hits, columns)

        # Winners, with what they borrow from live parents now. Few keys take their
        # rows out of the touched partitions by broadcast; else all rows of these
        # partitions take part, so that none of them is shuffled to be set apart.
        newest = max((t for t in (base.facts.get("max_capture_ts") if held is not None else None, batch_max)
                      if t is not None), default=None)
        if forget_deletes_days is not None and newest is not None:
            horizon = _later(horizon, _days_before(spark, newest, forget_deletes_days))

        def remembered(rows: DataFrame) -> DataFrame:
            if forget_deletes_days is None or newest is None:
                return rows
            gone = (F.col(OP_COL) == OP_DELETE) & (parse_capture_ts(CAPTURE_TS_COL)
                                                   < F.lit(horizon).cast("timestamp_ntz"))
            return rows.where(~F.coalesce(gone, F.lit(False)))

        def write_state(rows: DataFrame, mode: str) -> None:
            write_silver(remembered(rows), versions.attempt_path(root, attempt, STATE), columns, mode)

        mine = versions.read_section(spark, root, held, schema, sorted(touched))
        if small:
            mine = mine.alias("s").join(F.broadcast(all_keys.alias("w")), _same_key("s", "w", spec.keys), "left_semi")
        mine = mine.select(*raw.names)
        live = {p: live_parent_state(spark, spec, p, parent_root, now, parent_schema)
                for p, (parent_root, now, parent_schema) in parents.items()}
        # A parent whose key is part of the row's own is joined to all candidates
        # of a large batch: the shuffle by the parent's key brings them together too.
        early = [p for p in parents if not small and spec.parent_columns[p][0] in spec.keys]
        winners = fresh.unionByName(mine) if names else mine
        for p in early:
            winners = attach_parent(winners, live[p], on=spec.parent_columns[p][0])
        if names:
            winners = _newest_rows(spec, winners, null_keys, order_as)
        for p in parents:
            if p in early:
                continue
            key = spec.parent_columns[p][0]
            if small:
                winners = steps.put(winners)
                need = measured(spark, steps.put(winners.select(key).distinct()))
                live[p] = live[p].join(need, key, "left_semi")
            winners = attach_parent(winners, live[p], on=key)
        winners = winners.withColumns(_partition_values(spec, buckets)).select(*schema.names)

        # Only the touched partitions are written anew.
        if small:
            winners = steps.put(winners)
            touched |= _parts_of(winners, columns)
            rest = versions.read_section(spark, root, held, schema, sorted(touched)).alias("s").join(
                F.broadcast(all_keys.alias("w")), _same_key("s", "w", spec.keys), "left_anti").select(*schema.names)
            write_state(rest.unionByName(winners), "overwrite")
        else:
            with skew_split(spark):
                write_state(winners, "overwrite")
            # Partitions that only new rows came to: the rows there have none of the keys.
            written = versions.written_section(spark, root, attempt, STATE, columns).folders
            joined = sorted(part for part in set(written) - touched if held is not None and part in held.folders)
            if joined:
                write_state(versions.read_section(spark, root, held, schema, joined), "append")
            touched |= set(written)
        parts = sorted(touched)
        # The state lies in the partitions of the rows and the quarantine, so these
        # are written as it is read, without a shuffle.
        state_now = versions.written_section(spark, root, attempt, STATE, columns, [])
        annotated = _annotated(spec, versions.read_section(spark, root, state_now, schema), buckets)
        for name, rows in ((ROWS, valid_rows(annotated)), (QUARANTINE, invalid_rows(annotated))):
            write_silver(rows, versions.attempt_path(root, attempt, name), columns, rebalance=False)
        taken.coalesce(1).write.parquet(versions.attempt_path(root, attempt, FILES))

        counts = dict(base.facts.get("counts", {})) if held is not None else {}
        for part in parts:
            counts.pop(part, None)
        counts.update(versions.count_by_part(annotated, columns, valid=F.count_if(F.col(ERRORS_COL).isNull()),
                                             invalid=F.count_if(F.col(ERRORS_COL).isNotNull())))
        valid_n, bad_n = (sum(c[k] for c in counts.values()) for k in ("valid", "invalid"))
        if config.fail_on_empty:
            require_rows(spec.name, valid_n)

        hidden = [BUCKET] if not spec.partition_by else []
        sections = {}
        for name in (ROWS, STATE, QUARANTINE):
            written = versions.written_section(spark, root, attempt, name, columns)
            kept = {} if held is None else {p: f for p, f in base.sections[name].folders.items() if p not in touched}
            sections[name] = Section(list(columns), {**kept, **written.folders}, hidden if name != STATE else [])
        number = (base.version if base else 0) + 1
        write_quarantine(invalid_rows(annotated).drop(BUCKET), paths.quarantine_table(spec.name),
                         f"{config.run_id}-v{number}")
        sections[FILES] = _file_lists(spark, root, attempt, base.sections.get(FILES) if held is not None else None)
        sections.update(_late_rows(spark, root, attempt, late, base.sections.get(LATE) if held is not None else None))
        version = versions.commit(spark, root, base, config.run_id, sections, {
            "how": how, "horizon": horizon, "counts": counts, "valid_rows": valid_n, "quarantined_rows": bad_n, "max_capture_ts": newest,
            "parents": {p: now.version for p, (_, now, _) in parents.items()}})
    except BaseException:
        versions.drop_attempt(spark, root, attempt)
        steps.close()
        raise
    steps.close()
    versions.vacuum(spark, root, keep_versions)
    small = spark.createDataFrame([(spec.name, newest, valid_n)],
                                  "table_name string, max_capture_ts string, rows bigint")
    if config.metrics_path:
        record_metrics(freshness_metrics(small, config.environment, config.reference_time).unionByName(
            row_count_metrics(small, config.environment)), config.metrics_path, config.run_id)
    if register:
        register_version(spark, spec.name, root, version, silver_schema(spec, schema))
    return IncrementalRun(spec.name, version.version, len(names), raw_rows, parts, len(counts), valid_n, bad_n)


def _annotated(spec: TableSpec, state: DataFrame, buckets: int) -> DataFrame:
    """Projected and checked rows of a state, with its partition columns. What
    was borrowed comes from the state, so no parent is joined again."""
    live = drop_deleted(state).drop(OP_COL, CAPTURE_TS_COL)
    rows = spec.project_borrowed(live) if spec.parents else spec.project(live, {})
    out = annotate(rows, spec.rules)
    return out if spec.partition_by else out.withColumns(_partition_values(spec, buckets))


def silver_schema(spec: TableSpec, state: StructType) -> StructType:
    """Columns and types of the Silver rows, partition columns last."""
    df = _annotated(spec, SparkSession.active().createDataFrame([], state), 1).drop(ERRORS_COL, BUCKET)
    parts = [f for f in df.schema.fields if f.name in spec.partition_by]
    return StructType([f for f in df.schema.fields if f.name not in spec.partition_by] + parts)


def _file_lists(spark: SparkSession, root: str, attempt: str, before: Section | None) -> Section:
    """The file lists of all versions; folded into one when there are many."""
    own = versions.written_section(spark, root, attempt, FILES).folders[""]
    lists = (before.folders.get("", []) if before else []) + own
    if len(lists) > FILE_LISTS:
        whole = versions.read_section(spark, root, Section([], {"": lists}), StructType.fromDDL(FILES_SCHEMA))
        folded = versions.new_attempt()
        whole.write.parquet(versions.attempt_path(root, folded, FILES))
        lists = versions.written_section(spark, root, folded, FILES).folders[""]
    return Section([], {"": lists})


def _days_before(spark: SparkSession, newest: str, days: float) -> str | None:
    at = parse_capture_ts(F.lit(newest)) - F.make_dt_interval(secs=F.lit(days * 86400).cast("decimal(18,6)"))
    return spark.range(1).select(at.cast("string")).first()[0]


def _later(a: str | None, b: str | None) -> str | None:
    return max((x for x in (a, b) if x is not None), default=None)


def _late_rows(spark: SparkSession, root: str, attempt: str, late: DataFrame | None,
               before: Section | None) -> dict[str, Section]:
    """Events set aside so far, if any."""
    folders = list(before.folders.get("", [])) if before else []
    if late is not None and late.limit(1).count():
        late.write.parquet(versions.attempt_path(root, attempt, LATE))
        folders += versions.written_section(spark, root, attempt, LATE).folders[""]
    return {LATE: Section([], {"": folders})} if folders else {}


def read_late(spark: SparkSession, root: str, raw: StructType) -> DataFrame:
    """Raw events that came after deletes of their time had been forgotten."""
    now = versions.latest(spark, root)
    return versions.read_section(spark, root, now.sections.get(LATE) if now else None, raw)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest version that fail a rule, with the rules' names."""
    now = versions.latest(spark, root)
    return versions.read_section(spark, root, now.sections.get(QUARANTINE) if now else None)
