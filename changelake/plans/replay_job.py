"""Publishing quarantined rows that pass corrected rules.

The rows replayed are those of the very run that made the current version (its
``quarantine`` section, or for a full run the folder of its run id), so they are
the newest state of their keys as that version knows it. The merge is keyed all
the same: a row whose key is in Silver yields to the row there. What passes goes
to its partitions, which alone are written anew; what still fails stays in the
``quarantine`` section; what was published is kept in ``replayed`` with the run
that did it. All of it is one manifest on top of the version that was read, so a
newer version that appears meanwhile makes the replay fail instead of the replay
overwriting it. Doing it again finds nothing that passes and publishes nothing.

Runs after a replay should use the corrected rules: they check the rows anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import RunConfig
from ..operators.joins import measured
from ..operators.quality import ERRORS_COL, replay
from ..session import scratch_dir
from ..sinks import versions
from ..sinks.parquet import RUN_ID_COL, write_silver
from ..sinks.versions import ROWS, Manifest, Section, delete_folder
from .incremental_silver import QUARANTINE
from .specs import TableSpec

REPLAYED, REPLAYED_BY = "replayed", "replayed_by"


@dataclass
class ReplayRun:
    table_name: str
    version: int | None         # None: nothing passed, nothing was published
    published: int              # rows that went to Silver
    yielded: int                # rows whose key is there already
    still_failing: int
    touched: list[str]


def quarantine_of(spark: SparkSession, spec: TableSpec, config: RunConfig, now: Manifest) -> DataFrame | None:
    """The failing rows of the version ``now``."""
    root = config.paths.silver_table(spec.name)
    if QUARANTINE in now.sections:
        section = now.sections[QUARANTINE]
        return versions.read_section(spark, root, section) if section.folders else None
    path = f"{config.paths.quarantine_table(spec.name)}/{RUN_ID_COL}={now.run_id}"
    fs, p = versions.file_system(spark, path)
    return spark.read.parquet(path) if fs.exists(p) else None


def replay_into_silver(spark: SparkSession, spec: TableSpec, config: RunConfig, rules: Mapping,
                       keys: tuple[str, ...] | None = None) -> ReplayRun:
    """Check the current quarantine against ``rules`` and publish what passes.

    ``keys``: columns of the Silver rows that name a row (the spec's keys if
    they are all there)."""
    root = config.paths.silver_table(spec.name)
    now = versions.latest(spark, root)
    if now is None:
        raise ValueError(f"{spec.name}: nothing has been published yet")
    bad = quarantine_of(spark, spec, config, now)
    if bad is None:
        return ReplayRun(spec.name, None, 0, 0, 0, [])
    keys = keys or spec.keys
    if not set(keys) <= set(bad.columns):
        raise ValueError(f"{spec.name}: {keys} are not columns of its rows; name a key that is")
    rows = now.sections[ROWS]
    columns, hidden = rows.partition_by, rows.hidden
    work = scratch_dir(spark, f"replay-{spec.name}")
    attempt = versions.new_attempt()

    def step(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    try:
        ok, failing = replay(bad, rules)
        ok, failing = step("ok", ok.withColumns(_buckets(spec, now, hidden))), step("failing", failing)
        schema = StructType([f for f in ok.schema.fields])
        # Hidden partition columns are read as well here.
        whole = versions.read_section(spark, root, Section(columns, rows.folders), schema)
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        there = step("there", whole.select(*keys).alias("b").join(
            measured(spark, step("keys", ok.select(*keys).distinct())).alias("a"), same, "left_semi").distinct())
        fresh = step("fresh", ok.alias("a").join(measured(spark, there).alias("b"), same, "left_anti"))
        n, passing, failed = fresh.count(), ok.count(), failing.count()
        if not n:
            delete_folder(spark, work)
            return ReplayRun(spec.name, None, 0, passing, failed, [])
        touched = sorted(versions.part_name(columns, r) for r in fresh.select(*columns).distinct().collect()) \
            if columns else [""]
        old = versions.read_section(spark, root, Section(columns, rows.folders), schema, touched)
        write_silver(old.unionByName(fresh), versions.attempt_path(root, attempt), columns)
        held = now.sections.get(QUARANTINE) or Section()
        left = failing.withColumns(_buckets(spec, now, held.hidden))
        write_silver(left, versions.attempt_path(root, attempt, QUARANTINE), held.partition_by)
        (fresh.drop(*hidden).withColumn(REPLAYED_BY, F.lit(config.run_id))
         .write.parquet(versions.attempt_path(root, attempt, REPLAYED)))
        written = versions.written_section(spark, root, attempt, ROWS, columns)
        kept = {p: f for p, f in rows.folders.items() if p not in touched}
        before = now.sections[REPLAYED].folders[""] if REPLAYED in now.sections else []
        sections = {**now.sections,
                    ROWS: Section(columns, {**kept, **written.folders}, hidden),
                    QUARANTINE: versions.written_section(spark, root, attempt, QUARANTINE, held.partition_by, held.hidden),
                    REPLAYED: Section([], {"": before + versions.written_section(
                        spark, root, attempt, REPLAYED).folders[""]})}
        facts = {**now.facts, "valid_rows": (now.facts.get("valid_rows") or 0) + n, "quarantined_rows": failed}
        if "counts" in facts:
            facts["counts"] = _moved(facts["counts"], versions.count_by_part(fresh, columns, n=F.count("*")),
                                     versions.count_by_part(left, held.partition_by, n=F.count("*")))
        version = versions.commit(spark, root, now, now.run_id, sections, facts)
    except BaseException:
        versions.drop_attempt(spark, root, attempt)
        delete_folder(spark, work)
        raise
    delete_folder(spark, work)
    return ReplayRun(spec.name, version.version, n, passing - n, failed, touched)


def _moved(counts: Mapping, valid: Mapping, invalid: Mapping) -> dict:
    """Counts per partition after rows went from quarantine to Silver."""
    out = {part: {"valid": c["valid"], "invalid": invalid.get(part, {"n": 0})["n"]} for part, c in counts.items()}
    for part, c in valid.items():
        at = out.setdefault(part, {"valid": 0, "invalid": 0})
        at["valid"] += c["n"]
    return out


def _buckets(spec: TableSpec, now: Manifest, hidden) -> dict:
    """Hash buckets of a table that has no partitions of its own."""
    if not hidden:
        return {}
    buckets = now.facts["how"]["buckets"]
    return {hidden[0]: F.pmod(F.xxhash64(*spec.keys), F.lit(buckets)).cast("int")}


def read_replayed(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows that replays have published, with the run that did it."""
    now = versions.latest(spark, root)
    section = now.sections.get(REPLAYED) if now else None
    return versions.read_section(spark, root, section) if section else None
