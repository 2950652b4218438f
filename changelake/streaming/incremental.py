"""Incremental change apply with Structured Streaming.

New change files are picked up as they land; the newest event per key --
*tombstones included* -- is kept in Spark's fault-tolerant state store as a
streaming aggregate ``max(struct(recency..., row))``. Keeping deletes in state
is what stops a late, older event from resurrecting a deleted key; lateness is
resolved by comparing capture times, so no watermark ever drops an event.

Each micro-batch (output mode ``update``) emits the keys it touched with
their newest event; ``foreachBatch`` writes them to ``changes/batch_id=N``,
overwriting that folder, so a retried batch is idempotent. The current state
is the newest emitted row per key (highest batch id) minus deletes, which
equals the batch ``reconcile`` of the whole log.

``compact`` folds the batches so far into one snapshot, publishes it by a
pointer and removes what the pointer before it no longer needed: ``current_state`` reads the
snapshot and only the batches after it, so a read's cost follows the keys and the
batches since, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.timefmt import parse_capture_ts
from ..operators.cdc import drop_deleted, op_rank
from ..schemas import CAPTURE_TS_COL, OP_COL
from ..sinks.versions import delete_folder, folder_names, get_text, put_text

BATCH_COL = "batch_id"
_LATEST = "_latest"


def latest_event_aggregate(events: DataFrame, keys: Sequence[str], *,
                           ts_col: str = CAPTURE_TS_COL, op_col: str = OP_COL,
                           tie_breakers: Sequence[str] = (), order_as: str = "string") -> DataFrame:
    """Newest event per key as a (streaming or batch) aggregate.

    The struct compares field by field: capture time (as text, or parsed with
    ``order_as="timestamp"``), operation rank, tie breakers, whole row -- the
    same order as the batch window (NULLs compare lowest, i.e. lose, matching
    ``desc nulls last``)."""
    keys = list(keys)
    payload = [c for c in events.columns if c not in keys]
    if order_as not in ("string", "timestamp"):
        raise ValueError("order_as must be 'string' or 'timestamp'")
    ts = F.col(ts_col) if order_as == "string" else parse_capture_ts(ts_col)
    order = [ts.alias("_o_ts"), op_rank(op_col).alias("_o_op")]
    order += [F.col(t).alias(f"_o_tb{i}") for i, t in enumerate(tie_breakers)]
    packed = F.struct(*order, F.struct(*payload).alias("_row"))
    agg = events.groupBy(*keys).agg(F.max(packed).alias(_LATEST))
    return agg.select(*keys, *[F.col(f"{_LATEST}._row.{c}").alias(c) for c in payload])


def start_change_stream(spark: SparkSession, source_path: str, schema: StructType,
                        keys: Sequence[str], state_root: str, *,
                        tie_breakers: Sequence[str] = (), max_files_per_trigger: int | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        order_as: str = "string") -> StreamingQuery:
    """Start applying the change files under ``source_path`` to ``state_root``.

    ``available_now`` processes everything present and stops (batch-like
    scheduling with streaming state); otherwise runs continuously with
    ``processing_time`` triggers.
    """
    reader = (spark.readStream.schema(schema)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.parquet(source_path)
    latest = latest_event_aggregate(events, keys, tie_breakers=tie_breakers, order_as=order_as)
    changes_path = f"{state_root.rstrip('/')}/changes"

    def _write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path}/{BATCH_COL}={batch_id}")

    writer = (latest.writeStream.outputMode("update")
              .option("checkpointLocation", f"{state_root.rstrip('/')}/_checkpoint")
              .foreachBatch(_write_batch))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _newest_emitted(spark: SparkSession, state_root: str, keys: Sequence[str]) -> DataFrame:
    """Newest emitted row per key, deletes and ``batch_id`` kept: the snapshot
    and the batches after it. The batch filter prunes folders."""
    root = state_root.rstrip("/")
    upto = get_text(spark, f"{root}/snapshots/CURRENT")
    changes = spark.read.parquet(f"{root}/changes").withColumn(BATCH_COL, F.col(BATCH_COL).cast("bigint"))
    if upto is not None:
        kept = spark.read.parquet(f"{root}/snapshots/upto={upto}")
        changes = kept.unionByName(changes.filter(F.col(BATCH_COL) > int(upto)).select(*kept.columns))
    w = Window.partitionBy(*keys).orderBy(F.col(BATCH_COL).desc())
    return changes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def current_state(spark: SparkSession, state_root: str, keys: Sequence[str], *,
                  keep_capture_cols: bool = False, op_col: str = OP_COL,
                  ts_col: str = CAPTURE_TS_COL) -> DataFrame:
    """Live rows after all applied batches: newest emitted row per key (the
    state store already made it the newest event ever seen), deletes dropped."""
    live = drop_deleted(_newest_emitted(spark, state_root, keys).drop(BATCH_COL), op_col)
    return live if keep_capture_cols else live.drop(op_col, ts_col)


def compact(spark: SparkSession, state_root: str, keys: Sequence[str]) -> int | None:
    """Fold every batch emitted so far into one snapshot (tombstones kept) and
    return the last batch in it, or None without batches.

    The snapshot's folder is named after that batch, so doing it again writes
    the same; readers move over when the pointer is replaced. One generation
    stays for readers that have planned on the pointer before: the snapshot it
    named and the batches after it go with the next compaction.
    """
    root = state_root.rstrip("/")
    changes = spark.read.parquet(f"{root}/changes")
    upto = changes.agg(F.max(F.col(BATCH_COL).cast("bigint"))).first()[0]
    before = get_text(spark, f"{root}/snapshots/CURRENT")
    if upto is None or (before is not None and int(before) >= upto):
        return None if before is None else int(before)
    newest = _newest_emitted(spark, state_root, keys)
    newest.write.mode("overwrite").parquet(f"{root}/snapshots/upto={upto}")
    put_text(spark, f"{root}/snapshots/CURRENT", str(upto))
    if before is not None:
        for name in folder_names(spark, f"{root}/snapshots"):
            if name.startswith("upto=") and int(name[5:]) < int(before):
                delete_folder(spark, f"{root}/snapshots/{name}")
        for name in folder_names(spark, f"{root}/changes"):     # batches since the compaction before the last
            if name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) <= int(before):
                delete_folder(spark, f"{root}/changes/{name}")
    return upto
