"""Mix sources to target weights.

Sources in code-point order, null last, get the weights 3, 1, 2 in turn. They
share ``budget`` times all words by weight; a source's target stops at
``max_epochs`` times its own words and what it cannot take is shared anew by
weight among the others until no target is above its limit.

Within a source every document gets a hash-random key. Whole epochs are taken
in full; the rest of the target is cut by a prefix sum of the sizes in key
order. The prefix sum has two levels: the key range is cut into equal ranges
(hash keys are uniform, so equal ranges hold equal shares), sums per range are
added up over the ranges of a source, and only the rows inside one range are
sorted together. A hot source therefore spreads over many tasks. Documents stay
whole: one that would cross the cut is passed over, and documents that still
fit the gap are taken by further prefix sums until none fits.

Defined results: a null text has size 0; null source is one source; rows with
equal ids are ordered by their text's hash, then their row; an empty table
gives no rows. Extra columns are carried by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Stash, fresh, with_row

WEIGHTS = (3, 1, 2)


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, budget: float = 1.5, max_epochs: int = 2,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source.

    The source table has one row per source; numbering it takes one sorted
    pass over those rows. The water level is found by repeated sums of which
    only two numbers reach the driver.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.array(*[F.lit(x) for x in weights])
    per = Stash(spark, "mix-sources").put(
        per.withColumn("weight", F.get(w, nth % len(weights)).cast("bigint")))
    total, level = per.agg(F.sum("source_size")).first()[0] or 0, 0.0
    cap = F.col("source_size") * max_epochs
    while total:
        full = cap <= F.col("weight") * F.lit(level)
        capped, rest = per.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest:
            break
        higher = (budget * total - (capped or 0)) / rest
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("weight") * F.lit(float(level)), cap.cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, budget: float = 1.5, max_epochs: int = 2, seed: int = 17,
         range_rows: int = 2000, id_col: str = "doc_id") -> DataFrame:
    """(_row, doc_id, source, size, source_size, target, copies, taken)."""
    spark = docs.sparkSession
    stash = Stash(spark, "mix")
    base = with_row(docs).select(
        "_row", F.col(id_col).alias("doc_id"), "source", size_of().alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 2).alias("key"), F.xxhash64("text").alias("tie"))
    base = stash.put(base)
    n = base.count()
    ranges = max(1, math.ceil(n / range_rows))
    base = base.withColumn("rng", F.expr(f"key div {(1 << 62) // ranges + 1}L"))
    goal = stash.put(targets(base, budget, max_epochs))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    # Sources join null-safe; one source's rows may be a third of all, AQE splits them.
    same = base["source"].eqNullSafe(goal["source"])
    full = epochs.cast("bigint")
    left = goal.select("source", full.alias("epochs"),
                       (F.col("target") - full * F.col("source_size")).alias("gap"))

    chosen = None
    todo = base.select("_row", "doc_id", "source", "size", "key", "tie", "rng")
    while True:
        gaps = left.select(F.col("source").alias("s"), "gap")
        cand = (todo.join(gaps, todo["source"].eqNullSafe(gaps["s"])).drop("s")
                .where(F.col("size") <= F.col("gap")))
        cand = stash.put(cand)
        sums = cand.groupBy("source", "rng").agg(F.sum("size").alias("sum"))
        before = F.sum("sum").over(Window.partitionBy("source").orderBy("rng")) - F.col("sum")
        sums = sums.select(F.col("source").alias("s"), F.col("rng").alias("r"), before.alias("before"))
        ends = F.sum("size").over(Window.partitionBy("source", "rng")
                                  .orderBy("key", F.col("doc_id").asc_nulls_last(), "tie", "_row")
                                  .rowsBetween(Window.unboundedPreceding, 0))
        run = cand.withColumn("end", ends)
        run = run.join(sums, run["source"].eqNullSafe(sums["s"]) & (run["rng"] == sums["r"]))
        got = stash.put(run.where(F.col("before") + F.col("end") <= F.col("gap"))
                        .select("_row", "source", "size"))
        chosen = got.select("_row") if chosen is None else chosen.unionByName(got.select("_row"))
        if not got.where("size > 0").limit(1).count():
            break
        used = got.groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("used"))
        left = stash.put(left.join(used, left["source"].eqNullSafe(used["s"]), "left")
                         .select("source", "epochs", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")))
        todo = cand.drop("gap").join(got.select("_row"), "_row", "left_anti")

    out = base.join(goal.withColumnRenamed("source", "s"), base["source"].eqNullSafe(F.col("s"))).drop("s")
    out = out.join(chosen.withColumn("in_cut", F.lit(1)), "_row", "left")
    copies = epochs.cast("bigint") + F.coalesce("in_cut", F.lit(0))
    return out.select("_row", "doc_id", "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed documents: every row as often as its epochs say."""
    row, copies = fresh(docs, "_row"), fresh(docs, "_copies")
    wanted = plan(docs, **params).where("copies > 0").select(
        F.col("_row").alias(row), F.sequence(F.lit(1), F.col("copies").cast("int")).alias(copies))
    return (with_row(docs, row).join(wanted, row)
            .select(*docs.columns, F.explode(copies).alias(copies)).select(*docs.columns))
