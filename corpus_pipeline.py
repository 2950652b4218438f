"""Corpus pipeline: five operators in a row over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame; it is written as Parquet and read again before
the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import mixing, packing, pii, simhash, toxicity
from changelake.llm.common import Stash, fresh
from changelake.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.train(docs, labels)
    score = fresh(docs, "score")
    return toxicity.score(docs, weights, name=score).where(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-equal fingerprints."""
    return simhash.keep_one(docs)


def clear_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it replaced in the texts;
    ``n_chars`` follows the text."""
    out = pii.sanitise(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text"))
                             .cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    packed = packing.pack_documents(docs, tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", clear_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is stored and read again."""
    stash = Stash(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stash.put(stage(spark, docs, sf_dir))
        stash.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
