"""Registered queries of the operators: thin contracts over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chunking, hilbert, langid, mixing, packing, pii, rabitq, simhash, suffixes, toxicity, turns, urls,
               whitening)
from .oracle_sql import ORACLE

#: Token ids come from this public vocabulary file.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages")).drop("_row")


def op2_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.links(_table(spark, sf_dir, "embeddings"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fp().alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))

    def of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    count = [of(kind) for kind in pii.PATTERNS]
    return found.select(
        "doc_id", *count, F.sha2(pii.joined_text(F.col("base")), 256).alias("base_sha256"),
        pii.joined_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    weights = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, keep=("doc_id",)).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.repeats(_table(spark, sf_dir, "documents")).drop("_row")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"),
                        "whitened", "explained", "identity_error")


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs)).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_urls": op1_urls,
    "op2_rabitq": op2_rabitq,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_chunking": op7_chunking,
    "op8_packing": op8_packing,
    "op9_hilbert": op9_hilbert,
    "op10_suffixes": op10_suffixes,
    "op11_whitening": op11_whitening,
    "op12_langid": op12_langid,
    "op13_turns": op13_turns,
}

__all__ = ["ORACLE", "QUERIES", "tokenizer_path"]
