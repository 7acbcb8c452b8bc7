"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input.

Rows go through a stage by (doc_id, CRC-32 of the text); rows of equal doc_id and text are the same document. Each stage
reads the columns doc_id and text, and all but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.bpe import bpe_decode, bpe_encode, load_vocabulary
from postlens.llm.common import kept_table
from postlens.llm.decontaminate import contaminated
from postlens.llm.minhash import minhash_groups
from postlens.llm.suffix_dedup import suffix_dedup
from postlens.llm.toxicity import toxicity

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but the rows of ``rejected`` (doc_id, tie)."""
    gone = rejected.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    tie = F.crc32(F.coalesce(docs.text, F.lit("")).cast("binary"))
    return docs.join(gone, docs.doc_id.eqNullSafe(F.col("__id")) & (tie == F.col("__tie")), "left_anti")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of more than 0.5 go. Without labels every document scores 0.5, and stays."""
    judged = toxicity(spark, docs, _table(spark, sf_dir, "labels"))
    return _without(docs, judged.where("score > 0.5"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at similarity 0.8 over 5-word shingles the one of the smallest doc_id stays
    (of several, or if all are null, that of the smallest CRC-32). Texts without words are never duplicates, but of rows of
    equal doc_id and text one stays."""
    judged = kept_table(spark, minhash_groups(spark, docs, size=5, per_cent=80), "judged")
    left = _without(docs, judged.where("NOT first"))
    repeated = judged.where("first").groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.limit(1).count() == 0:
        return left
    again = repeated.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"))
    tie = F.crc32(F.coalesce(left.text, F.lit("")).cast("binary"))
    some = left.join(again, left.doc_id.eqNullSafe(F.col("__id")) & (tie == F.col("__tie")), "left_semi")
    return _without(left, repeated).unionByName(some.dropDuplicates(["doc_id", "text"]))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes and more that stand earlier in the corpus go; each document stays, with what is left."""
    out = suffix_dedup(spark, docs).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (similarity 0.8 or more over 5-word shingles) go."""
    return _without(docs, contaminated(spark, docs, _table(spark, sf_dir, "benchmark")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, packed as little-endian unsigned 32-bit integers, their number, and the digests of the
    ids and of the bytes that they decode to."""
    vocabulary = load_vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    names = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    ids = bpe_encode(spark, docs.select(*names, "text"), vocabulary).select(*names, "ids")
    return bpe_decode(spark, ids, vocabulary).select(
        *names, "ids", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxic_filter),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

#: The model of the first stage and the ids of the last can't be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
