"""A corpus from raw documents: toxic ones go, one of each group of near-duplicates stays,
benchmark passages are cut out, and what is left is encoded.

Each stage takes (spark, docs, sf_dir); its result is written and read again before the
next one. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm import decontaminate, simhash, toxicity
from subtide.llm.queries import bpe_digests, table
from subtide.llm.scratch import free_name, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7. Without labels of both kinds all stay."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each component; null, empty and blank texts are one."""
    return simhash.deduplicate(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of the benchmark's items, n_chars counted anew where a text was
    cut; a document that holds no other word goes."""
    was = free_name(docs, "__was")
    cleaned = decontaminate.remove_passages(docs.withColumn(was, F.xxhash64("text")), table(spark, sf_dir, "benchmark"))
    counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(F.xxhash64("text") == F.col(was), F.col("n_chars")).otherwise(counted)
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; a null text is empty."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("byte_bpe", encode),
]

#: Trained weights, XXH64 and BPE have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order over documents; the last one's rows. Null and empty texts
    count as one text, of which the least id stays; rows with null ids are kept like others;
    an empty table of documents, labels or benchmark items is no error."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
