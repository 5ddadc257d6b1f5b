"""A training corpus from ``documents``: five stages of the corpus operators.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
as Parquet to the cluster's shared folder and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.llm import mixing, packing, quality_rules, simhash_dedup, suffix_dedup
from vocalis.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the line-frequency rule rejects go."""
    return quality_rules.quality_rules(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (the smallest doc_id)."""
    return simhash_dedup.keep_one(docs)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur elsewhere go; every row stays."""
    out = suffix_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece of a document, its ids included."""
    pieces = packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("suffix_dedup", repeated_text),
    ("mixing", mixture),
    ("packing", packed),
]

#: Hash signs, suffix groups, random rounding and tokens are beyond SQL; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last one's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
