"""Corpus pipeline: rules, near-duplicates, repeated passages, personal data, packing.

Every stage takes all rows that its predecessor left and returns the columns
of ``documents``; the last returns pieces of packed sequences.

Results on odd input: null and empty texts fail the rules and go; a null source
belongs to no host; of rows that repeat a text one stays, also where they repeat
an id or have none, and distinct texts under one id stay distinct; texts of any
length are read whole; columns beside those of ``documents`` are left out; empty
tables pass through every stage and give no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemelens.llm import minhash_dedup, packing, pii, quality_rules, suffix_dedup
from schemelens.llm.common import Scratch

#: Bytes of word parts that a worker keeps while it packs; earlier stages leave less room than packing alone has.
WORD_MEMORY = 16 << 20
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their base rules, or whose host fails, go."""
    return quality_rules.filter_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (0.8 of their five-word shingles) stays."""
    return minhash_dedup.deduplicate(docs.select(*COLUMNS), width=5)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that an earlier document has are cut out of the later ones."""
    return _documents(suffix_dedup.remove_repeats(docs.select(*COLUMNS)))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by marks."""
    return _documents(pii.redact(docs.select(*COLUMNS)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), memory=WORD_MEMORY)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("private", private),
          ("packed", packed)]

#: SQL has no tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
