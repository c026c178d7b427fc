"""Corpus pipeline: documents to training tokens.

Five stages, each calling one operator of ``quarry.llm``; each is written as
Parquet in the cluster's shared folder and read back as the next one's input,
so a lost executor costs at most one stage. All stages but the last return
the columns of ``documents`` as they are.

1. language: documents whose language cannot be told go (no letter, or a
   score under ``op04_language.MIN_SCORE``, which four languages or fewer do
   not reach: with the tables' languages only texts without a letter go).
2. exact_dedup: of equal texts (lower-cased A-Z) the largest doc_id stays.
3. near_dedup: of each group linked by 5-word shingles with similarity 0.8
   and more the smallest doc_id stays.
4. decontaminate: documents of which at least one word in 20 lies in a
   13-word passage of ``benchmark`` go.
5. encode: the texts' SentencePiece ids, and whether they decode back.

Nulls, empty texts, repeated rows, empty tables and extra columns are handled
as the operators say: a null or empty text has no letter and goes in stage 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import op02_exact_dedup, op03_sentencepiece, op04_language, op08_decontaminate, op10_minhash
from quarry.llm.common import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op04_language.known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02_exact_dedup.keep_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_minhash.one_per_group(docs, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op08_decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = op03_sentencepiece.encode_docs(docs)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("encode", encode)]

ORACLE_SQL = None       # the classifier's decisions cannot be said in SQL; tests/llm compares every stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
