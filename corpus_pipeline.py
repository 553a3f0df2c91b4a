"""Corpus preparation in stages over ``documents``; each stage's rows are written and read by the next.

1. quality: documents that the classifier rejects go.
2. exact_dedup: of documents with equal texts the one with the smallest id stays.
3. near_dedup: of each component of documents linked by similar shingles the one with the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. encode: sub-word ids of the texts that are left, and the texts decoded from them.

Defined results: NULL texts count as empty; every stage judges each row by its own text, rows without id or with a repeated
one too; an empty table gives no rows. A document without a label is judged by the classifier like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.llm.decontamination import drop_contaminated
from strataload.llm.exact_dedup import drop_exact_duplicates
from strataload.llm.jaccard_join import drop_near_duplicates
from strataload.llm.piece_codec import encode_documents
from strataload.llm.quality import drop_low_quality
from strataload.llm.tables import read_table
from strataload.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encode", encode),
]

# Classifier, similarity components, alignment and sub-words are beyond SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
