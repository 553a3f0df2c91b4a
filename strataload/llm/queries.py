"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.llm.byte_network import predict_languages
from strataload.llm.cover_codes import code_rows
from strataload.llm.decontamination import find_passages
from strataload.llm.exact_dedup import exact_groups
from strataload.llm.infill import infill, restored
from strataload.llm.jaccard_join import join_similar
from strataload.llm.license_scan import scan_licenses
from strataload.llm.lm import score_documents
from strataload.llm.pii import find_pii
from strataload.llm.piece_codec import encode_documents
from strataload.llm.quality import score_quality
from strataload.llm.tables import read_table
from strataload.llm.token_store import read_blocks, write_blocks
from strataload.llm.url_filter import judge_urls
from strataload.session import scratch_path


def op1_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    return scan_licenses(read_table(spark, directory, "documents"))


def op2_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    return join_similar(read_table(spark, directory, "documents"))


def op3_pii(spark: SparkSession, directory: str) -> DataFrame:
    return find_pii(read_table(spark, directory, "documents"))


def op4_token_store(spark: SparkSession, directory: str) -> DataFrame:
    path = scratch_path(spark, "token-blocks")
    write_blocks(read_table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, path)
    return read_blocks(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op5_lm_scoring(spark: SparkSession, directory: str) -> DataFrame:
    return score_documents(read_table(spark, directory, "documents"))


def op6_quality(spark: SparkSession, directory: str) -> DataFrame:
    return score_quality(read_table(spark, directory, "documents"), read_table(spark, directory, "labels"))


def op7_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return find_passages(read_table(spark, directory, "documents"), read_table(spark, directory, "benchmark"))


def op8_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact_groups(read_table(spark, directory, "documents"))


def op9_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    coded = encode_documents(
        read_table(spark, directory, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    return judge_urls(read_table(spark, directory, "pages"))


def op11_cover_codes(spark: SparkSession, directory: str) -> DataFrame:
    return code_rows(read_table(spark, directory, "embeddings"))


def op12_byte_language(spark: SparkSession, directory: str) -> DataFrame:
    return predict_languages(read_table(spark, directory, "documents"))


def op13_infill(spark: SparkSession, directory: str) -> DataFrame:
    rewritten = infill(read_table(spark, directory, "documents").select("doc_id", "text"))
    return rewritten.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_pii": op3_pii,
    "op4_token_store": op4_token_store,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_url_filters": op10_url_filters,
    "op11_cover_codes": op11_cover_codes,
    "op12_byte_language": op12_byte_language,
    "op13_infill": op13_infill,
}
