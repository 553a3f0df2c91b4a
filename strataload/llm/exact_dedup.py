"""Exact duplicates, found by combining in three steps that a hot text cannot overload.

Equal means: identical after every run of space, tab, LF, VT, FF and CR became one space.

1. Each task merges its own equal texts (the map side of the first aggregate).
2. The survivors meet by (digest, text, salt), where the salt is taken from the task they come from.
3. The winners of the salts meet by (digest, text).

The text itself is a grouping key in all three steps, so equality is decided on content; the digest only
places the rows. A group of any size sends one row per task into step 2 and one per salt into step 3.
Documents then find their group by digest, a second hash and the length. That join reads two plain
shuffles of narrow rows, whose skewed partitions adaptive execution splits.

Defined results: a NULL text is the empty text; NULL ids lose against any other id and form a group's
``keep_id`` only if it has no other; of repeated rows with one id and equal texts exactly one is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataload.llm.tables import orderable, texts
from strataload.session import materialize

SALTS = 16
KEY = ["digest", "hash", "length"]


def _keyed(docs: DataFrame) -> DataFrame:
    body = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    return texts(docs).select("doc_id", body.alias("body")).select(
        "doc_id",
        "body",
        F.unhex(F.sha2("body", 256)).alias("digest"),
        F.xxhash64("body").alias("hash"),
        F.octet_length("body").alias("length"),
    )


def winners(docs: DataFrame) -> DataFrame:
    """One row per distinct text: its key, the smallest doc_id and the number of rows."""
    salted = (
        _keyed(docs)
        .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .groupBy(*KEY, "body", "salt")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    merged = salted.groupBy(*KEY, "body").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    return merged.select(*KEY, "keep_id", "group_size")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = materialize(winners(docs), "dedup-groups")
    repeats = Window.partitionBy("doc_id", *KEY).orderBy("doc_id")
    rows = _keyed(docs).drop("body").withColumn("repeat", F.row_number().over(repeats))
    joined = rows.join(groups, KEY)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows of equal id and text leave one."""
    named = {name: f"_in_{i}" for i, name in enumerate(docs.columns)}
    inner = docs.select(*(F.col(f"`{name}`").alias(alias) for name, alias in named.items()))
    kept = exact_groups(docs).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")
    )
    body = F.regexp_replace(F.coalesce(F.col(named["text"]), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    same = F.col(named["doc_id"]).eqNullSafe(F.col("_kept_id"))
    rows = inner.withColumn("_sha", F.sha2(body, 256)).join(
        kept, same & (F.col("_sha") == F.col("_kept_sha")), "left_semi"
    )
    repeated = Window.partitionBy(named["doc_id"], "_sha").orderBy(*(orderable(rows, a) for n, a in named.items() if n != "text"))
    rows = rows.withColumn("_repeat", F.row_number().over(repeated)).filter("_repeat = 1")
    return rows.select(*(F.col(alias).alias(name) for name, alias in named.items()))
