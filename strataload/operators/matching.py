"""Which source rows are not in the target yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.session import materialize


def rows_without_match(source: DataFrame, target: DataFrame, pairs: Sequence[tuple[str, Column]]) -> DataFrame:
    """Anti-join. A NULL on either side never matches, so rows with a NULL key are kept.

    ``pairs`` holds (source column, expression over the target's columns).
    """
    keys = target.select(*[expr.alias(f"_key{i}") for i, (_, expr) in enumerate(pairs)])
    condition = [source[column] == keys[f"_key{i}"] for i, (column, _) in enumerate(pairs)]
    return source.join(keys, condition, "left_anti")


def rows_not_in(source: DataFrame, key: str, target: DataFrame, target_key: str) -> DataFrame:
    """``key NOT IN (SELECT target_key …)`` with its three-valued result.

    An empty target keeps every row, a NULL in the target drops every row, and otherwise a NULL key
    is dropped. Spark's own null-aware anti-join always broadcasts the target; here the two facts
    about the target are scalar subqueries, and the join itself may shuffle.
    """
    keys = target.select(F.col(target_key).alias("_key"))
    facts = keys.agg(F.count("*").alias("n"), F.count_if(F.col("_key").isNull()).alias("n_null"))
    is_empty = facts.select("n").scalar() == 0
    has_null = facts.select("n_null").scalar() > 0
    unmatched = source.join(keys, source[key] == keys["_key"], "left_anti")
    return unmatched.where(is_empty | (~has_null & F.col(key).isNotNull()))


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold more than ``share`` of the rows; there are fewer than 1 / share of them."""
    counts = materialize(df.groupBy(key).agg(F.count("*").alias("n")), "key-counts")
    bound = counts.agg((F.sum("n") * share).alias("bound")).scalar()
    found = counts.where(F.col(key).isNotNull() & (F.col("n") > bound))
    return [r[key] for r in found.collect()]


def join_hot_keys(
    left: DataFrame, right: DataFrame, key: str, spread_by: str, condition: Column, share: float = 0.005, parts: int = 64
) -> DataFrame:
    """Left join on ``key`` under a further condition, with the rows of hot keys dealt to ``parts`` tasks.

    Rows of ``left`` with a hot key carry a number drawn from ``spread_by``; the rows of ``right`` with that key, of
    which there are few, are repeated for every number. All other keys join as they are.
    """
    hot = hot_keys(left, key, share)
    spread = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    dealt = left.withColumn("_part", F.when(is_hot, spread).otherwise(F.lit(0)))
    numbers = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_right_part", F.explode(numbers)).withColumnRenamed(key, "_right_key")
    matched = (F.col(key) == F.col("_right_key")) & (F.col("_part") == F.col("_right_part")) & condition
    return dealt.join(repeated, matched, "left").drop("_part", "_right_part", "_right_key")
