"""Choosing one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.functions.text import fold_null
from strataload.session import materialize

# Bits by which rows with a repeated key are told from the others.
_MARK_BITS = 1 << 26


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Set union. The map side keeps each distinct row once, so a hot key shuffles once per task."""
    return union_all(frames).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row of every key; NULL keys form one group.

    ``order`` is extended by all remaining columns from left to right, so the winner does not depend
    on partitioning.
    The rank filter lets Spark keep only the leader of each key before the shuffle, so a key that
    holds a large share of the rows does not land in one task.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_of_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``first_per_key`` for wide rows whose keys mostly occur once; pass written rows, they are read three times.

    The repeated keys are found on the key columns alone. Each sets one bit among ``_MARK_BITS``, chosen by its hash;
    the words that hold a set bit, a million at most, are broadcast. Only rows whose bit is set are shuffled and
    ranked: those with a repeated key, and the few that share a bit with one. All others pass as they are.
    """
    repeated = df.select(*keys).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    spot = F.pmod(F.xxhash64(*keys), F.lit(_MARK_BITS))
    word, bit = F.shiftright(spot, 6).cast("int"), spot.bitwiseAND(F.lit(63)).cast("int")
    set_bits = repeated.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
    marks = materialize(set_bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "repeated")
    marked = df.withColumn("_at", word).join(F.broadcast(marks), F.col("_at") == F.col("_word"), "left")
    again = F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))
    ranked = first_per_key(marked.where(again).select(*df.columns), keys)
    return marked.where(~again).select(*df.columns).unionByName(ranked)


def survivor_state(df: DataFrame, key: str, priority: str, attributes: Sequence[str]) -> DataFrame:
    """One (key, priority, attributes…) per key: the lowest priority, then the smallest attributes in their order.

    Sales repeat a customer or product many times, so the variants of each key are found first, by a
    hash aggregate that starts on the map side; only variants are sorted.
    The state merges: that of two batches is ``survivor_state`` of the union of their states, in any order.
    """
    return first_per_key(df.select(key, priority, *attributes).distinct(), [key])


def survivor_by_priority(df: DataFrame, key: str, priority: str, attributes: Sequence[str]) -> DataFrame:
    """The survivors without their priority."""
    return survivor_state(df, key, priority, attributes).drop(priority)


def maxima_state(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One (key, attributes…) per key with the maximum of each attribute on its own, NULL if it has none. Merges
    like ``survivor_state``.

    ``max_by`` of a column by itself is its maximum. Below ``max`` Spark would drop the distinct as
    redundant, and since text does not fit a hash aggregation buffer, sort every source row.
    """
    variants = df.select(fold_null(F.col(key)).alias(key), *attributes).distinct()
    return variants.groupBy(key).agg(*[F.max_by(a, a).alias(a) for a in attributes])


def survivor_by_max(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The maxima with NULL as the unknown text; a row may mix variants."""
    return maxima_state(df, key, attributes).select(key, *[fold_null(F.col(a)).alias(a) for a in attributes])


def merge_state(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], reduce_rows: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The new state of the keys a batch mentions, from the state of all keys before it.

    ``reduce_rows`` gives one row per key, and the same row whether it sees rows at once or reduced in parts.
    Keys of the state that the batch does not mention are left out: they stay as they are.
    """
    reduced = reduce_rows(batch)
    condition = [state[k].eqNullSafe(reduced[k]) for k in keys]
    concerned = state.join(reduced.select(*keys), condition, "left_semi")
    return reduce_rows(concerned.unionByName(reduced))
