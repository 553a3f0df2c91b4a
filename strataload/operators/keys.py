"""Dense ordered surrogate keys, and the unknown-member row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.session import materialize

DEFAULT_KEY = -1
_LOCAL_BITS = 33  # monotonically_increasing_id: partition above bit 33, row in partition below


def business_rows(df: DataFrame, id_column: str) -> DataFrame:
    return df.where(F.col(id_column) != F.lit(DEFAULT_KEY))


def current_max_key(target: DataFrame, id_column: str) -> Column:
    """Largest surrogate key in use, 0 for none, as a scalar subquery."""
    top = business_rows(target, id_column).agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("top"))
    return top.scalar()


def number_rows(rows: DataFrame, id_column: str, order: Sequence[str], base: Column | int = 0) -> DataFrame:
    """Add ``id_column`` = base + 1, base + 2, … in ascending order, NULLs last.

    A global ``row_number`` would move all rows into one task. Here Spark sorts by range, each row
    records its partition and its place in it, and the sorted rows are written once: the places must
    not move when a lost executor makes Spark sort again. Only one count per partition then meets in
    a single task, and only those counts are broadcast; their number is the number of partitions.
    Columns outside ``order`` break ties, so equal runs give equal keys.
    """
    ties = [c for c in rows.columns if c not in order]
    placed = materialize(
        rows.orderBy(*[F.col(c).asc_nulls_last() for c in [*order, *ties]]).withColumn(
            "_slot", F.monotonically_increasing_id()
        ),
        "numbered",
    )
    part = F.shiftright("_slot", _LOCAL_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    local = F.col("_slot").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    base_column = base if isinstance(base, Column) else F.lit(base)
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    key = (base_column + F.col("_start") + local + F.lit(1)).cast("long")
    return numbered.select(key.alias(id_column), *rows.columns)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """Rows given by hand. Text longer than a column's ``max_length`` metadata is an error."""
    for row in rows:
        for field, value in zip(schema.fields, row, strict=True):
            limit = field.metadata.get("max_length")
            if limit is not None and value is not None and len(value) > limit:
                raise ValueError(f"{field.name}: value longer than {limit} characters")
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, row)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def single_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, Any]) -> DataFrame:
    """One row by column name; columns without a value hold NULL."""
    return literal_rows(spark, [[values.get(f.name) for f in schema.fields]], schema)


def missing_default_row(target: DataFrame, schema: T.StructType, id_column: str, values: Mapping[str, Any]) -> DataFrame:
    """The unknown-member row if ``target`` lacks it, else no row."""
    row = single_row(target.sparkSession, schema, values)
    present = target.where(F.col(id_column) == F.lit(DEFAULT_KEY)).select(id_column)
    return row.join(present, id_column, "left_anti").select(*schema.names)


def has_default_row(target: DataFrame, id_column: str) -> bool:
    return not target.where(F.col(id_column) == F.lit(DEFAULT_KEY)).isEmpty()
