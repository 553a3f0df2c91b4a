"""Row-level changes, layouts and generators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """New values for the rows that meet the condition; a NULL condition leaves a row alone."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not meet the condition; a NULL condition keeps a row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def add_missing_columns(df: DataFrame, columns: Mapping[str, T.DataType]) -> DataFrame:
    """Add the columns ``df`` lacks, holding NULL; running it again changes nothing."""
    absent = {c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; columns ``df`` lacks hold NULL.

    Text longer than a column's ``max_length`` is an error, not a cut.
    """
    full = add_missing_columns(df, {f.name: f.dataType for f in schema.fields})
    selected = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        limit = field.metadata.get("max_length")
        if limit is not None:
            too_long = F.raise_error(F.lit(f"{field.name}: value longer than {limit} characters"))
            value = F.when(F.length(value) > limit, too_long).otherwise(value)
        selected.append(value.alias(field.name))
    return full.select(*selected)


def number_pairs(spark: SparkSession, n: int, kind: str = "int") -> DataFrame:
    """(i, i) for i from 1 to n. A number beyond the type is an error."""
    return spark.range(1, n + 1).select(F.col("id").cast(kind).alias("a"), F.col("id").cast(kind).alias("b"))
