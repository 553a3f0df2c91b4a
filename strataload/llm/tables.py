"""Reading the given tables, and small expressions several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPANS = "array<struct<start:int,end:int,match:string>>"
RUN = 256


def read_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with NULL texts as empty; whatever else the input carries is left behind."""
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )


def with_bodies(docs: DataFrame, run, schema: str | None = None) -> DataFrame:
    """``docs`` with all columns through ``run``, which turns (text bytes of a batch, batch) into a batch.

    The decision is made where the row is, so it concerns this row alone, whatever its id and however often
    the id occurs. ``schema`` names the columns that ``run`` appends.
    """
    inner = docs.toDF(*(f"_in_{i}" for i in range(len(docs.columns))))
    text = inner.columns[docs.columns.index("text")]

    def each(batches):
        import pyarrow.compute as pc

        from strataload.llm.hashing import utf8

        for batch in batches:
            yield run(utf8(pc.fill_null(batch.column(text), "")), batch)

    fields = T.StructType(list(inner.schema.fields))
    for extra in T.StructType.fromDDL(schema) if schema else ():
        fields = fields.add(extra)
    out = inner.mapInArrow(each, fields)
    return out.toDF(*docs.columns, *out.columns[len(docs.columns) :])


def lower_ascii(value: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(value, UPPER, LOWER)


def nothing_gathered(kind: str) -> list[Column]:
    """Fields of an aggregate's state that gather array items; ``kind`` is the array's type."""
    return [F.array().cast(f"array<{kind}>").alias("runs"), F.array().cast(kind).alias("last")]


def gathered(state: Column, item: Column, wanted: Column, kind: str) -> list[Column]:
    """The fields with ``item`` added if it is ``wanted``.

    Appending copies an array, so items gather in runs of RUN, and the runs in an array of their own.
    """
    full = F.size(state["last"]) >= RUN
    one = F.array(item).cast(kind)
    return [
        F.when(wanted & full, F.concat(state["runs"], F.array(state["last"]))).otherwise(state["runs"]).alias("runs"),
        F.when(~wanted, state["last"]).when(full, one).otherwise(F.concat(state["last"], one)).alias("last"),
    ]


def all_gathered(state: Column) -> Column:
    return F.concat(F.flatten(state["runs"]), state["last"])


def orderable(df: DataFrame, name: str) -> Column:
    """A column to order by; a type that has no order, as it holds a map, goes by its JSON text."""

    def has_map(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return has_map(kind.elementType)
        if isinstance(kind, T.StructType):
            return any(has_map(field.dataType) for field in kind.fields)
        return isinstance(kind, T.MapType)

    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if has_map(df.schema[name].dataType) else column


def match_spans(value: Column, pattern: Column | str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches, counted in code points.

    The pieces between the matches and the matches themselves alternate, so the running sum of their
    lengths gives the places. The pattern must not match the empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    none = F.array().cast(SPANS)
    pairs = F.arrays_zip(
        F.split(value, pattern, -1).alias("gap"), F.regexp_extract_all(value, pattern, F.lit(0)).alias("match")
    )

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        found = F.array(F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match")))
        full = F.size(state["last"]) >= RUN
        last = F.when(pair["match"].isNull(), state["last"]).when(full, found).otherwise(F.concat(state["last"], found))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(full & pair["match"].isNotNull(), F.concat(state["runs"], F.array(state["last"])))
            .otherwise(state["runs"])
            .alias("runs"),
            last.alias("last"),
        )

    # Appending copies an array, so matches gather in runs, and the runs in an array of their own.
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("runs"), none.alias("last"))
    return F.aggregate(pairs, begin, step, lambda state: F.concat(F.flatten(state["runs"]), state["last"]))
