"""Sales files: all-text CSV with a header, then the typed and deduplicated staging form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.operators.dedup import first_of_repeated
from strataload.session import materialize
from strataload.sources.schemas import STAGING_TYPES, raw_schema

# A quote inside a quoted field is doubled, and blanks around a field belong to it.
CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# An unquoted empty field is NULL, a quoted one is empty text. The reader tells them apart only if the
# text it takes for NULL cannot occur in a file.
_NULL_TEXT = "\u0000"
# Wide enough to see what a staging type would round.
_FULL = T.DecimalType(38, 18)


def read_sales_csv(spark: SparkSession, path: str, names: list[str], multi_line: bool = False) -> DataFrame:
    """All columns as text. Other header names, and a line with too few or too many fields, are errors,
    also where only some columns are read.

    Files stay splittable unless ``multi_line`` asks for line breaks inside quoted fields, which
    costs one task per file.
    """
    reader = spark.read.schema(raw_schema(names)).options(**CSV_DIALECT)
    reader = reader.option("nullValue", _NULL_TEXT).option("mode", "FAILFAST")
    reader = reader.option("enforceSchema", "false").option("columnPruning", "false")
    return reader.option("multiLine", multi_line).csv(path)


def write_sales_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV_DIALECT).csv(path)


def _attempted(raw: DataFrame, kinds: dict[str, T.DataType], date_format: str | None) -> DataFrame:
    """``raw`` with each of ``kinds`` beside its text: as ``_<name>``, and decimals in full as ``_full_<name>``.

    Every text is parsed once.
    """
    money = {name: kind for name, kind in kinds.items() if isinstance(kind, T.DecimalType)}
    attempts = {f"_full_{name}": F.col(name).try_cast(_FULL) for name in money}
    for name, kind in kinds.items():
        if kind.typeName() == "date" and date_format:
            attempts[f"_{name}"] = F.try_to_date(F.col(name), date_format)
        elif name not in money:
            attempts[f"_{name}"] = F.col(name).try_cast(kind)
    rounded = {f"_{name}": F.col(f"_full_{name}").try_cast(kind) for name, kind in money.items()}
    return raw.withColumns(attempts).withColumns(rounded)


def _misfit(name: str, kind: T.DataType) -> tuple[Column, Column]:
    """Whether a text is no such value, or one that the type would round; and what to say of it.

    Neither depends on the session's settings.
    """
    raw, value = F.col(name), F.col(f"_{name}")
    lost = value.isNull()
    if isinstance(kind, T.DecimalType):
        lost = lost | (F.col(f"_full_{name}") != value.cast(_FULL))
    return raw.isNotNull() & lost, F.concat(F.lit(f"{name} does not fit {kind.simpleString()}: "), raw)


def typed_sales(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Cast the text columns to the staging types. A value that does not fit is an error."""
    kinds = {name: STAGING_TYPES[name] for name in raw.columns if name in STAGING_TYPES}
    columns = []
    for name in raw.columns:
        if name not in kinds:
            columns.append(F.col(name))
            continue
        misfit, said = _misfit(name, kinds[name])
        columns.append(F.when(misfit, F.raise_error(said).cast(kinds[name])).otherwise(F.col(f"_{name}")).alias(name))
    return _attempted(raw, kinds, date_format).select(*columns)


def split_sales(raw: DataFrame, date_format: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(typed rows, rejected rows, counts): one pass over the file writes both, and counts them on the way.

    A rejected row keeps its text, and ``reasons`` lists every value that does not fit. Both kinds lie in the same
    files: a folder for each would make every task sort its rows by folder before it writes them.
    """
    kinds = {name: STAGING_TYPES[name] for name in raw.columns if name in STAGING_TYPES}
    misfits = {name: _misfit(name, kind) for name, kind in kinds.items()}
    wrong = F.array_compact(F.array(*[F.when(misfit, said) for misfit, said in misfits.values()]))
    as_text = F.struct(*[F.col(name).alias(name) for name in kinds])
    rows = _attempted(raw, kinds, date_format).select(
        *[F.col(f"_{name}").alias(name) if name in kinds else F.col(name) for name in raw.columns],
        wrong.alias("reasons"),
        as_text.alias("_text"),
    )
    rejected = F.size("reasons") > 0
    seen = Observation()
    counts = (F.count(F.lit(1)).alias("read"), F.count_if(~rejected).alias("typed"), F.count_if(rejected).alias("rejected"))
    marked = rows.withColumn("_text", F.when(rejected, F.col("_text"))).withColumn("rejected", rejected)
    stored = materialize(marked.observe(seen, *counts), "sales")
    bad = stored.where("rejected").select(
        *[F.col(f"_text.{name}").alias(name) if name in kinds else F.col(name) for name in raw.columns], "reasons"
    )
    return stored.where("not rejected").select(*raw.columns), bad, dict(seen.get)


def stage_sales(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Typed rows, one per payment. The typed rows are written once; the payments that repeat are found on their ids."""
    return first_of_repeated(materialize(typed_sales(raw, date_format), "typed"), ["payment_id"])
