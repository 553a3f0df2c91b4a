"""Warehouse inputs derived from the given tables.

The sales files themselves are not available, so the staging rows of both source systems come from
``lineitem`` and its lookups: lines with status F were paid in cash, lines with status O by card.
Untidy values (padding, blanks, NULLs, spelling variants) are added by expression. Each text below
is valid in Spark and in DuckDB; table names in braces are filled in by the caller.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.plans.specs import EntitySpec
from strataload.registry.texts import CE_TEXTS, DIM_TEXTS, LOG_TEXT, LOOKUPS, SALES, SOURCE_FILTER
from strataload.session import hadoop_path
from strataload.sources.schemas import CARD_COLUMNS, CASH_COLUMNS

AS_OF = dt.date(2024, 1, 1)
# Files above this are taken not to fit a broadcast (Spark's own limit by default). It decides the order of joins alone.
BROADCAST_BYTES = 10 << 20
# Schemas by path: every query reads several tables, and inferring a schema is a job of its own.
_schemas: dict[str, T.StructType] = {}
TABLES = "region nation customer supplier part orders lineitem events".split()


@dataclass
class Feed:
    spark: SparkSession
    directory: str

    def table(self, name: str) -> DataFrame:
        path = f"{self.directory}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def file_bytes(self, name: str) -> int:
        fs, path = hadoop_path(self.spark, f"{self.directory}/{name}.parquet")
        return fs.getContentSummary(path).getLength()

    def sql(self, text: str) -> DataFrame:
        used = {name: self.table(name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)

    def sales(self, source: str, names: list[str], distinct: bool = False) -> DataFrame:
        """Staging columns of one source system, joined only to the lookups they need.

        ``distinct`` is for callers that build a set anyway: the few line columns are then made
        distinct before they meet the lookups.
        """
        prefixes = {prefix for name in names for prefix in SALES[name].needs}
        wanted = {lookup.prefix for lookup in LOOKUPS if any(p in prefixes for p in lookup.serves)}
        line_columns = {c for name in names for c in SALES[name].line_columns}
        line_columns |= {lookup.line_key for lookup in LOOKUPS if lookup.prefix in wanted and lookup.line_key}
        rows = self.table("lineitem").where(SOURCE_FILTER[source]).select(*sorted(line_columns))
        if distinct:
            rows = rows.distinct()
        tables = {lookup.prefix: self.table(lookup.table) for lookup in LOOKUPS if lookup.prefix in wanted}
        conditions = {lookup.prefix: F.expr(lookup.condition) for lookup in LOOKUPS}
        if "c" in wanted:
            # Orders are fewer and narrower than lines, so they meet the customers first.
            tables["o"] = tables["o"].join(tables.pop("c"), conditions["c"], "left")
        # The orders are the last join that shuffles, so that the lines of an order, and its repeated payments, stay side
        # by side: what repeats is reduced before its shuffle. Tables that fit a broadcast come last, as they would only
        # widen the rows of the other joins; of parts, the size decides.
        for prefix in "posnr" if "p" in tables and self.file_bytes("part") > BROADCAST_BYTES else "opsnr":
            if prefix in tables:
                rows = rows.join(tables[prefix], conditions[prefix], "left")
        return rows.select(*[F.expr(SALES[name].text).alias(name) for name in names])

    def staged(self, source: str) -> DataFrame:
        return self.sales(source, CASH_COLUMNS if source == "cash" else CARD_COLUMNS)

    def raw(self, source: str) -> DataFrame:
        """The same rows with every column as text, as a sales file delivers them."""
        rows = self.staged(source)
        return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])

    def clean_raw(self, source: str) -> DataFrame:
        """Raw rows in which every employee has one name."""
        return self.raw(source).withColumn("employee_name", F.concat(F.lit("Employee "), F.trim("employee_id")))

    def sources(self, spec: EntitySpec) -> tuple[DataFrame, DataFrame]:
        names = spec.staging_columns
        card = self.sales("card", names, distinct=True)
        return (card if spec.card_only else self.sales("cash", names, distinct=True)), card

    def days(self) -> tuple[DataFrame, DataFrame]:
        names = ["order_date", "ship_date"]
        return self.sales("cash", names, distinct=True), self.sales("card", names, distinct=True)

    def entity(self, name: str, state: str = "prior") -> DataFrame:
        return self.sql(CE_TEXTS[name][state])

    def dimension(self, name: str) -> DataFrame:
        return self.sql(DIM_TEXTS[name])

    @cached_property
    def log(self) -> DataFrame:
        return self.sql(LOG_TEXT)
