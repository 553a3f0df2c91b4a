"""Plain parquet tables below one root folder, one folder per table.

How a table's rows lie in its folder decides what a write touches:

- keyed tables (entities, dimensions, per-key state): by a hash of the trimmed business key, in folders
  ``bucket_of_<n>=<b>``. ``merge`` rewrites only the folders of the keys it changes, with Spark's dynamic partition
  overwrite; all rows of a key share a folder, so rules on a key are checked on those folders alone.
- staging tables: by load batch, in folders ``load_batch=<number>``. A load reads the folders after its mark.
- other tables: as they come.

New rows and changed folders are written to the scratch folder and checked there first, so a failed check leaves the
table as it was. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.operators.rows import conform, empty_frame
from strataload.session import hadoop_path, materialize, write_options
from strataload.sources.schemas import BATCHED_TABLES, TABLE_KEYS, TABLE_SCHEMAS

BATCH = "load_batch"
Check = Callable[[DataFrame], None]


class MissingTable(LookupError):
    """The table has no folder."""


@dataclass
class Warehouse:
    """``buckets`` is the number of folders of a keyed table: about one for every few hundred MB. It is part of the
    folders' names; a table written with another number is refused by Spark until ``replace`` writes it anew."""

    spark: SparkSession
    root: str
    schemas: Mapping[str, T.StructType] = field(default_factory=lambda: TABLE_SCHEMAS)
    # table: (column that identifies a row, business key)
    keys: Mapping[str, tuple[str, str]] = field(default_factory=lambda: TABLE_KEYS)
    buckets: int = 16

    def folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        fs, path = hadoop_path(self.spark, self.folder(table))
        return fs.exists(path)

    # Layout

    @property
    def bucket_column(self) -> str:
        return f"bucket_of_{self.buckets}"

    def bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(F.trim(F.col(self.keys[table][1]).cast("string"))), F.lit(self.buckets)).cast("int")

    def _layout(self, table: str) -> T.StructField | None:
        if table in self.keys:
            return T.StructField(self.bucket_column, T.IntegerType())
        return T.StructField(BATCH, T.LongType()) if table in BATCHED_TABLES else None

    def _laid_out(self, table: str) -> DataFrame:
        """All rows with the column their folder is named after."""
        if not self.exists(table):
            raise MissingTable(table)
        layout, schema = self._layout(table), self.schemas.get(table)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, layout] if layout else schema.fields))
        else:
            reader = reader.option("mergeSchema", True)
        return reader.parquet(self.folder(table))

    def _conform(self, table: str, df: DataFrame) -> DataFrame:
        schema = self.schemas.get(table)
        return conform(df, schema) if schema else df

    def _placed(self, table: str, df: DataFrame) -> DataFrame:
        """Rows in the table's columns, with the bucket of a keyed table."""
        rows = self._conform(table, df)
        return rows.withColumn(self.bucket_column, self.bucket(table)) if table in self.keys else rows

    # Reading

    def read(self, table: str) -> DataFrame:
        """All rows. Columns added to the layout later read as NULL in older files."""
        layout = self._layout(table)
        rows = self._laid_out(table)
        return rows.drop(layout.name) if layout else rows

    def read_or_empty(self, table: str) -> DataFrame:
        return self.read(table) if self.exists(table) else empty_frame(self.spark, self.schemas[table])

    def read_key(self, table: str, key: str) -> DataFrame:
        """Rows of one business key, from its folder alone."""
        folder = F.pmod(F.xxhash64(F.trim(F.lit(key))), F.lit(self.buckets)).cast("int")
        rows = self._laid_out(table).where(F.col(self.bucket_column) == folder)
        return rows.where(F.trim(F.col(self.keys[table][1]).cast("string")) == F.trim(F.lit(key))).drop(self.bucket_column)

    def read_after(self, table: str, batch: int, with_batch: bool = False) -> DataFrame:
        """Staging rows of the batches after ``batch``; other folders are not read."""
        rows = self._laid_out(table).where(F.col(BATCH) > batch)
        return rows if with_batch else rows.drop(BATCH)

    def last_batch(self, *tables: str) -> int:
        """The newest batch of staging tables, from the names of their folders; 0 for none."""
        newest = 0
        for table in tables:
            fs, pattern = hadoop_path(self.spark, f"{self.folder(table)}/{BATCH}=*")
            for status in fs.globStatus(pattern) or []:
                newest = max(newest, int(status.getPath().getName().split("=")[1]))
        return newest

    def count(self, table: str) -> int:
        return self.read(table).agg(F.count("*")).first()[0]

    # Writing

    def _write(self, table: str, rows: DataFrame, mode: str) -> None:
        layout = self._layout(table)
        if layout is None:
            rows.write.mode(mode).options(**write_options(rows.columns)).parquet(self.folder(table))
            return
        # One file per folder and write. Batches are single folders, which many tasks fill.
        dealt = rows.repartition(layout.name) if table in self.keys else rows
        writer = dealt.write.options(**write_options(dealt.columns)).partitionBy(layout.name)
        if mode == "folders":
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.folder(table))
        else:
            writer.mode(mode).option("partitionOverwriteMode", "static").parquet(self.folder(table))

    def append(self, table: str, df: DataFrame, checks: Sequence[Check] = ()) -> None:
        """Add rows; stored files stay. ``checks`` see the new rows with those stored in the same folders."""
        rows = self._placed(table, df)
        if checks:
            rows = materialize(rows, "appended")
            both = rows
            if self.exists(table):
                stored = self._laid_out(table)
                if table in self.keys:
                    stored = stored.where(F.col(self.bucket_column).isin(self._buckets_of(rows)))
                both = stored.unionByName(rows)
            for check in checks:
                check(both)
        self._write(table, rows, "append")

    def append_batch(self, table: str, df: DataFrame, batch: int) -> int:
        """Add staging rows as a batch of their own; returns their number."""
        seen = Observation()
        rows = self._conform(table, df).withColumn(BATCH, F.lit(batch).cast("long"))
        self._write(table, rows.observe(seen, F.count(F.lit(1)).alias("n")), "append")
        return seen.get["n"]

    def write_batches(self, table: str, df: DataFrame) -> None:
        """Write rows that name their batch, in place of what is stored of those batches."""
        fields = [*self.schemas[table].fields, T.StructField(BATCH, T.LongType())]
        self._write(table, conform(df, T.StructType(fields)), "folders")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """At most as many as a table has folders."""
        return [r[0] for r in rows.select(self.bucket_column).distinct().collect()]

    def merge(
        self, table: str, df: DataFrame, checks: Sequence[Check] = (), deleted: DataFrame | None = None
    ) -> None:
        """Rows of ``df`` take the place of stored rows with their id, or are added; ``deleted`` holds ids to drop.

        Read are the ids of all rows and the folders of the keys concerned; only those folders are written.
        """
        id_column = self.keys[table][0]
        rows = materialize(self._placed(table, df), "merged")
        self.create_if_absent(table)
        stored = self._laid_out(table)
        gone = rows.select(id_column)
        if deleted is not None:
            gone = materialize(gone.union(deleted.select(id_column)), "gone")
        before = stored.select(id_column, self.bucket_column).join(gone, id_column, "left_semi")
        touched = sorted(set(self._buckets_of(rows)) | set(self._buckets_of(before)))
        if not touched:
            return
        kept = stored.where(F.col(self.bucket_column).isin(touched)).join(gone, id_column, "left_anti")
        state = materialize(kept.unionByName(rows), "folders")
        for check in checks:
            check(state)
        self._write(table, state, "folders")
        # A folder that lost all its rows is not among those written.
        for empty in set(touched) - set(self._buckets_of(state)):
            fs, path = hadoop_path(self.spark, f"{self.folder(table)}/{self.bucket_column}={empty}")
            fs.delete(path, True)

    def replace(self, table: str, df: DataFrame, checks: Sequence[Check] = ()) -> None:
        """Make ``df`` the whole table. ``df`` may read the table it replaces, whose batches then become one."""
        rows = self._placed(table, df)
        if table in BATCHED_TABLES:
            rows = rows.withColumn(BATCH, F.lit(max(1, self.last_batch(table))).cast("long"))
        rows = materialize(rows, "replaced")
        for check in checks:
            check(rows)
        self._write(table, rows, "overwrite")

    def rewrite_batches(self, table: str, concerned: Column, change: Callable[[DataFrame], DataFrame]) -> None:
        """Change staging rows; only the batches with a row that is ``concerned`` are written anew."""
        rows = self._laid_out(table)
        batches = [r[0] for r in rows.where(concerned).select(BATCH).distinct().collect()]
        if batches:
            changed = change(rows.where(F.col(BATCH).isin(batches)))
            self._write(table, materialize(changed, "batches"), "folders")

    # Tables

    def create_if_absent(self, table: str) -> bool:
        fs, path = hadoop_path(self.spark, self.folder(table))
        return not fs.exists(path) and fs.mkdirs(path)

    def truncate(self, table: str) -> None:
        self.drop_if_exists(table)
        self.create_if_absent(table)

    def drop_if_exists(self, table: str) -> bool:
        fs, path = hadoop_path(self.spark, self.folder(table))
        return fs.exists(path) and fs.delete(path, True)
