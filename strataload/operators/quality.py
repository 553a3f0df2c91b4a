"""Counts, uniqueness, reconciliation and the checks that guard a publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strataload.functions.text import is_set
from strataload.operators.dedup import first_per_key, union_all
from strataload.operators.keys import DEFAULT_KEY, business_rows


class ConstraintViolation(RuntimeError):
    """A table would break one of its uniqueness or not-null rules."""

    sqlstate = "23505"


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(counted)


def member_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Total, unknown-member and business rows per table; the value pairs a table with its id column."""
    counted = []
    for name, (df, id_column) in tables.items():
        totals = df.agg(
            F.count("*").alias("total_rows"),
            F.count_if(F.col(id_column) == DEFAULT_KEY).alias("default_rows"),
            F.count_if(F.col(id_column) != DEFAULT_KEY).alias("business_rows"),
        )
        counted.append(totals.select(F.lit(name).alias("table_name"), "total_rows", "default_rows", "business_rows"))
    return union_all(counted)


def duplicate_keys(df: DataFrame, key: str, count_name: str = "row_count") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias(count_name)).where(F.col(count_name) > 1)


def not_exactly_one_active(df: DataFrame, id_column: str, key: str = "customer_src_id") -> DataFrame:
    """Business keys with active versions other than one; keys with none do not show."""
    active = business_rows(df, id_column).where(F.upper(F.trim("is_active")) == "Y")
    counted = active.groupBy(key).agg(F.count("*").alias("active_version_count"))
    return counted.where("active_version_count <> 1")


def unique_violations(df: DataFrame, keys: Sequence[Column], where: Column | None = None) -> DataFrame:
    """Key values held by several rows. As in a unique index, rows with a NULL key never collide."""
    rows = df if where is None else df.where(where)
    names = [f"key_{i}" for i in range(1, len(keys) + 1)]
    keyed = rows.select(*[key.alias(name) for key, name in zip(keys, names)]).dropna()
    return keyed.groupBy(*names).agg(F.count("*").alias("row_count")).where("row_count > 1")


def key_violations(df: DataFrame, id_column: str) -> DataFrame:
    """Primary-key values that are NULL or repeated."""
    counted = df.groupBy(F.col(id_column).alias("key_1")).agg(F.count("*").alias("row_count"))
    return counted.where("key_1 is null or row_count > 1")


def reconcile(left: DataFrame, right: DataFrame, left_label: str, right_label: str) -> DataFrame:
    """How many distinct rows only one side holds; NULLs are equal to each other.

    Same result as EXCEPT both ways, with one scan per side and one shuffle. Column names are taken
    from the left side; columns pair up by position.
    """
    names = left.columns
    tagged = left.withColumn("_left", F.lit(True)).union(right.toDF(*names).withColumn("_left", F.lit(False)))
    sides = tagged.groupBy(*names).agg(
        F.bool_or("_left").alias("in_left"), F.bool_or(~F.col("_left")).alias("in_right")
    )
    totals = sides.agg(
        F.count_if(~F.col("in_right")).alias("only_left"), F.count_if(~F.col("in_left")).alias("only_right")
    )
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit(left_label).alias("difference_type"), F.col("only_left").alias("row_count")),
                F.struct(F.lit(right_label).alias("difference_type"), F.col("only_right").alias("row_count")),
            )
        )
    )


def fingerprints(df: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rows, sums) per hash bucket of the first column: order-free 128-bit sums over whole rows.

    At most ``buckets`` rows leave a task. A NULL counts as a value of its own.
    """
    marked = [part for c in df.columns for part in (F.col(c), F.col(c).isNull())]
    wide = "decimal(38,0)"
    hashed = df.select(
        F.pmod(F.xxhash64(F.col(df.columns[0])), F.lit(buckets)).alias("bucket"),
        *[F.xxhash64(F.lit(seed), *marked).cast(wide).alias(f"h{seed}") for seed in (1, 2)],
    )
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int) -> list[int]:
    """Buckets whose fingerprints differ, at most ``buckets`` numbers."""
    both = fingerprints(left, buckets).withColumn("side", F.lit(1)).unionByName(
        fingerprints(right.toDF(*left.columns), buckets).withColumn("side", F.lit(-1))
    )
    balance = [F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "h1", "h2")]
    found = both.groupBy("bucket").agg(*balance).where("n <> 0 or h1 <> 0 or h2 <> 0")
    return sorted(r["bucket"] for r in found.select("bucket").collect())


def reconcile_by_buckets(
    left: DataFrame, right: DataFrame, left_label: str, right_label: str, buckets: int = 1024
) -> DataFrame:
    """The result of ``reconcile``, comparing rows only in buckets of the first column that differ.

    Layers that agree cost one aggregate of ``buckets`` groups per side, and no row is shuffled.
    """
    touched = differing_buckets(left, right, buckets)
    place = F.pmod(F.xxhash64(F.col(left.columns[0])), F.lit(buckets))
    here = left.where(place.isin(touched) if touched else F.lit(False))
    there = right.toDF(*left.columns).where(place.isin(touched) if touched else F.lit(False))
    return reconcile(here, there, left_label, right_label)


def rule_violations(df: DataFrame, rules: Mapping[str, tuple[Sequence[Column], Column | None]]) -> DataFrame:
    """(check_name, key_1, key_2, row_count) of all key values that break a uniqueness rule, from one scan.

    A rule is up to two key expressions and a condition on the rows it holds for. As in a unique index, a NULL key
    collides with nothing. Every row becomes one narrow row per rule it is subject to.
    """
    entries = []
    for name, (keys, condition) in rules.items():
        parts = [*[k.cast("string") for k in keys], *[F.lit(None).cast("string")] * (2 - len(keys))]
        held = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        for k in keys:
            held &= k.isNotNull()
        entry = F.struct(F.lit(name).alias("check_name"), parts[0].alias("key_1"), parts[1].alias("key_2"))
        entries.append(F.when(held, entry))
    subject = df.select(F.inline(F.array_compact(F.array(*entries))))
    counted = subject.groupBy("check_name", "key_1", "key_2").agg(F.count("*").alias("row_count"))
    return counted.where("row_count > 1")


def checked_while_written(
    df: DataFrame, id_column: str, rules: Mapping[str, tuple[Sequence[Column], Column | None]], write: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Write ``df`` and report on it: total, unknown-member and business rows, rows without id, broken rules.

    ``write`` writes a frame and gives back what was written. The counts are observed while the rows go by; the rules
    take one scan of the written rows, whatever their number.
    """
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(id_column) == DEFAULT_KEY).alias("default_rows"),
        F.count_if(F.col(id_column) != DEFAULT_KEY).alias("business_rows"),
        F.count_if(F.col(id_column).isNull()).alias("rows_without_id"),
    )
    written = write(observed)
    none = F.lit(None).cast("string")
    counts = F.array(*[F.struct(F.lit(k).alias("check_name"), F.lit(v).cast("long").alias("n")) for k, v in seen.get.items()])
    rows = df.sparkSession.range(0, 1, 1, 1).select(F.inline(counts))
    totals = rows.select("check_name", none.alias("key_1"), none.alias("key_2"), F.col("n").alias("row_count"))
    return totals.unionByName(rule_violations(written, rules))


def matching_rows(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """Count of the rows that meet a condition."""
    return df.where(condition).agg(F.count("*").alias(name))


def source_profile(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Source rows per trimmed combination; the mapping renames staging columns."""
    keys = [F.trim(source).alias(name) for source, name in columns.items()]
    return df.groupBy(*keys).agg(F.count("*").alias("source_row_count"))


def latest_entries(log: DataFrame, key: str = "procedure_name", entry: str = "log_id") -> DataFrame:
    """The newest log entry of each procedure."""
    return first_per_key(log, [key], [F.col(entry).desc_nulls_last()])


def newest_entries(log: DataFrame, n: int, entry: str = "log_id") -> DataFrame:
    return log.orderBy(F.col(entry).desc_nulls_first()).limit(n)


def require_none(violations: Callable[[DataFrame], DataFrame], rule: str) -> Callable[[DataFrame], None]:
    """A publish check: fails if ``violations`` finds a row, and quotes one of them."""

    def check(df: DataFrame) -> None:
        found = violations(df).first()
        if found is not None:
            raise ConstraintViolation(f"{rule}: {found.asDict()}")

    return check


def primary_key_check(id_column: str) -> Callable[[DataFrame], None]:
    return require_none(lambda df: key_violations(df, id_column), f"primary key {id_column}")


def unique_text_check(key: str, id_column: str) -> Callable[[DataFrame], None]:
    """Trimmed business keys are unique; the unknown member does not count."""
    return require_none(
        lambda df: unique_violations(df, [F.trim(key)], F.col(id_column) != DEFAULT_KEY), f"unique {key}"
    )


def one_active_check(key: str, id_column: str) -> Callable[[DataFrame], None]:
    condition = (F.col(id_column) != DEFAULT_KEY) & is_set(F.col("is_active"))
    return require_none(lambda df: unique_violations(df, [F.trim(key)], condition), f"one active {key}")


def version_check(key: str, id_column: str) -> Callable[[DataFrame], None]:
    condition = F.col(id_column) != DEFAULT_KEY
    return require_none(
        lambda df: unique_violations(df, [F.trim(key), F.col("start_dt")], condition), f"unique {key}, start_dt"
    )


def unique_column_check(column: str, id_column: str) -> Callable[[DataFrame], None]:
    condition = F.col(id_column) != DEFAULT_KEY
    return require_none(lambda df: unique_violations(df, [F.col(column)], condition), f"unique {column}")
