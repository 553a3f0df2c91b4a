"""Session settings, the shared scratch folder, and cutting lineage through a written table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings for local runs (tests, bench). A cluster brings its own.
LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Columns of sales with nearly as many values as rows, or as customers and products.
MANY_VALUED = frozenset({"payment_id", "order_id", "customer_id", "customer_name", "product_id"})


def local_session(name: str, cores: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster the executors would not
    see a folder on the driver's disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    root = root or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strataload-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for any URI Spark itself can read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the scratch root, removed when the session's file system closes."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    fs, jvm_path = hadoop_path(spark, path)
    fs.deleteOnExit(jvm_path)
    return path


def write_options(columns: Iterable[str]) -> dict[str, str]:
    """How tables and intermediate results are written: zstd, and no dictionary for columns that it would not shorten.

    The writer would build one for every file all the same, and look up every text in it, before it gives it up.
    """
    plain = {f"parquet.enable.dictionary#{name}": "false" for name in columns if name in MANY_VALUED}
    return {"compression": "zstd", **plain}


def materialize(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    The result survives lost executors, is computed once however often it is read, keeps column
    pruning, and carries its real size, so that Spark can decide on broadcasting it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**write_options(df.columns)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
