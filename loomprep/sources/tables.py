"""Reading the input tables (one parquet dataset per table name)."""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# row key of each table, used to spread a scan that yields too few splits
KEYS = {"documents": "doc_id", "conversations": "conv_id", "embeddings": "vec_id",
        "events": "event_id", "pages": "page_id", "labels": "doc_id", "benchmark": "item_id"}


def spread(df: DataFrame, key: str | None, min_partitions: int | None = None) -> DataFrame:
    """Hash-repartition by ``key`` only when the scan has fewer partitions
    than the cluster's default parallelism (a file with one row group is one
    task).  On large inputs the scan already has many splits and this is a
    no-op, so no shuffle is added there.  Call it on scans only: probing the
    partition count of a plan that contains a shuffle runs that shuffle."""
    if key is None or key not in df.columns:
        return df
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):   # sessions without an RDD view
        return df
    return df.repartition(want, key) if have < want else df


def table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = False) -> DataFrame:
    """One input table by name; ``spread_small`` spreads a scan with too few splits."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, KEYS.get(name)) if spread_small else df
