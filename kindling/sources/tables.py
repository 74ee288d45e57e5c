"""Table sources: the parquet tables of a scale-factor folder."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread rows over the cluster's cores when a scan is
    under-partitioned (e.g. one parquet row group = one task). A planning-time
    check only: at scale the scan already has >= parallelism splits and this
    is a no-op. Hashing on the row key keeps the result deterministic and
    satisfies any later grouping / window clustered on that key."""
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)
