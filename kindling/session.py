"""Spark session helpers.

The engine never owns cluster configuration: on a cluster the session comes
from the launcher. ``get_spark`` is for local runs and tests only.
Intermediates are tables in the folder named by ``spark.checkpoint.dir``,
which all executors share; ``clean_up`` deletes those of this process.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # vocab / scaler / size tables are small and bounded; the default 10 MB
    # threshold stays, everything else goes sort-merge.
}

#: Folders in the shared folder, and catalog tables over them, that this process has made.
_MADE: list[str] = []
_TABLES: list[str] = []


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "kindling", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("KINDLING_MASTER", "local[8]"))
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("KINDLING_DRIVER_MEMORY", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to a shared (HDFS/S3/...) path; only a local
    session, where driver and executors are one process, gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="kindling-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    path = ensure_checkpoint_dir(spark).rstrip("/") + "/" + name
    _MADE.append(path)
    return path


def materialize(df: DataFrame, name: str, schema=None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: one job, lineage cut, and the files survive executor loss. ``schema``
    reads the files by other types that fit them."""
    path = work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def temporary_table(name: str) -> str:
    """Note a catalog table over a folder of ``work_dir``; ``clean_up`` drops it."""
    _TABLES.append(name)
    return name


def clean_up(spark: SparkSession) -> int:
    """Delete the intermediates of this process; call it when no DataFrame that
    reads them is still wanted. Returns how many were deleted."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{_TABLES.pop()}`")
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _MADE:
        p = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def reuse(df: DataFrame) -> DataFrame:
    """Keep a pre-aggregated intermediate that several jobs read: a written
    table, so nothing stays in executor memory and a lost executor costs nothing."""
    return materialize(df, "reuse")


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if the planner's estimate of its size is at most
    ``limit`` bytes; beyond that it stays unhinted and a shuffle join is planned."""
    from pyspark.sql import functions as F

    from kindling import config as C
    limit = C.BROADCAST_BYTES_LIMIT if limit is None else limit
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(size) <= limit else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the key columns of ``left`` are kept."""
    from functools import reduce

    from pyspark.sql import functions as F
    renamed = right.select(*[F.col(c).alias(f"_j_{c}" if c in keys else c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_j_{k}" for k in keys])
