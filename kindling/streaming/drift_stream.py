"""Drift over a stream: counts kept as state, the six checks after every micro-batch.

The stream's state is one count per (window, feature, value), kept by Spark's stateful aggregation, so it is
mergeable and as large as the different values, not as the rows. Every micro-batch hands on the counts that have
changed; they are written under its ``batch_id``, and the newest count of a value is its total. The reports of the windows
that changed are computed from those totals and the reference's counts, and added to a table of
reports. An entry of the commit log, put last, makes the micro-batch visible; a replay rewrites the same files
and finds its entry, so it changes nothing.

Without ``time_col`` there is one window, ``all``. With it windows are ``window`` long, and rows later than
``watermark`` are left out as Spark's watermark does, so the state of old windows goes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kindling.operators.drift import long_features, report_of_counts
from kindling.operators.model import path_exists
from kindling.sources.commit_log import CommitLog, Conflict
from kindling.sources.files import append_report, read_reports

COUNTS = "win string, feature string, value double, c long"
ALL = "all"


def stream_counts(rows: DataFrame, label_col: str = "label", time_col: str | None = None, window: str = "1 hour",
                  watermark: str = "1 day") -> DataFrame:
    """(win, feature, value, c) of a streaming or batch frame of featurised, scored rows."""
    if time_col is None:
        long = long_features(rows, label_col, [F.lit(ALL).alias("win")])
        return long.groupBy("win", "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    timed = rows.withWatermark(time_col, watermark) if rows.isStreaming else rows
    long = long_features(timed, label_col, [F.col(time_col).alias("_at")])
    counted = long.groupBy(F.window("_at", window).alias("_w"), "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    return counted.select(F.date_format("_w.start", "yyyyMMdd'T'HHmmss").alias("win"), "feature", "value", "c")


def totals(spark: SparkSession, out_dir: str, upto: int) -> DataFrame:
    """The newest count of every (win, feature, value) up to a micro-batch."""
    found = spark.read.option("basePath", f"{out_dir}/counts").schema(f"{COUNTS}, batch_id long").parquet(f"{out_dir}/counts")
    newest = found.where(F.col("batch_id") <= upto).groupBy("win", "feature", "value").agg(F.max_by("c", "batch_id").alias("c"))
    return newest


def make_report_writer(out_dir: str):
    log_dir, reference = f"{out_dir}/commits", f"{out_dir}/reference"

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out_dir}/counts/batch_id={batch_id}")
        here = spark.read.schema(COUNTS).parquet(f"{out_dir}/counts/batch_id={batch_id}")
        # windows that a micro-batch touches, as many as its rows' times span
        touched = sorted(r.win for r in here.select("win").distinct().collect())
        if touched:
            now = totals(spark, out_dir, batch_id).where(F.col("win").isin(touched)).select(F.lit(0).alias("_r"), "feature", "value", "c", "win")
            ref = spark.read.schema("_r int, feature string, value double, c long").parquet(reference)
            at = CommitLog(spark, log_dir).read(batch_id)
            stamp = at["at"] if at else str(spark.sql("SELECT current_timestamp()").first()[0])
            for win in touched:
                append_report(report_of_counts(ref.unionByName(now.where(F.col("win") == win).drop("win"))),
                              f"{out_dir}/reports", f"{win}-{batch_id:08d}", stamp)
            entry = {"windows": touched, "at": stamp}
            try:
                CommitLog(spark, log_dir).put(batch_id, entry)
            except Conflict:   # replayed: the entry must be this batch's own
                if CommitLog(spark, log_dir).read(batch_id)["windows"] != touched:
                    raise
    return process


def start_drift(rows: DataFrame, reference: DataFrame, out_dir: str, checkpoint_dir: str, target_col: str = "target",
                label_col: str = "label", time_col: str | None = None, window: str = "1 hour", watermark: str = "1 day",
                available_now: bool = True) -> StreamingQuery:
    """Start the drift stream of featurised, scored rows against a reference, whose counts are written once."""
    spark = reference.sparkSession
    if not path_exists(spark, f"{out_dir}/reference/_SUCCESS"):
        counts = long_features(reference, target_col).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
        counts.select(F.lit(1).alias("_r"), "feature", "value", "c").write.mode("overwrite").parquet(f"{out_dir}/reference")
    counts = stream_counts(rows, label_col, time_col, window, watermark)
    w = counts.writeStream.outputMode("update").foreachBatch(make_report_writer(out_dir)).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def latest_reports(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest committed report of every window, with ``win`` and ``batch_id``."""
    done = CommitLog(spark, f"{out_dir}/commits").numbers()
    part = F.split("report_id", "-")
    found = read_reports(spark, f"{out_dir}/reports").withColumn("win", part[0]).withColumn("batch_id", part[1].cast("long"))
    found = found.where(F.col("batch_id") <= (done[-1] if done else -1))
    newest = found.groupBy("win").agg(F.max("batch_id").alias("batch_id"))
    return found.join(newest, ["win", "batch_id"])
