"""Append-only prediction log: UTC timestamp, text, keyword, label,
probability, model name - for batches (append write) or streams (file sink)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def log_columns(scored: DataFrame, model_name: str) -> DataFrame:
    kw = F.col("keyword") if "keyword" in scored.columns else F.lit(None).cast("string")
    return scored.select(F.current_timestamp().alias("timestamp"), F.col("text"), kw.alias("keyword"),
                         F.col("label").cast("long").alias("label"),
                         F.col("probability").cast("double").alias("probability"),
                         F.lit(model_name).alias("model_name"))


def log_predictions(scored: DataFrame, log_dir: str, model_name: str) -> None:
    log_columns(scored, model_name).write.mode("append").json(log_dir)


def start_log_stream(scored_stream: DataFrame, log_dir: str, checkpoint_dir: str,
                     model_name: str, available_now: bool = True) -> StreamingQuery:
    w = (log_columns(scored_stream, model_name).writeStream.format("json")
         .option("path", log_dir).option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def read_log(spark, log_dir: str) -> DataFrame:
    return spark.read.schema(
        "timestamp timestamp, text string, keyword string, label long, probability double, "
        "model_name string").json(log_dir)
