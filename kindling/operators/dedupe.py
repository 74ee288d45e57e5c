"""Conflicting-duplicate label resolution.

One row per distinct text; its label is the unique most frequent target among
that text's rows (null targets do not vote); a tie, or no vote at all, drops
the text. All other columns come from the text's *first* row by ``order_col``
(rows with a null order come last).

Plan: a two-level aggregate keyed by a 128-bit hash of the text, so no sort or
exchange compares whole texts. Level 1 groups by (text, target) with map-side
partial aggregation: even a text that holds a third of all rows is combined
inside each input task. Level 2 takes the highest and the lowest target among
the most frequent ones; they are equal if the mode is unique. No list of votes
is built, however many targets a text has.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def votes(df: DataFrame, order_col: str, text_col: str = "text", target_col: str = "target") -> DataFrame:
    """One row per (text, target): count of votes, first order and first row."""
    order = F.struct(F.col(order_col).isNull().alias("none"), F.col(order_col).alias("at"))
    row = F.struct(*[F.col(c) for c in df.columns])
    return (df.where(F.col(text_col).isNotNull())
            .groupBy(F.md5(F.col(text_col).cast("binary")).alias("_key"), F.col(target_col).alias("_target"))
            .agg(F.count(target_col).alias("_n"), F.count("*").alias("_rows"),
                 F.min_by(F.struct(order.alias("at"), row.alias("row")), order).alias("_first")))


def resolve(voted: DataFrame, keep_key: bool = False) -> DataFrame:
    """One row per text: its first row, the mode, and whether the mode is unique."""
    per_text = voted.groupBy("_key").agg(
        F.max(F.when(F.col("_n") > 0, F.struct(F.col("_n"), F.col("_target")))).alias("_hi"),
        F.min(F.when(F.col("_n") > 0, F.struct(-F.col("_n"), F.col("_target")))).alias("_lo"),
        F.sum("_rows").alias("_rows"), F.min_by(F.col("_first.row"), F.col("_first.at")).alias("_row"))
    unique = F.col("_hi").isNotNull() & (F.col("_hi._target") == F.col("_lo._target"))
    return per_text.select(*["_key"] * keep_key, "_row", F.col("_hi._target").alias("_mode"), "_rows",
                           F.coalesce(unique, F.lit(False)).alias("_unique"))


def dedupe_labels(df: DataFrame, order_col: str, text_col: str = "text",
                  target_col: str = "target") -> DataFrame:
    resolved = resolve(votes(df, order_col, text_col, target_col)).where("_unique")
    out = [(F.col("_mode").cast("int") if c == target_col else F.col("_row")[c]).alias(c) for c in df.columns]
    return resolved.select(*out)


def dedupe_counts(df: DataFrame, order_col: str, text_col: str = "text", target_col: str = "target") -> DataFrame:
    """(stage, n): rows in, distinct texts, texts kept, texts dropped (a tie or no vote). One pass."""
    nulls = df.where(F.col(text_col).isNull()).agg(F.count("*").alias("_rows")).select(
        "_rows", F.lit(0).alias("_text"), F.lit(False).alias("_unique"))
    texts = resolve(votes(df, order_col, text_col, target_col)).select("_rows", F.lit(1).alias("_text"), "_unique")
    total = texts.unionByName(nulls).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("raw"), F.coalesce(F.sum("_text"), F.lit(0)).cast("long").alias("distinct_texts"),
        F.count_if("_unique").alias("deduped"))
    total = total.withColumn("dropped", F.col("distinct_texts") - F.col("deduped"))
    return total.unpivot([], ["raw", "distinct_texts", "deduped", "dropped"], "stage", "n")
