"""Deterministic projections of the driver tables that exercise the operators.

The documents table carries no URL, hashtag, mention or decodable entity, so
plain bindings would test nothing. Every view below is a pure row-wise
projection (or an equi-join) of the given tables - no row is filtered out,
no text is cut - so its work grows with the tables. Each view has a
character-for-character SQL twin in ``kindling.plans.oracle`` (VIEW_SQL).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.sources.tables import spread, table

# FIXED VALUES for the derived views (shared with the SQL twins).
MOJIBAKE_SNIPPET = " can\x89\xdb\xaat stop"      # repaired to an apostrophe
DASH_SNIPPET = " x\xe5\xcay"                      # repaired to a dash
ENTITY_SNIPPET = " a &amp; b"


def msg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> short-message shape (id, keyword, text) with hashtags,
    mentions, URLs, entities and mojibake attached to the *whole* text."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    i = F.col("doc_id")
    text = F.concat(
        F.repeat(F.concat(F.lit("#"), F.col("source"), F.lit(" ")), (i % 3).cast("int")),
        F.col("text"),
        F.repeat(F.concat(F.lit(" @"), F.col("lang"), F.lit("user")), (i % 4).cast("int")),
        F.when(i % 3 == 0, F.concat(F.lit(" http://t.co/x"), i.cast("string"))).otherwise(F.lit("")),
        F.when(i % 5 == 0, F.lit(ENTITY_SNIPPET)).otherwise(F.lit("")),
        F.when(i % 10 == 0, F.lit(MOJIBAKE_SNIPPET)).otherwise(F.lit("")),
        F.when(i % 10 == 5, F.lit(DASH_SNIPPET)).otherwise(F.lit("")),
    )
    keyword = (
        F.when(i % 7 == 0, F.lit(None).cast("string"))
        .when(i % 7 == 1, F.lit(""))
        .when(i % 7 == 2, F.lit("  "))
        .when(i % 7 == 3, F.lit("\xa0"))
        .otherwise(F.col("source"))
    )
    return d.select(i.alias("id"), keyword.alias("keyword"), text.alias("text"),
                    F.col("source"), F.col("lang"))


def dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a parity label: duplicate texts carry conflicting votes."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(F.col("doc_id").alias("id"), F.col("text"), F.col("source"),
                    (F.col("doc_id") % 2).cast("int").alias("target"))


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msg joined to labels (inner equi-join on the id); target = toxic."""
    lb = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("target"))
    return msg(spark, sf_dir).join(lb, "id", "inner")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msg rows that have no label (left anti join) - the 'incoming' batch."""
    lb = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return msg(spark, sf_dir).join(lb, "id", "left_anti")


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings with a binary target (label < 5)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding"),
                    (F.col("label") < 5).cast("int").alias("target"))


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id").select("page_id", "url", "html")


def lat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), "event_id")
