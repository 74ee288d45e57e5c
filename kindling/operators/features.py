"""Featurisation (one Project shared by batch and streaming scoring)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling import config as C
from kindling.functions import text as tx
from kindling.operators.dedupe import dedupe_labels


def with_optional_keyword(df: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """Absent keyword column -> a null string column (working copy only)."""
    if keyword_col in df.columns:
        return df
    return df.withColumn(keyword_col, F.lit(None).cast("string"))


def feature_columns(text_col: str = "text", keyword_col: str = "keyword") -> list:
    """The cleaned text plus the five features, as named column expressions.
    Features are computed on the *raw* text, the keyword on the raw keyword."""
    t = F.col(text_col)
    return [
        tx.clean_text(t).alias("cleaned_text"),
        tx.word_count(t).alias("word_count"),
        tx.has_url(t).alias("has_url"),
        tx.hashtag_count(t).alias("hashtag_count"),
        tx.mention_count(t).alias("mention_count"),
        tx.has_keyword(F.col(keyword_col)).alias("has_keyword"),
    ]


def build_features(df: DataFrame, text_col: str = "text", keyword_col: str = "keyword") -> DataFrame:
    """All input columns + cleaned_text + 5 int features (existing columns of
    those names are replaced). Keyword may be absent; target is not needed."""
    work = with_optional_keyword(df, keyword_col)
    new = feature_columns(text_col, keyword_col)
    new_names = {"cleaned_text", *C.FEATURE_COLUMNS}
    keep = [F.col(c) for c in df.columns if c not in new_names]
    # a null-filled keyword is only read, never added to the output
    return work.select(*keep, *new)


def ensure_features(df: DataFrame, text_col: str = "text", keyword_col: str = "keyword") -> DataFrame:
    """Reuse-or-compute: featurise only when the features are missing."""
    if "word_count" in df.columns:
        return df
    return build_features(df, text_col, keyword_col)


def clean_and_featurize(df: DataFrame, order_col: str, dedupe: bool = True,
                        text_col: str = "text", target_col: str = "target") -> DataFrame:
    """Dedupe conflicting labels (only when a target column exists), then featurise."""
    work = df
    if dedupe and target_col in df.columns:
        work = dedupe_labels(work, order_col=order_col, text_col=text_col, target_col=target_col)
    return build_features(work, text_col=text_col)


def reject_empty_text(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected): a text must have length >= 1."""
    ok = F.coalesce(F.length(F.col(text_col)) >= 1, F.lit(False))
    accepted = df.where(ok)
    rejected = df.where(~ok).withColumn("reason", F.lit("empty_text"))
    return accepted, rejected
