"""Grouped summaries: class distribution, feature summary, order statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.operators.select import moments, ranked_values, wide
from kindling.session import join_null_safe, reuse


def class_distribution(df: DataFrame, target_col: str = "target") -> DataFrame:
    return df.groupBy(target_col).agg(F.count("*").alias("n"))


def to_long(df: DataFrame, columns: list[str], ids: list[str] | None = None,
            name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot ``columns`` into (ids..., name, value) rows (values as double)."""
    cast = df.select(*(ids or []), *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(ids or [], columns, name, value)


def value_counts(long: DataFrame, group_cols: list[str], value: str = "value") -> DataFrame:
    """(group, value, c): one row per distinct value, partial aggregation."""
    return long.where(F.col(value).isNotNull()).groupBy(*group_cols, value).agg(
        F.count("*").alias("c"))


def feature_summary(df: DataFrame, features: list[str]) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 % (linear), max per feature. A feature
    without a value has no row.

    The feature columns are written once, so the work above them is done once;
    moments and quantiles come from radix histograms over that table."""
    long = to_long(reuse(df.select(*features)), features)
    qs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ranks = {f"{k}_{end}": cut(F.lit(q) * (F.col("n") - 1)) for k, q in qs.items() for end, cut in (("lo", F.floor), ("hi", F.ceil))}
    found, first = ranked_values(long, ["feature"], "value", ranks)
    got = moments(first, ["feature"]).join(wide(found, ["feature"], list(ranks)), "feature", "left")
    part = {k: F.lit(q) * (F.col("n") - 1) - F.floor(F.lit(q) * (F.col("n") - 1)) for k, q in qs.items()}
    return got.select("feature", F.col("n").alias("count"), "mean", "std", "min", "max",
                      *[(F.col(f"{k}_lo") + (F.col(f"{k}_hi") - F.col(f"{k}_lo")) * part[k]).alias(k) for k in qs])


def order_statistics(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """n/avg/min/max and p50/p95/p99 = sorted value at 0-based index
    floor(q*n) (p99 clamped to n-1), per group. A group without a value has a
    row with n = 0 and nulls. ``df`` is read once a pass."""
    n = F.col("n")
    ranks = {
        "p50": F.floor(F.lit(0.5) * n),
        "p95": F.floor(F.lit(0.95) * n),
        "p99": F.least(F.floor(F.lit(0.99) * n), n - 1),
    }
    found, first = ranked_values(df, [group_col], value_col, ranks)
    held = moments(first, [group_col]).select(group_col, "n", F.col("mean").alias("avg"), "min", "max")
    held = join_null_safe(held, wide(found, [group_col], list(ranks)), [group_col], "left")
    groups = df.select(group_col).distinct()
    kind = df.schema[value_col].dataType
    return join_null_safe(groups, held, [group_col], "left").select(
        group_col, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "avg", *[F.col(c).cast(kind).alias(c) for c in ("min", "max", *ranks)])
