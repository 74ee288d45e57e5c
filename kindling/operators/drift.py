"""Distribution drift of a current batch against the reference (train) data.

KS statistic for the count features, absolute rate difference for the 0/1
features, predicted-vs-true positive rate. Both sides are tagged and unioned
once, so every statistic comes from one pass and one small shuffle; the KS
CDFs come from the distributed running sum (no single-partition window).
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling import config as C
from kindling.operators.ks import ks_pvalue
from kindling.operators.prefix import running_sums
from kindling.operators.summary import to_long
from kindling.session import reuse


def _tagged(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    ref = reference.select(*[F.col(c).cast("double") for c in cols], F.lit(1).alias("_r"))
    cur = current.select(*[F.col(c).cast("double") for c in cols], F.lit(0).alias("_r"))
    return ref.unionByName(cur)


def _ks_from_counts(per_value: DataFrame, features: list[str]) -> DataFrame:
    """(feature, n_reference, n_current, statistic): a row for every feature, the
    statistic null if a side has no value."""
    cum = running_sums(per_value, ["feature"], "value", ["nr", "nc"])
    gap = F.abs(F.try_divide(F.col("cum_nr"), F.col("total_nr")) - F.try_divide(F.col("cum_nc"), F.col("total_nc")))
    found = cum.groupBy("feature").agg(F.first("total_nr").alias("n_reference"), F.first("total_nc").alias("n_current"),
                                       F.max(gap).alias("statistic"))
    wanted = per_value.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return wanted.join(found, "feature", "left").select(
        "feature", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_reference", "n_current")],
        F.col("statistic").cast("double").alias("statistic"))


def ks_statistic(reference: DataFrame, current: DataFrame,
                 features: list[str] = C.NUMERIC_FEATURES) -> DataFrame:
    """(feature, n_reference, n_current, statistic) - sup |F_ref - F_cur|."""
    long = to_long(_tagged(reference, current, features), features, ids=["_r"]).where(
        F.col("value").isNotNull())
    per_value = long.groupBy("feature", "value").agg(
        F.sum("_r").cast("long").alias("nr"), F.sum(1 - F.col("_r")).cast("long").alias("nc"))
    return _ks_from_counts(per_value, features)


def rate_drift(reference: DataFrame, current: DataFrame,
               features: list[str] = C.RATE_FEATURES) -> DataFrame:
    """(feature, reference_rate, current_rate, diff, flagged)."""
    long = to_long(_tagged(reference, current, features), features, ids=["_r"])
    rates = long.groupBy("feature").agg(
        F.avg(F.when(F.col("_r") == 1, F.col("value"))).alias("reference_rate"),
        F.avg(F.when(F.col("_r") == 0, F.col("value"))).alias("current_rate"))
    diff = F.col("current_rate") - F.col("reference_rate")
    return rates.select("feature", "reference_rate", "current_rate", diff.alias("diff"),
                        F.coalesce(F.abs(diff) > C.RATE_DIFF_THRESHOLD, F.lit(False)).alias("flagged"))


def positive_rate_drift(reference: DataFrame, current: DataFrame, target_col: str = "target",
                        label_col: str = "label") -> DataFrame:
    """Reference true positive rate vs current predicted positive rate."""
    ref = reference.select(F.col(target_col).cast("double").alias("v"), F.lit(1).alias("_r"))
    if label_col in current.columns:
        cur = current.select(F.col(label_col).cast("double").alias("v"), F.lit(0).alias("_r"))
    else:
        cur = current.select(F.lit(None).cast("double").alias("v"), F.lit(0).alias("_r"))
    both = ref.unionByName(cur).agg(
        F.avg(F.when(F.col("_r") == 1, F.col("v"))).alias("reference_rate"),
        F.avg(F.when(F.col("_r") == 0, F.col("v"))).alias("current_rate"))
    has_label = label_col in current.columns
    flag = (F.abs(F.col("current_rate") - F.col("reference_rate")) > C.POSITIVE_RATE_DIFF_THRESHOLD)
    return both.select(
        "reference_rate", "current_rate",
        (F.coalesce(flag, F.lit(False)) if has_label else F.lit(False)).alias("flagged"))


def long_features(df: DataFrame, positive_col: str, ids: list | None = None) -> DataFrame:
    """(ids, feature, value): the five features and the positive-rate column of every row."""
    feats = C.NUMERIC_FEATURES + C.RATE_FEATURES
    positive = F.col(positive_col) if positive_col in df.columns else F.lit(None)
    rows = df.select(*(ids or []), *[F.col(f).cast("double").alias(f) for f in feats], positive.cast("double").alias("positive_rate"))
    names = [c for c in rows.columns if c not in (*feats, "positive_rate")]
    return rows.unpivot(names, feats + ["positive_rate"], "feature", "value")


def drift_counts(reference: DataFrame, current: DataFrame, target_col: str = "target",
                 label_col: str = "label") -> DataFrame:
    """One pass over both sides: (side, feature, value, count) for the five
    features plus the positive-rate column (true target on the reference,
    predicted label on the current batch). Partial aggregation before the
    shuffle, and the result is tiny (distinct values only)."""
    long = long_features(reference, target_col, [F.lit(1).alias("_r")]).unionByName(long_features(current, label_col, [F.lit(0).alias("_r")]))
    return long.groupBy("_r", "feature", "value").agg(F.count("*").alias("c"))


REPORT_SCHEMA = (
    "check string, test string, statistic double, p_value double, reference_rate double, current_rate double, diff double, "
    "flagged int, n_reference long, n_current long, insufficient_sample int, any_drift int")


def drift_report(reference: DataFrame, current: DataFrame, target_col: str = "target",
                 label_col: str = "label") -> DataFrame:
    """Report: always the six checks (3 KS, 2 rates, positive_rate), with the
    batch header (sizes, insufficient_sample) and any_drift repeated. A check
    without data on a side has nulls and no flag. Every statistic comes from one
    ``drift_counts`` table."""
    return report_of_counts(reuse(drift_counts(reference, current, target_col, label_col)))


def report_of_counts(counts: DataFrame) -> DataFrame:
    """The report of a table (_r, feature, value, c), 1 for the reference and 0 for the
    batch. Its seven summary rows come to the driver, which finishes the p-values, so
    no task needs this package."""
    spark = counts.sparkSession
    c, v, is_ref = F.col("c"), F.col("value"), F.col("_r") == 1

    per_value = counts.where(F.col("feature").isin(C.NUMERIC_FEATURES) & v.isNotNull()).groupBy(
        "feature", "value").agg(F.sum(F.when(is_ref, c).otherwise(0)).alias("nr"),
                                F.sum(F.when(~is_ref, c).otherwise(0)).alias("nc"))
    ks = {r["feature"]: r for r in _ks_from_counts(per_value, C.NUMERIC_FEATURES).collect()}

    def mean(side):
        return F.try_divide(F.sum(F.when(side & v.isNotNull(), c * v)), F.sum(F.when(side & v.isNotNull(), c)))

    sizes = counts.groupBy("feature").agg(
        mean(is_ref).alias("ref"), mean(~is_ref).alias("cur"), F.sum(F.when(is_ref, c).otherwise(0)).alias("nr"),
        F.sum(F.when(~is_ref, c).otherwise(0)).alias("nc"))
    rates = {r["feature"]: r for r in sizes.collect()}
    head = rates.get(C.NUMERIC_FEATURES[0])   # nulls are counted: every row has one value of each feature
    n_ref, n_cur = (int(head["nr"]), int(head["nc"])) if head else (0, 0)

    rows = []
    for f in C.NUMERIC_FEATURES:
        p = ks_pvalue(ks[f]["statistic"], ks[f]["n_reference"], ks[f]["n_current"])
        p = None if math.isnan(p) else p
        rows.append((f, "ks_2samp", ks[f]["statistic"], p, None, None, None, p is not None and p < C.KS_P_VALUE_THRESHOLD))
    for f in [*C.RATE_FEATURES, "positive_rate"]:
        ref, cur = (rates[f]["ref"], rates[f]["cur"]) if f in rates else (None, None)
        diff = None if ref is None or cur is None else cur - ref
        limit = C.POSITIVE_RATE_DIFF_THRESHOLD if f == "positive_rate" else C.RATE_DIFF_THRESHOLD
        rows.append((f, "positive_rate" if f == "positive_rate" else "rate_diff", None, None, ref, cur, diff,
                     diff is not None and abs(diff) > limit))
    any_drift = int(any(r[-1] for r in rows))
    return spark.createDataFrame(
        [(*r[:-1], int(r[-1]), n_ref, n_cur, int(n_cur < C.MIN_BATCH_SIZE), any_drift) for r in rows], REPORT_SCHEMA).coalesce(1)


def report_document(report: DataFrame) -> dict:
    """The report as one document: header, ``feature_flags`` by feature, positive rate."""
    rows = {r["check"]: r for r in report.collect()}   # six rows
    head, flags = rows["positive_rate"], {}
    for f in C.NUMERIC_FEATURES:
        flags[f] = {k: rows[f][k] for k in ("test", "statistic", "p_value")} | {"flagged": bool(rows[f]["flagged"])}
    for f in C.RATE_FEATURES:
        flags[f] = {k: rows[f][k] for k in ("test", "reference_rate", "current_rate", "diff")} | {"flagged": bool(rows[f]["flagged"])}
    scored = head["current_rate"] is not None   # an unscored batch has no positive rate on either side
    return {"n_reference": head["n_reference"], "n_current": head["n_current"],
            "insufficient_sample": bool(head["insufficient_sample"]), "feature_flags": flags,
            "positive_rate_reference": head["reference_rate"] if scored else None,
            "positive_rate_current": head["current_rate"], "positive_rate_flagged": bool(head["flagged"])}
