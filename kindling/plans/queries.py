"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the driver tables (through the projections in
``kindling.plans.views``) in full; SQL twins live in ``kindling.plans.oracle``.
Doubles are rounded to 6 places, counts are BIGINT and flags INT, so results
compare value for value with DuckDB.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling import config as C
from kindling.functions import text as tx
from kindling.operators import features as fe
from kindling.operators.dedupe import dedupe_counts, dedupe_labels
from kindling.operators.drift import drift_report, ks_statistic, positive_rate_drift, rate_drift
from kindling.operators.embed import l2_normalize
from kindling.operators.metrics import (compare, confusion, metrics_by_split, metrics_long,
                                        roc_auc, verdict)
from kindling.operators.model import (BaselineRepresentation, LinearClassifier, PlainFeatures, TriageModel, fit,
                                      gradient_norm, linear_score)
from kindling.operators.pool import TrainingPool
from kindling.operators.retrain import expanded_train, union_with_order
from kindling.operators.scaler import Scaler, scaler_stats
from kindling.operators.split import order_key, stratified_split
from kindling.operators.summary import class_distribution, feature_summary, order_statistics
from kindling.operators.tfidf import term_counts, vocabulary, weights
from kindling.operators.vectors import VECTOR_STRUCT, vector_entries
from kindling.plans import jobs as J
from kindling.plans import views as V
from kindling.session import materialize, work_dir
from kindling.sources.files import read_metrics
from kindling.streaming.drift_stream import latest_reports, start_drift
from kindling.streaming.ingest import READ_BACK, WRITE_CSV, run_ingestion
from kindling.streaming.prediction_log import read_log, start_log_stream

Q = {}

#: Largest partial derivative of the mean loss that counts as converged.
MAX_GRADIENT = 1e-8


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# scalar cleaning / features (P1-P16, F2)
# ---------------------------------------------------------------------------
@register("clean_text")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    m = V.msg(spark, sf)
    return m.select("id", tx.clean_text("text").alias("cleaned_text"))


@register("unescape_pages")
def q_unescape_pages(spark, sf):
    w = V.web(spark, sf)
    dec = tx.html_unescape("html")
    return w.select("page_id", dec.alias("unescaped"), tx.strip_latin1(dec).alias("stripped"))


@register("word_count")
def q_word_count(spark, sf):
    return V.msg(spark, sf).select("id", tx.word_count("text").alias("word_count"))


@register("has_url")
def q_has_url(spark, sf):
    return V.msg(spark, sf).select("id", tx.has_url("text").alias("has_url"))


@register("hashtag_count")
def q_hashtag_count(spark, sf):
    return V.msg(spark, sf).select("id", tx.hashtag_count("text").alias("hashtag_count"))


@register("mention_count")
def q_mention_count(spark, sf):
    return V.msg(spark, sf).select("id", tx.mention_count("text").alias("mention_count"))


@register("has_keyword")
def q_has_keyword(spark, sf):
    return V.msg(spark, sf).select("id", tx.has_keyword("keyword").alias("has_keyword"))


@register("build_features")
def q_build_features(spark, sf):
    return fe.build_features(V.msg(spark, sf))


@register("clean_and_featurize")
def q_clean_and_featurize(spark, sf):
    # dup has no keyword column: it is null-filled for has_keyword only
    return fe.clean_and_featurize(V.dup(spark, sf), order_col="id")


@register("reject_empty_text")
def q_reject_empty_text(spark, sf):
    kw = V.msg(spark, sf).select("id", F.col("keyword").alias("text"))
    ok, bad = fe.reject_empty_text(kw)
    return ok.withColumn("status", F.lit("accepted")).unionByName(
        bad.drop("reason").withColumn("status", F.lit("rejected")))


# ---------------------------------------------------------------------------
# dedupe, grouping, sampling (A1-A11)
# ---------------------------------------------------------------------------
@register("dedupe_labels")
def q_dedupe_labels(spark, sf):
    return dedupe_labels(V.dup(spark, sf), order_col="id")


def labelled_features(spark, sf) -> DataFrame:
    return fe.clean_and_featurize(V.lab(spark, sf), order_col="id")


@register("class_distribution")
def q_class_distribution(spark, sf):
    return class_distribution(labelled_features(spark, sf))


# FIXED VALUES (ours): weights of the two fixed linear scorers used to check
# scoring, metrics, AUC and comparison exactly against SQL. They are dyadic
# fractions, so every weighted sum is exact in binary floating point and
# both engines see the same score ties.
BASELINE_WEIGHTS = {"word_count": 0.00390625, "has_url": 0.875, "hashtag_count": 0.375,
                    "mention_count": -0.25, "has_keyword": 0.625}
BASELINE_INTERCEPT = -2.0
CANDIDATE_WEIGHTS = {"word_count": 0.0029296875, "has_url": 1.125, "hashtag_count": -0.3125,
                     "mention_count": 0.1875, "has_keyword": 0.375}
CANDIDATE_INTERCEPT = -1.875


def labelled_split(spark, sf) -> DataFrame:
    """Dedupe -> split -> featurise. Features are row-wise, so featurising
    after the split is the same result, and each split branch featurises only
    its own rows (the text chain runs once per row). The deduped rows are written
    once, as the split looks at them more than once."""
    deduped = materialize(dedupe_labels(V.lab(spark, sf), order_col="id"), "deduped")
    return fe.build_features(stratified_split(deduped, id_col="id", target_col="target"))


def scored_splits(spark, sf, which: str = "baseline", split: DataFrame | None = None) -> DataFrame:
    w, b = ((BASELINE_WEIGHTS, BASELINE_INTERCEPT) if which == "baseline"
            else (CANDIDATE_WEIGHTS, CANDIDATE_INTERCEPT))
    return linear_score(split if split is not None else labelled_split(spark, sf), w, b)


def scored_batch(spark, sf) -> DataFrame:
    feat = fe.build_features(V.unlabelled(spark, sf))
    return linear_score(feat, BASELINE_WEIGHTS, BASELINE_INTERCEPT)


@register("feature_summary")
def q_feature_summary(spark, sf):
    s = feature_summary(labelled_features(spark, sf), C.FEATURE_COLUMNS)
    return s.select("feature", F.col("count").cast("long").alias("count"),
                    *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("positive_rate_by_split")
def q_positive_rate_by_split(spark, sf):
    return labelled_split(spark, sf).groupBy("split").agg(
        F.count("*").alias("n"), r6(F.avg("target")).alias("positive_rate"))


@register("flagged_by_source")
def q_flagged_by_source(spark, sf):
    return scored_batch(spark, sf).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("label").cast("long").alias("n_flagged"))


@register("seeded_sample")
def q_seeded_sample(spark, sf):
    lf = labelled_features(spark, sf)
    return lf.orderBy(order_key("id"), "id").limit(5).select(
        "id", "text", "cleaned_text", *C.FEATURE_COLUMNS, "target")


@register("order_stats")
def q_order_stats(spark, sf):
    s = order_statistics(V.lat(spark, sf), "event_type", "value")
    return s.select("event_type", F.col("n").cast("long").alias("n"), r6(F.col("avg")).alias("avg"),
                    "min", "max", "p50", "p95", "p99")


@register("stratified_split")
def q_stratified_split(spark, sf):
    return labelled_split(spark, sf).select("id", "target", "split")


# ---------------------------------------------------------------------------
# representations (R1-R10)
# ---------------------------------------------------------------------------
def train_rows(spark, sf) -> DataFrame:
    return labelled_split(spark, sf).where(F.col("split") == "train")


@register("tokens")
def q_tokens(spark, sf):
    m = V.msg(spark, sf).select("id", tx.clean_text("text").alias("cleaned_text"))
    # posexplode_outer: see term_counts (no inferred filter below the exchange)
    return m.select("id", F.posexplode_outer(tx.tokens("cleaned_text")).alias("pos", "token")).where(
        F.col("token").isNotNull()).select("id", F.col("pos").cast("int").alias("pos"), "token")


@register("ngrams")
def q_ngrams(spark, sf):
    m = V.msg(spark, sf).select("id", tx.clean_text("text").alias("cleaned_text"))
    return term_counts(m, "id", "cleaned_text")


@register("vocabulary")
def q_vocabulary(spark, sf):
    v = vocabulary(train_rows(spark, sf), "id")
    return v.select("term", "idx", "df", "ctf", r6(F.col("idf")).alias("idf"))


@register("idf")
def q_idf(spark, sf):
    v = vocabulary(train_rows(spark, sf), "id")
    return v.select("term", r6(F.col("idf")).alias("idf"))


@register("tfidf_weights")
def q_tfidf_weights(spark, sf):
    split = frozen_split(spark, sf)
    v = vocabulary(split.where(F.col("split") == "train"), "id")
    w = weights(split, v, "id")
    return w.select("id", "term", "idx", r6(F.col("weight")).alias("weight"))


@register("scaler_stats")
def q_scaler_stats(spark, sf):
    s = scaler_stats(train_rows(spark, sf))
    return s.select("feature", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@register("scaled_features")
def q_scaled_features(spark, sf):
    split = frozen_split(spark, sf)
    sc = Scaler.fit(split.where(F.col("split") == "train"))
    return split.select("id", *[r6(c).alias(n) for c, n in
                                zip(sc.columns(), [f"scaled_{f}" for f in C.FEATURE_COLUMNS])])


@register("embedding_l2")
def q_embedding_l2(spark, sf):
    v = V.vec(spark, sf)
    return v.select("id", F.posexplode_outer(l2_normalize("embedding")).alias("dim", "x")).where(
        F.col("dim").isNotNull()).select("id", F.col("dim").cast("int").alias("dim"),
                                         r6(F.col("x")).alias("x"))


# ---------------------------------------------------------------------------
# scoring, metrics, comparison (M2-M4, E1-E8)
# ---------------------------------------------------------------------------
@register("score_fixed_weights")
def q_score_fixed_weights(spark, sf):
    s = scored_batch(spark, sf)
    return s.select("id", r6(F.col("probability")).alias("probability"), "label")


@register("confusion")
def q_confusion(spark, sf):
    return confusion(scored_splits(spark, sf), ["split"])


def _metrics(spark, sf, which, split=None):
    m = metrics_by_split(scored_splits(spark, sf, which, split))
    return m.select("split", "tp", "fp", "fn", "tn",
                    *[F.col(c) for c in C.METRIC_ORDER])


@register("metrics_by_split")
def q_metrics_by_split(spark, sf):
    m = _metrics(spark, sf, "baseline")
    return m.select("split", "tp", "fp", "fn", "tn", *[r6(F.col(c)).alias(c) for c in C.METRIC_ORDER])


@register("roc_auc")
def q_roc_auc(spark, sf):
    a = roc_auc(scored_splits(spark, sf), ["split"])
    return a.select("split", r6(F.col("roc_auc")).alias("roc_auc"))


def _comparison(spark, sf):
    split = materialize(labelled_split(spark, sf), "splits")   # written once, scored by both models
    b = metrics_long(_metrics(spark, sf, "baseline", split), "baseline")
    c = metrics_long(_metrics(spark, sf, "candidate", split), "candidate")
    return compare(b, c)


@register("compare_models")
def q_compare_models(spark, sf):
    cmp = _comparison(spark, sf)
    return cmp.select("split", "metric", "metric_rank", *[r6(F.col(c)).alias(c) for c in
                                                           ("baseline", "candidate", "delta")])


@register("promotion_verdict")
def q_promotion_verdict(spark, sf):
    v = verdict(_comparison(spark, sf))
    return v.select(r6(F.col("baseline_f1")).alias("baseline_f1"),
                    r6(F.col("candidate_f1")).alias("candidate_f1"),
                    r6(F.col("delta")).alias("delta"), "promote", "verdict")


# ---------------------------------------------------------------------------
# drift (D1-D8)
# ---------------------------------------------------------------------------
def drift_sides(spark, sf):
    """The reference is the train split, as a monitor job has it."""
    return train_rows(spark, sf), scored_batch(spark, sf)


@register("ks_statistic")
def q_ks_statistic(spark, sf):
    ref, cur = drift_sides(spark, sf)
    k = ks_statistic(ref, cur)
    return k.select("feature", F.col("n_reference").cast("long").alias("n_reference"),
                    F.col("n_current").cast("long").alias("n_current"),
                    r6(F.col("statistic")).alias("statistic"))


@register("rate_drift")
def q_rate_drift(spark, sf):
    ref, cur = drift_sides(spark, sf)
    r = rate_drift(ref, cur)
    return r.select("feature", *[r6(F.col(c)).alias(c) for c in ("reference_rate", "current_rate", "diff")],
                    F.col("flagged").cast("int").alias("flagged"))


@register("positive_rate_drift")
def q_positive_rate_drift(spark, sf):
    ref, cur = drift_sides(spark, sf)
    p = positive_rate_drift(ref, cur)
    return p.select(r6(F.col("reference_rate")).alias("reference_rate"),
                    r6(F.col("current_rate")).alias("current_rate"),
                    F.col("flagged").cast("int").alias("flagged"))


@register("drift_report")
def q_drift_report(spark, sf):
    """All but the p-values and what follows from them, which tests check."""
    ref, cur = drift_sides(spark, sf)
    r = drift_report(ref, cur)
    return r.select("check", "test", *[r6(F.col(c)).alias(c) for c in ("statistic", "reference_rate", "current_rate", "diff")],
                    F.when(F.col("test") != "ks_2samp", F.col("flagged")).alias("rate_flagged"),
                    "n_reference", "n_current", "insufficient_sample")


# ---------------------------------------------------------------------------
# union / expanded train (U1-U2)
# ---------------------------------------------------------------------------
def new_label_batch(spark, sf) -> DataFrame:
    """Reviewer corrections: the unlabelled messages with a parity label."""
    u = V.unlabelled(spark, sf)
    return u.select("id", "keyword", "text", (F.col("id") % 2).cast("int").alias("target"))


@register("union_by_name")
def q_union_by_name(spark, sf):
    train = train_rows(spark, sf).drop("split")
    new = fe.build_features(new_label_batch(spark, sf))
    u = union_with_order(train, [new])
    return u.select("id", "keyword", "text", "source", "target", "cleaned_text",
                    *C.FEATURE_COLUMNS, "_src")


@register("expanded_train")
def q_expanded_train(spark, sf):
    train = train_rows(spark, sf).drop("split")
    new = fe.build_features(new_label_batch(spark, sf))
    return expanded_train(train, [new]).select("id", "keyword", "text", "source", "target",
                                                 "cleaned_text", *C.FEATURE_COLUMNS)


@register("incremental_pool")
def q_incremental_pool(spark, sf):
    """The same pool kept by signed deltas: made of the train rows, then given the batch."""
    train = train_rows(spark, sf).drop("split")
    pool = TrainingPool.create(spark, work_dir(spark, f"pool-{uuid.uuid4().hex}"), train)
    pool.apply(fe.build_features(new_label_batch(spark, sf)))
    return pool.rows().select("id", "keyword", "text", "source", "target", "cleaned_text", *C.FEATURE_COLUMNS)


# ---------------------------------------------------------------------------
# model training, retraining, streaming (rows-only checks)
# ---------------------------------------------------------------------------
def frozen_split(spark, sf) -> DataFrame:
    """The labelled split written once as a table in the session's shared
    checkpoint folder, so the iterative fit and every evaluation read the
    same frozen rows without recomputing the lineage."""
    return materialize(labelled_split(spark, sf), "splits")


@register("train_and_score")
def q_train_and_score(spark, sf):
    _, metrics = J.train_baseline(spark, frozen_split(spark, sf))
    return metrics.select("model", "split", "metric", r6(F.col("value")).alias("value"))


@register("train_gradient")
def q_train_gradient(spark, sf):
    """The objective's gradient at the fitted coefficients vanishes."""
    train = frozen_split(spark, sf).where(F.col("split") == "train").drop("split")
    model = fit(BaselineRepresentation(), train)
    g = gradient_norm(model, train)
    return g.select("n", (F.col("max_gradient") < MAX_GRADIENT).cast("int").alias("converged"))


@register("feature_matrix")
def q_feature_matrix(spark, sf):
    """(id, idx, value): non-zero entries of the baseline's feature vectors."""
    split = frozen_split(spark, sf)
    rep = BaselineRepresentation().fit(split.where(F.col("split") == "train"))
    rows = materialize(rep.transform(split).select("id", "features"), "vectors", schema=f"id long, features {VECTOR_STRUCT}")
    return vector_entries(rows, "id", "features").select("id", "idx", r6(F.col("value")).alias("value"))


def with_vectors(spark, sf) -> DataFrame:
    """The frozen split, each row with the vector whose id is the row's id modulo
    the number of vectors; a row without one is an error."""
    emb = V.vec(spark, sf).select(F.col("id").alias("_vec"), "embedding")
    split = frozen_split(spark, sf)
    bound = materialize(split.join(emb, (F.col("id") % F.lit(emb.count())) == F.col("_vec"), "left").drop("_vec"), "candidate-split")
    lost = bound.where(F.col("embedding").isNull()).count()
    if lost or bound.count() != split.count():
        raise ValueError(f"{lost} labelled rows have no vector of their own")
    return bound


@register("candidate_split_counts")
def q_candidate_split_counts(spark, sf):
    return with_vectors(spark, sf).groupBy("split", "target").agg(F.count("embedding").alias("n"))


@register("candidate_train_and_score")
def q_candidate_train_and_score(spark, sf):
    _, metrics = J.train_candidate(spark, with_vectors(spark, sf))
    return metrics.select("model", "split", "metric", r6(F.col("value")).alias("value"))


def _indented(spark, metrics: dict, path: str) -> str:
    """A metrics document as a person writes it."""
    doc = json.dumps(metrics, indent=2)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


@register("promotion_gate")
def q_promotion_gate(spark, sf):
    """Metrics of two fixed scorers written as documents, read back and gated."""
    base = work_dir(spark, f"gate-{uuid.uuid4().hex}")
    split = frozen_split(spark, sf)
    J.write_metrics(metrics_long(_metrics(spark, sf, "candidate", split), "candidate"), f"{base}/new")
    rows = metrics_long(_metrics(spark, sf, "baseline", split), "baseline").collect()   # 15 numbers
    current = {}
    for r in rows:
        current.setdefault(r["split"], {})[r["metric"]] = r["value"]
    now = _indented(spark, current, f"{base}/current")
    got = J.gate(spark, read_metrics(spark, f"{base}/new"), read_metrics(spark, now))
    return spark.createDataFrame([(got["current_f1"], got["new_f1"], int(got["promoted"]))],
                                 "current_f1 double, new_f1 double, promoted int").select(
        r6(F.col("current_f1")).alias("current_f1"), r6(F.col("new_f1")).alias("new_f1"), "promoted")


@register("retrain_cycle")
def q_retrain_cycle(spark, sf):
    """A cycle against current metrics that any useful model beats by the margin."""
    base = work_dir(spark, f"retrain-{uuid.uuid4().hex}")
    split = frozen_split(spark, sf)
    now = _indented(spark, {"val": {"f1": 0.0}, "test": {"f1": 0.0}}, f"{base}/metrics/baseline")
    summary, metrics = J.retrain_cycle(
        spark, split, [new_label_batch(spark, sf)], model_path=f"{base}/models/baseline",
        metrics_path=now, archive_dir=f"{base}/archive",
        candidate_metrics_dir=f"{base}/metrics/retrain_candidates")
    return metrics.select("model", "split", "metric", r6(F.col("value")).alias("value"),
                          F.lit(summary["promoted"]).cast("int").alias("promoted"))


#: Bytes of messages in an incoming file. CSV with embedded newlines can't be split: a file is a task.
INCOMING_FILE_BYTES = 64 << 20


def _incoming_batch(spark, sf, folder: str, n_files: int = 4) -> None:
    """Drop the unlabelled messages as CSV files (with embedded newlines), ``n_files`` at least."""
    u = V.unlabelled(spark, sf).select("id", "keyword", "text")
    size = u.agg(F.sum(F.coalesce(F.octet_length("keyword"), F.lit(0)) + F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0]
    u.repartition(max(n_files, -(-(size or 0) // INCOMING_FILE_BYTES)), "id").write.mode("overwrite").options(**WRITE_CSV).csv(folder)


def fixed_model() -> TriageModel:
    """The fixed scorer behind the scoring path of all jobs, so that they have SQL twins."""
    return TriageModel(PlainFeatures(), LinearClassifier(BASELINE_WEIGHTS, BASELINE_INTERCEPT), {"name": "fixed_weights"})


@register("ingest_stream")
def q_ingest_stream(spark, sf):
    base = work_dir(spark, f"ingest-{uuid.uuid4().hex}")
    _incoming_batch(spark, sf, f"{base}/incoming")
    done = run_ingestion(spark, f"{base}/incoming", f"{base}/triaged", f"{base}/_checkpoint", fixed_model())
    if sum(d["n"] for d in done) != spark.read.options(**READ_BACK).csv(f"{base}/triaged").count():
        raise ValueError("the run's summary and its outputs differ")
    return spark.read.options(**READ_BACK).csv(f"{base}/triaged").select(
        F.col("id").cast("long").alias("id"), "keyword", "text",
        r6(F.col("probability").cast("double")).alias("probability"), F.col("label").cast("int").alias("label"))


@register("prediction_log")
def q_prediction_log(spark, sf):
    """The log's rows without their time."""
    base = work_dir(spark, f"plog-{uuid.uuid4().hex}")
    model = fixed_model()
    V.unlabelled(spark, sf).write.mode("overwrite").parquet(f"{base}/requests")
    stream = spark.readStream.schema("id long, keyword string, text string, source string, lang string") \
        .parquet(f"{base}/requests")
    q = start_log_stream(model.score(stream), f"{base}/log", f"{base}/_checkpoint", model.meta["name"])
    q.awaitTermination()
    return read_log(spark, f"{base}/log").where(F.col("timestamp").isNotNull()).select(
        "text", "keyword", "label", r6(F.col("probability")).alias("probability"), "model_name")


@register("drift_stream")
def q_drift_stream(spark, sf):
    """The drift report after the last of several micro-batches of the scored batch."""
    base = work_dir(spark, f"drift-{uuid.uuid4().hex}")
    ref, cur = drift_sides(spark, sf)
    cur = cur.select(*C.FEATURE_COLUMNS, "label", F.pmod(F.xxhash64("id"), F.lit(3)).alias("part"))
    cur.repartition(3, "part").drop("part").write.option("maxRecordsPerFile", 1_000_000).parquet(f"{base}/scored")
    rows = spark.readStream.schema(spark.read.parquet(f"{base}/scored").schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/scored")
    start_drift(rows, ref, f"{base}/out", f"{base}/_checkpoint").awaitTermination()
    r = latest_reports(spark, f"{base}/out")
    return r.select("check", "test", *[r6(F.col(c)).alias(c) for c in ("statistic", "reference_rate", "current_rate", "diff")],
                    F.when(F.col("test") != "ks_2samp", F.col("flagged")).alias("rate_flagged"),
                    "n_reference", "n_current", "insufficient_sample")


@register("row_counts")
def q_row_counts(spark, sf):
    """Rows in, distinct texts, rows kept after dedupe, texts dropped: one pass."""
    return dedupe_counts(V.dup(spark, sf), order_col="id")
