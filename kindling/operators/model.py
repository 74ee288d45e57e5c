"""Representations, classifier, scoring and model persistence.

Both representations end in one ``features`` vector - [text block | 5 scaled
features] - so the comparison isolates the text representation. The
classifier is Spark ML's LogisticRegression configured to minimise the same
objective as an L2 (C = 1) logistic regression with an unpenalised
intercept: regParam = 1 / n_train, no standardisation.

Scoring (``score``) is one code path for batch and streaming DataFrames:
featurise -> represent -> probability -> label, appended to the original
columns. ``kindling.operators.stages`` has the same steps as Spark ML stages.
"""
from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling import config as C
from kindling.operators import features as fe
from kindling.operators import newton
from kindling.operators.embed import l2_normalize
from kindling.operators.scaler import Scaler
from kindling.operators.stages import logistic_model
from kindling.operators.tfidf import TfidfModel, vocabulary
from kindling.operators.vectors import VECTOR_STRUCT, vector_entries, vector_width, written_counts, written_vectors
from kindling.session import materialize
from kindling.sources.commit_log import CommitLog

SCALED = [f"scaled_{f}" for f in C.FEATURE_COLUMNS]


def decided(z, p) -> list:
    """Output columns of a score: prediction = decision > 0 (used for metrics),
    label = probability >= 0.5."""
    return [p.alias("probability"), (z > 0).cast("int").alias("prediction"),
            (p >= C.DECISION_THRESHOLD).cast("int").alias("label")]


def linear_score(df: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """Fixed-weight logistic scoring: probability = sigmoid(b + sum w*x)."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.select("*", *decided(z, p))


@dataclass
class LinearClassifier:
    """Fixed weights over the five features, in the classifier's place: scoring
    jobs with it can be checked exactly."""
    weights: dict[str, float]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        return linear_score(df, self.weights, self.intercept)


@dataclass
class PlainFeatures:
    """Representation that adds nothing to the five features."""
    name: str = "fixed_weights"

    def transform(self, df: DataFrame) -> DataFrame:
        return df


# ---------------------------------------------------------------------------
# representations
# ---------------------------------------------------------------------------
@dataclass
class BaselineRepresentation:
    """TF-IDF(1..2-grams) over cleaned_text + 5 scaled features."""
    name: str = "baseline_tfidf"
    max_features: int = C.TFIDF_MAX_FEATURES
    min_df: int = C.TFIDF_MIN_DF
    tfidf: TfidfModel | None = None
    scaler: Scaler | None = None
    #: A vocabulary that is kept elsewhere, of the rows to fit; else they are counted.
    given: DataFrame | None = None

    def fit(self, train: DataFrame, id_col: str = "id") -> "BaselineRepresentation":
        vocab = self.given if self.given is not None else vocabulary(train, id_col, "cleaned_text", self.max_features, self.min_df)
        self.tfidf = TfidfModel.from_vocab(vocab)
        self.scaler = Scaler.fit(train)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        v = self.tfidf.vectorize(df, "cleaned_text", "_text_vec")
        v = v.select("*", *self.scaler.columns())
        out = VectorAssembler(inputCols=["_text_vec", *SCALED], outputCol="features").transform(v)
        return out.drop("_text_vec", *SCALED)

    def counted(self, df: DataFrame, target_col: str) -> DataFrame:
        """What ``transform`` makes its vectors of: (y, counts of terms, scaled features), written."""
        v = self.tfidf.counts(df, "cleaned_text", "_tf").select(target_col, "_tf", *self.scaler.columns())
        return written_counts(v, target_col, "_tf", SCALED)

    @property
    def width(self) -> int:
        return self.tfidf.size + len(C.FEATURE_COLUMNS)

    def to_json(self) -> dict:
        return {"kind": "baseline", "name": self.name, "max_features": self.max_features,
                "min_df": self.min_df, "scaler": self.scaler.__dict__}


@dataclass
class CandidateRepresentation:
    """Pre-computed sentence embedding (L2-normalised) + 5 scaled features."""
    name: str = "candidate_embedding"
    embedding_col: str = "embedding"
    scaler: Scaler | None = None

    def fit(self, train: DataFrame, id_col: str = "id") -> "CandidateRepresentation":
        self.scaler = Scaler.fit(train)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        v = df.select("*", array_to_vector(l2_normalize(self.embedding_col)).alias("_emb"),
                      *self.scaler.columns())
        out = VectorAssembler(inputCols=["_emb", *SCALED], outputCol="features").transform(v)
        return out.drop("_emb", *SCALED)

    def to_json(self) -> dict:
        return {"kind": "candidate", "name": self.name, "embedding_col": self.embedding_col,
                "scaler": self.scaler.__dict__}


# ---------------------------------------------------------------------------
# classifier + scoring
# ---------------------------------------------------------------------------
@dataclass
class TriageModel:
    representation: object
    classifier: LogisticRegressionModel
    meta: dict = field(default_factory=dict)
    #: Score rows that already carry features without cleaning them again.
    trust_features: bool = False

    def score(self, df: DataFrame, keep_prediction: bool = False) -> DataFrame:
        """Original columns + probability + label (existing ones replaced)."""
        original = [c for c in df.columns if c not in ("probability", "label", "prediction")]
        # carry the original columns through under private names
        tagged = df.select("*", *[F.col(c).alias(f"_o_{c}") for c in original])
        feat = fe.ensure_features(tagged) if self.trust_features else fe.build_features(tagged)
        scored = self.classifier.transform(self.representation.transform(feat))
        cols = [F.col(f"_o_{c}").alias(c) for c in original]
        if isinstance(self.classifier, LinearClassifier):
            probability, prediction, label = (F.col(c) for c in ("probability", "prediction", "label"))
        else:
            p = vector_to_array("probability").getItem(1)
            z = vector_to_array("rawPrediction").getItem(1)
            probability, prediction, label = decided(z, p)
        cols += [probability.alias("probability"), label.alias("label")]
        if keep_prediction:
            cols.append(prediction.alias("prediction"))
        return scored.select(*cols)


def fit(representation, train: DataFrame, target_col: str = "target", id_col: str = "id") -> TriageModel:
    """Fit the representation, write the training vectors once in parallel, then
    minimise over that table. Its tasks follow the written bytes; cleaning and
    vectorising keep the input's parallelism."""
    representation.fit(train, id_col)
    if isinstance(representation, BaselineRepresentation) and representation.tfidf.size:
        vectors, width, units = representation.counted(train, target_col), representation.width, np.array(representation.tfidf.idf)
    else:
        vectors, units = written_vectors(representation.transform(train), target_col, "features"), None
        width = vector_width(vectors)
    found = newton.minimise(vectors, width, 1 / C.LR_C, units=units)
    meta = {"n_train": found.rows, "name": representation.name, "passes": found.passes, "max_gradient": found.max_gradient}
    return TriageModel(representation, logistic_model(found.coefficients, found.intercept), meta)


def gradient_norm(model: TriageModel, train: DataFrame, target_col: str = "target") -> DataFrame:
    """(n, max_gradient): largest partial derivative of the mean penalised loss at
    the model's coefficients. It vanishes at the minimum of this convex objective."""
    rows = model.representation.transform(model_features(train)).select(
        F.col(target_col).cast("double").alias("_y"), "features")
    scored = model.classifier.transform(rows)
    residual = vector_to_array("probability").getItem(1) - F.col("_y")
    written = materialize(scored.select(residual.alias("r"), "features"), "residuals", schema=f"r double, features {VECTOR_STRUCT}")
    sums = vector_entries(written, "r", "features").groupBy("idx").agg(F.sum(F.col("r") * F.col("value")).alias("g"))
    n = written.count()   # from the file footers
    coefficients = train.sparkSession.createDataFrame(
        [(k, float(w)) for k, w in enumerate(model.classifier.coefficients.toArray())], "idx int, w double")
    slopes = coefficients.join(sums, "idx", "left").select(
        (F.coalesce(F.col("g"), F.lit(0.0)) / n + F.col("w") * (C.LR_C / n)).alias("g"))
    intercept = written.agg((F.sum("r") / n).alias("g"))
    return slopes.unionByName(intercept).agg(F.lit(n).cast("long").alias("n"), F.max(F.abs("g")).alias("max_gradient"))


def model_features(df: DataFrame) -> DataFrame:
    return fe.ensure_features(df)


def predict_one(spark: SparkSession, model: TriageModel, text: str, keyword: str | None = None) -> dict:
    """Score a single text through the same path as batches."""
    df = spark.createDataFrame([(text, keyword)], "text string, keyword string")
    row = model.score(df).first()
    return {"label": int(row["label"]), "probability": float(row["probability"])}


# ---------------------------------------------------------------------------
# persistence (Spark writers only, so shared file systems work)
# ---------------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_model(spark: SparkSession, model: TriageModel, path: str) -> str:
    rep = model.representation
    meta = dict(model.meta, representation=rep.to_json())
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")
    if isinstance(rep, BaselineRepresentation):
        spark.createDataFrame(list(zip(rep.tfidf.terms, range(rep.tfidf.size), rep.tfidf.idf)),
                              "term string, idx int, idf double").write.mode(
            "overwrite").parquet(f"{path}/vocabulary")
    model.classifier.write().overwrite().save(f"{path}/classifier")
    return path


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that the root's commit log names last, None without an entry."""
    _, entry = CommitLog(spark, root).latest()
    return entry and entry["version"]


def promote(spark: SparkSession, root: str, version: str, based_on: int, **more) -> int:
    """Make a complete ``version`` the current one, if the log still ends at entry ``based_on``; else
    ``Conflict``. ``more`` is kept in the entry."""
    return CommitLog(spark, root).commit({"version": version, **more}, based_on)


def resolved(spark: SparkSession, root: str) -> str:
    """The folder of the current version, or ``root`` itself if it has no versions."""
    version = current_version(spark, root)
    return f"{root}/versions/{version}" if version else root


def load_model(spark: SparkSession, path: str) -> TriageModel:
    path = resolved(spark, path)
    if not path_exists(spark, f"{path}/meta"):
        raise FileNotFoundError(
            f"no model at {path} - train one first (kindling.plans.jobs.train_baseline)")
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    rj = meta["representation"]
    scaler = Scaler(**rj["scaler"])
    if rj["kind"] == "baseline":
        vocab = spark.read.parquet(f"{path}/vocabulary")
        rep = BaselineRepresentation(name=rj["name"], max_features=rj["max_features"],
                                     min_df=rj["min_df"], tfidf=TfidfModel.from_vocab(vocab),
                                     scaler=scaler)
    else:
        rep = CandidateRepresentation(name=rj["name"], embedding_col=rj["embedding_col"],
                                      scaler=scaler)
    clf = LogisticRegressionModel.load(f"{path}/classifier")
    return TriageModel(rep, clf, meta)
