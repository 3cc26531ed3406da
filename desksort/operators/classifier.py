"""The TF-IDF and logistic-regression classifier, and a seam for others."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scores
from ..session import materialize, staged
from .certificate import model_table
from .features import build_vocabulary, default_stop_words, vectorizer_stages, with_terms
from .labels import categories_in_order
from .profile import class_weights
from .solver import solve
from .tally import agreement_metrics, per_class, tally


INFO_SCHEMA = (
    "model_type string, confidence_threshold double, num_classes int, categories array<string>, "
    "created_at string, training_time_seconds double, train_accuracy double, train_f1_weighted double"
)


class Scorer(Protocol):
    """What scoring needs of a model: class names in label order, a review
    threshold, and ``probabilities`` (an ``array<double>``) for texts."""

    model_type: str
    categories: Sequence[str]
    threshold: float

    def add_probabilities(self, df: DataFrame, text: str = "text_clean") -> DataFrame: ...


def with_prediction(df: DataFrame, scorer: Scorer) -> DataFrame:
    """``pred``, ``confidence``, the category, the category with
    ``Uncategorized`` below the threshold, and the review flag."""
    names = scores.category_array(scorer.categories)
    conf = scores.confidence(F.col("probabilities"))
    out = df.withColumns({"pred": scores.argmax(F.col("probabilities")), "confidence": conf})
    out = out.withColumn("predicted_category", F.element_at(names, F.col("pred") + 1))
    return out.withColumns({
        "thresholded_category": scores.category_or_uncategorized(
            F.col("predicted_category"), F.col("confidence"), scorer.threshold
        ),
        "needs_manual_review": scores.needs_manual_review(F.col("confidence"), scorer.threshold),
    })


def fit_multinomial(solver: LogisticRegression, vectors: DataFrame, features: int) -> LogisticRegressionModel:
    """``solver``'s model of vectors with ``features`` places, with the settings of
    ``solver``, by fewer passes than its own (see ``solve``)."""
    least, most, total = vectors.agg(F.min("label"), F.max("label"), F.sum("weight")).first()
    if least == most:  # one class: nothing to learn, and no pass either
        return solver.fit(vectors)
    coefficients, intercepts, _ = solve(
        vectors, int(most) + 1, features, total, solver.getRegParam(),
        solver.getMaxIter(), solver.getTol(), solver.getAggregationDepth(),
    )
    matrix = DenseMatrix(*coefficients.shape, coefficients.ravel(order="F"))
    # As pyspark.ml makes models that were not fitted, a CountVectorizerModel for one.
    context = vectors.sparkSession.sparkContext
    made = LogisticRegressionModel._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", solver.uid,
        _py2java(context, matrix), _py2java(context, DenseVector(intercepts)), matrix.numRows, True,
    )
    return solver._copyValues(LogisticRegressionModel(made))


@dataclass
class TicketClassifier:
    """A fitted classifier. ``model`` runs from terms to class probabilities."""

    model: PipelineModel
    categories: list[str]
    threshold: float = scores.REVIEW_THRESHOLD
    stop_words: list[str] = field(default_factory=default_stop_words)
    training_stats: dict = field(default_factory=dict)
    created_at: str = ""
    model_type: str = "baseline"

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        label_map: DataFrame,
        threshold: float = scores.REVIEW_THRESHOLD,
        max_iter: int = 1000,
        tolerance: float = 1e-6,
        max_features: int = 10_000,
        min_df: int = 2,
        max_df: float = 0.95,
        stop_words: Sequence[str] | None = None,
        aggregation_depth: int = 2,
    ) -> TicketClassifier:
        """Fit on ``text_clean`` and ``label``: classes weigh the same, weights
        are shrunk by half their squared length and the intercept is not.

        Texts are tokenised once and the vectors written out; the solver's
        passes (see ``solver``) read them, and a lost executor costs a re-read,
        not a rerun of the tokeniser.
        """
        stop = default_stop_words() if stop_words is None else list(stop_words)
        rows = train.where(F.col("label").isNotNull()).select("text_clean", "label")
        # Terms take several times the room of their texts, and only vectors stay.
        with staged(with_terms(rows, stop_words=stop).drop("text_clean")) as terms:
            vocabulary = build_vocabulary(terms, "terms", max_features, min_df, max_df)
            stages = vectorizer_stages(vocabulary)
            weights = class_weights(terms).select("label", "weight")
            vectors = PipelineModel(stages).transform(
                terms.join(F.broadcast(weights), "label").withColumn("label", F.col("label").cast("double"))
            )
            vectors = materialize(vectors.select("label", "weight", "features"))
        n = vectors.count()
        started = time.monotonic()
        # The weights add up to n, so 1/n weighs the penalty against the sum
        # of losses as a penalty of one half against their plain sum.
        solver = LogisticRegression(
            family="multinomial",
            weightCol="weight",
            regParam=1.0 / n,
            elasticNetParam=0.0,
            standardization=False,
            maxIter=max_iter,
            tol=tolerance,
            aggregationDepth=aggregation_depth,
        )
        fitted = fit_multinomial(solver, vectors, len(stages[0].vocabulary))
        seconds = time.monotonic() - started
        names = categories_in_order(label_map)[: fitted.numClasses]
        out = cls(
            PipelineModel([*stages, fitted]), names, threshold, stop,
            created_at=dt.datetime.now().isoformat(),
        )
        scored = fitted.transform(vectors.select("label", "features")).select(
            F.col("label").cast("int").alias("label"),
            F.col("prediction").cast("int").alias("pred"),
            F.lit(1.0).alias("confidence"),
            F.lit(0).alias("id"),
        )
        fit_scores = agreement_metrics(per_class(tally(scored))).first()
        out.training_stats = {
            "training_time_seconds": seconds,
            "train_accuracy": fit_scores["accuracy"],
            "train_f1_weighted": fit_scores["f1_weighted"],
        }
        return out

    def add_probabilities(self, df: DataFrame, text: str = "text_clean") -> DataFrame:
        scored = self.model.transform(with_terms(df, text, "terms", self.stop_words))
        return scored.withColumn("probabilities", vector_to_array("probability")).drop(
            "terms", "_counts", "_scaled", "features", "rawPrediction", "probability", "prediction"
        )

    def predict(self, df: DataFrame, text: str = "text_clean") -> DataFrame:
        return with_prediction(self.add_probabilities(df, text), self)

    def info(self) -> dict:
        return {
            "model_type": self.model_type,
            "confidence_threshold": self.threshold,
            "num_classes": len(self.categories),
            "categories": self.categories,
            "created_at": self.created_at,
            "training_stats": self.training_stats,
        }

    def info_table(self, spark: SparkSession) -> DataFrame:
        """``info`` as a table of one row."""
        flat = self.info() | self.training_stats
        return spark.createDataFrame([flat], INFO_SCHEMA)

    def save(self, folder: str) -> None:
        """The fitted stages, and beside them the settings as JSON, the same as a
        table, and the coefficients as a table (see ``certificate``)."""
        folder = folder.rstrip("/")
        self.model.write().overwrite().save(f"{folder}/model")
        config = self.info() | {"stop_words": self.stop_words}
        spark = SparkSession.getActiveSession()
        model_table(spark, self).write.mode("overwrite").parquet(f"{folder}/coefficients")
        self.info_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/info")
        line = spark.range(1).select(F.lit(json.dumps(config)).alias("value"))
        line.write.mode("overwrite").text(f"{folder}/config")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> TicketClassifier:
        folder = folder.rstrip("/")
        config = json.loads(spark.read.text(f"{folder}/config").first()["value"])
        return cls(
            PipelineModel.load(f"{folder}/model"),
            config["categories"],
            config["confidence_threshold"],
            config["stop_words"],
            config["training_stats"],
            config["created_at"],
        )


@dataclass
class BatchScorer:
    """Any model that turns a batch of texts into rows of class probabilities.

    ``make_predict`` runs once per Python worker, loads the model there, and
    returns a function from an array of texts to an array (texts x classes).
    Texts reach it over Arrow in batches of ``batch_size``.
    """

    make_predict: Callable
    categories: Sequence[str]
    threshold: float = scores.REVIEW_THRESHOLD
    batch_size: int = 32
    model_type: str = "custom"

    def add_probabilities(self, df: DataFrame, text: str = "text_clean") -> DataFrame:
        score = predict_batch_udf(
            self.make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size
        )
        return df.withColumn("probabilities", score(F.col(text)).cast("array<double>"))

    def predict(self, df: DataFrame, text: str = "text_clean") -> DataFrame:
        return with_prediction(self.add_probabilities(df, text), self)


def load_scorer(spark: SparkSession, model_type: str, folder: str) -> Scorer:
    if model_type != "baseline":
        raise ValueError(f"unknown model type: {model_type}")
    return TicketClassifier.load(spark, folder)
