"""Training jobs: from a feature table to a logged, saved model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.ml.evaluate import classification_report, report_metrics
from newsloom.ml.features import as_vector
from newsloom.ml.models import best_params, make_stage, pipeline_from_steps, search_summary, stratified_split, train_with_search
from newsloom.ml.runs import log_frame, log_run

# fixed values: the searched parameters of the two training jobs
TREE_SPACE = {"max_depth": [4, 6, 8], "learning_rate": [0.03, 0.05, 0.1], "n_estimators": [200, 300]}
TEXT_SPACE = {"C": [0.1, 1.0, 10.0], "maxIter": [100, 200]}
_TREE_PARAMS = {"max_depth": "maxDepth", "learning_rate": "stepSize", "n_estimators": "maxIter"}


def vectors_from_gold(gold: DataFrame) -> DataFrame:
    """(sf_id, features, label) from gold rows; embeddings may be JSON text or arrays."""
    parsed = X.parse_vector(F.col("embedding")) if dict(gold.dtypes)["embedding"] == "string" else F.col("embedding")
    return gold.select("sf_id", as_vector(parsed).alias("features"), F.col("category_encode").alias("label"))


def _train(pipeline: Pipeline, space: Mapping[str, Sequence[Any]], rows: DataFrame, key: str, *, kind: str,
           test_size: float, seed: int, **search_options) -> dict[str, Any]:
    split = stratified_split(rows, "label", key, test_size=test_size, seed=seed).persist()
    try:
        train = split.filter("not is_test").drop("is_test")
        model, found = train_with_search(kind, pipeline, space, train, key=key, **search_options)
        scored = model.transform(split.filter("is_test"))
        report = classification_report(scored.select("label", F.col("prediction").cast("int").alias("prediction")))
        report = rows.sparkSession.createDataFrame(report.collect(), report.schema)  # a few rows per class
    finally:
        split.unpersist()
    return {"model": model, "search": found, "report": report,
            "summary": search_summary(rows.sparkSession, found), "best_params": best_params(found)}


def train_on_vectors(rows: DataFrame, key: str, *, space: Mapping[str, Sequence[Any]] | None = None,
                     kind: str = "grid", test_size: float = 0.4, seed: int = 42, model: str = "xgb",
                     model_params: Mapping[str, Any] | None = None, **search_options) -> dict[str, Any]:
    """Hold-out split, searched boosted trees on vectors, report on the held-out part."""
    space = {_TREE_PARAMS.get(k, k): v for k, v in (space or TREE_SPACE).items()}
    steps = {"1_model": make_stage("model", model, **(model_params or {}))}
    return _train(pipeline_from_steps(steps), space, rows, key, kind=kind, test_size=test_size, seed=seed,
                  **search_options)


def train_on_texts(rows: DataFrame, key: str, *, text: str = "text", space: Mapping[str, Sequence[Any]] | None = None,
                   kind: str = "grid", max_features: int = 500, test_size: float = 0.4, seed: int = 42,
                   **search_options) -> dict[str, Any]:
    """Hold-out split, TF-IDF and searched logistic regression, report on the held-out part."""
    steps = {
        "1_tfidf": make_stage("fe", "tfidf", inputCol=text, outputCol="features", max_features=max_features),
        "2_logreg": make_stage("model", "logreg"),
    }
    return _train(pipeline_from_steps(steps), space or TEXT_SPACE, rows, key, kind=kind, test_size=test_size,
                  seed=seed, **search_options)


def record(trained: Mapping[str, Any], runs_path: str, models_path: str, run_id: str, version: int) -> None:
    """Log parameters and metrics, and save the model under its version."""
    spark = trained["report"].sparkSession
    trained["model"].write().overwrite().save(f"{models_path}/{version}")
    log_run(spark, runs_path, run_id, params=trained["best_params"], tags={"version": version},
            metrics={"best_score": max(trained["search"].avgMetrics)})
    log_frame(report_metrics(trained["report"], "val_"), runs_path, run_id)
