"""Classifiers, pipelines from configuration, splits and parameter search."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from functools import partial
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, Param, Params, TypeConverters,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.ml import features, select
from newsloom.ml.boosting import BoostedTrees
from newsloom.ml.hinge import SquaredHingeSvm
from newsloom.operators.ordering import lookup_join
from newsloom.session import stage


CLASSES_AT_ONCE = 4  # classifiers of a one-per-class model that are trained side by side


class _ByC(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, DefaultParamsReadable,
           DefaultParamsWritable):
    """Linear model with the penalty given as ``C``, relative to a summed loss.

    Spark averages the loss, so its penalty is 1 / (rows * C).
    """

    C = Param(Params._dummy(), "C", "inverse regularisation", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", C=1.0, maxIter=100):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(**{"featuresCol": featuresCol, "labelCol": labelCol, **self._input_kwargs})

    def _common(self, df: DataFrame) -> dict[str, Any]:
        return {
            "featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(),
            "predictionCol": self.getPredictionCol(), "maxIter": self.getMaxIter(), "standardization": False,
            "regParam": 1.0 / (df.count() * self.getOrDefault(self.C)),
        }


class Logistic(_ByC):
    """Logistic regression."""

    def _fit(self, df: DataFrame):
        return LogisticRegression(elasticNetParam=0.0, **self._common(df)).fit(df)


class LinearSvm(_ByC):
    """Linear SVM with hinge loss, one classifier per class."""

    def _fit(self, df: DataFrame):
        return OneVsRest(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                         predictionCol=self.getPredictionCol(), parallelism=CLASSES_AT_ONCE,
                         classifier=LinearSVC(**self._common(df))).fit(df)


def boosted_trees(featuresCol: str = "features", labelCol: str = "label", n_estimators: int = 300,
                  learning_rate: float = 0.05, max_depth: int = 6, subsample: float = 0.8,
                  colsample_bytree: float = 0.8, seed: int = 42, **more) -> BoostedTrees:
    """Boosted trees over all classes together, by the names their users know."""
    return BoostedTrees(featuresCol=featuresCol, labelCol=labelCol, maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
                        subsamplingRate=subsample, colsample=colsample_bytree, seed=seed, **more)


# --- pipelines from configuration ---------------------------------------------------------

# fixed values: the names under which stages can be asked for, by kind
STAGES: dict[str, dict[str, Callable[..., Any]]] = {
    "fe": {
        "tfidf": features.Tfidf,
        "count": features.WordCounts, "bow": features.WordCounts, "bag_of_words": features.WordCounts,
        "embed": features.HashedEmbedding, "sbert": features.HashedEmbedding,
    },
    "reducer": {
        "svd": features.Svd, "tsvd": features.Svd, "lsa": features.Svd, "pca": features.Pca,
    },
    "selector": {
        "kbest_chi2": select.SelectChi2, "chi2": select.SelectChi2,
        "kbest_mi": select.SelectMutualInfo, "mutual_info": select.SelectMutualInfo,
        "l1_logreg": select.SelectL1, "l1_svc": partial(select.SelectL1, loss="squared_hinge"),
    },
    "model": {
        "logreg": Logistic, "logistic": Logistic,
        "linearsvc": SquaredHingeSvm, "svm_linear": SquaredHingeSvm, "svm_hinge": LinearSvm,
        "xgb": boosted_trees, "xgboost": boosted_trees,
    },
}


def make_stage(kind: str, name: str, **params: Any):
    """A stage by kind and alias, in any case."""
    kind, name = kind.lower(), name.lower()
    if kind not in STAGES:
        raise ValueError(f"unknown kind '{kind}', must be one of {sorted(STAGES)}")
    if name not in STAGES[kind]:
        raise ValueError(f"unknown {kind} '{name}', must be one of {sorted(STAGES[kind])}")
    return STAGES[kind][name](**params)


def pipeline_from_steps(steps: Mapping[str, Any]) -> Pipeline:
    """Pipeline of stages in the text order of their ids; the last one must predict."""
    if not steps:
        raise ValueError("no steps")
    ordered = [steps[k] for k in sorted(steps)]
    if not ordered[-1].hasParam("predictionCol"):
        raise ValueError(f"last step '{max(steps)}' must be a model")
    return Pipeline(stages=ordered)


def pipeline_from_config(config: Mapping[str, Any]) -> Pipeline:
    """Pipeline from ``{"steps": {id: {"kind": ..., "name": ..., **params}}}``."""
    made = {}
    for step_id, spec in config["steps"].items():
        params = {k: v for k, v in spec.items() if k not in ("kind", "name")}
        made[str(step_id)] = make_stage(spec["kind"], spec["name"], **params)
    return pipeline_from_steps(made)


def pipeline_from_file(path: str) -> Pipeline:
    """Pipeline from a JSON file, or a YAML file where a YAML reader is installed."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            import json

            return pipeline_from_config(json.load(f))
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs the yaml package; give JSON instead") from e
        return pipeline_from_config(yaml.safe_load(f))


# --- splits ----------------------------------------------------------------------------------


_STEP = 12  # bits of the hash that one histogram tells apart
SMALL = 100_000  # rows of a class's range of hashes that are ranked by one task; ``ranges`` divides them


def _hash_cuts(rows: DataFrame, wanted: DataFrame, small: int) -> DataFrame:
    """(label, at, h, key) of the row of each wanted rank, for rows (label, h, key) and wanted (label, at, rank, size).

    The order is that of the hash ``h`` (63 bits), then the key. Histograms of the
    hash lead from the whole class to a range of at most ``small`` rows that holds
    the rank; only that range is sorted. Sums are made before the shuffle.
    """
    still = wanted.select("label", "at", "rank", "size", F.lit(0).cast("long").alias("prefix"))
    found, shift = [], 63
    while True:
        done = shift <= 0
        found.append((still if done else still.filter(F.col("size") <= small), shift))
        still = stage(still.filter(F.col("size") > small), "split-open")
        if done or still.isEmpty():
            break
        here = max(shift - _STEP, 0)
        ranges = F.broadcast(still.select("label", "prefix").distinct())  # one row a class and cut
        counted = rows.withColumn("prefix", F.shiftright("h", shift) if shift < 63 else F.lit(0).cast("long")).join(ranges, ["label", "prefix"]).groupBy(
            "label", "prefix", F.shiftright("h", here).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        seen = F.sum("n").over(Window.partitionBy("label", "prefix").orderBy("bin"))
        counted = counted.withColumn("upto", seen)
        still = stage(still.join(counted, ["label", "prefix"]).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select(
            "label", "at", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("n").alias("size"), F.col("bin").alias("prefix")), "split-open")
        shift = here
    out = None
    for cuts, shift in found:
        ranges = F.broadcast(cuts.select("label", "prefix").distinct())
        inside = rows.withColumn("prefix", F.shiftright("h", shift) if shift < 63 else F.lit(0).cast("long")).join(ranges, ["label", "prefix"])
        ranked = inside.withColumn("rank", F.row_number().over(Window.partitionBy("label", "prefix").orderBy("h", "key")))
        part = ranked.join(F.broadcast(cuts.select("label", "prefix", "rank", "at")), ["label", "prefix", "rank"]).select("label", "at", "h", "key")
        out = part if out is None else out.unionByName(part)
    return out


def _cut_rows(df: DataFrame, label: str, key: str, seed: int, ranks: list, small: int) -> DataFrame:
    """``df`` with ``__passed``, how many of the class's cuts lie before the row; ``ranks`` are columns of ``size``."""
    spot = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 1)
    rows = df.select(F.col(label).alias("label"), spot.alias("h"), F.col(key).alias("key")).filter("label is not null")
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    wanted = sizes.select("label", "size", F.posexplode(F.array(*[r.cast("long") for r in ranks])).alias("at", "rank"))
    wanted = stage(wanted, "split-wanted")
    cuts = _hash_cuts(rows, wanted.filter("rank > 0"), small).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("h", "key"))).alias("__cuts"))
    none = wanted.groupBy("label").agg(F.count_if(F.col("rank") <= 0).alias("__none"))  # cuts before every row
    cuts = none.join(cuts, "label", "left").withColumnRenamed("label", "__label")
    placed = lookup_join(df.withColumn("__label", F.col(label)), cuts, "__label")
    mine = F.struct(spot.alias("h"), F.col(key).alias("key"))
    passed = F.col("__none") + F.coalesce(F.size(F.filter("__cuts", lambda c: c < mine)), F.lit(0))
    return placed.withColumn("__passed", passed).drop("__label", "__cuts", "__none")


def stratified_split(df: DataFrame, label: str, key: str, *, test_size: float = 0.4, seed: int = 42,
                     out: str = "is_test", small: int = SMALL, ranges: int = 1) -> DataFrame:
    """Mark a share of every class as test rows: those up to a cut of the key's hash.

    The share is met exactly per class where keys are not repeated; rows of one key
    are on one side. Rows without a label are marked null. No row moves.
    """
    size = F.floor(F.col("size") * F.lit(test_size) + F.lit(0.5))
    return _cut_rows(df, label, key, seed, [size], small // ranges).withColumn(out, F.col("__passed") < 1).select(*df.columns, out)


def stratified_folds(df: DataFrame, label: str, key: str, *, folds: int = 5, seed: int = 2025, out: str = "fold",
                     small: int = SMALL, ranges: int = 1) -> DataFrame:
    """Deal the rows of every class into folds of sizes that differ by one at most, by ranges of the key's hash."""
    ends = [F.floor(F.col("size") / folds) * i + F.least(F.col("size") % folds, F.lit(i)) for i in range(1, folds)]
    return _cut_rows(df, label, key, seed, ends, small // ranges).withColumn(out, F.col("__passed").cast("int")).drop("__passed")


# --- search -----------------------------------------------------------------------------------


def _param(estimator: Any, name: str) -> Param:
    """``<stage>__<param>`` or ``<param>``; the stage is its place in the pipeline."""
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    where, _, field = name.rpartition("__")
    candidates = [stages[int(where)]] if where else stages
    for stage in candidates:
        inner = stage.getClassifier() if isinstance(stage, OneVsRest) else stage
        if inner.hasParam(field):
            return inner.getParam(field)
    raise ValueError(f"no parameter '{name}'")


def parameter_grid(estimator: Any, space: Mapping[str, Sequence[Any]]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in space.items():
        builder = builder.addGrid(_param(estimator, name), list(values))
    return builder.build()


def grid_search(estimator: Any, space: Mapping[str, Sequence[Any]], train: DataFrame, *, label: str = "label",
                key: str | None = None, folds: int = 5, seed: int = 2025, parallelism: int = 2,
                grid: list[dict] | None = None) -> CrossValidatorModel:
    """Cross-validated search by weighted F1, refitted with the best parameters.

    With ``key`` the folds are stratified by class and repeatable.
    """
    options: dict[str, Any] = {"numFolds": folds, "seed": seed, "parallelism": parallelism}
    if key:
        train = stratified_folds(train, label, key, folds=folds, seed=seed)
        options["foldCol"] = "fold"
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid if grid is not None else parameter_grid(estimator, space),
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="f1"), **options).fit(train)


def random_search(estimator: Any, space: Mapping[str, Sequence[Any]], train: DataFrame, *, draws: int = 20,
                  draw_seed: int = 42, **options) -> CrossValidatorModel:
    """Grid search over a seeded sample of the grid; the whole grid if it is smaller."""
    grid = parameter_grid(estimator, space)
    if len(grid) > draws:
        grid = random.Random(draw_seed).sample(grid, draws)
    return grid_search(estimator, space, train, grid=grid, **options)


SEARCHES = {"grid": grid_search, "random": random_search}


def train_with_search(kind: str, estimator: Any, space: Mapping, train: DataFrame, **options):
    """Search by alias; gives the refitted best model and the search itself."""
    if kind not in SEARCHES:
        raise ValueError(f"unknown search '{kind}'")
    found = SEARCHES[kind](estimator, space, train, **options)
    return found.bestModel, found


def train_with_params(estimator: Any, params: Mapping[str, Any], train: DataFrame):
    return estimator.fit(train, {_param(estimator, k): v for k, v in params.items()})


def search_summary(spark: SparkSession, found: CrossValidatorModel, top_k: int = 20) -> DataFrame:
    """Rows (rank, params, mean, std), best first; ties share a rank."""
    rows = [
        (str({p.name: v for p, v in sorted(m.items(), key=lambda x: x[0].name)}), float(mean), float(std))
        for m, mean, std in zip(found.getEstimatorParamMaps(), found.avgMetrics, found.stdMetrics)
    ]
    ranked = [(1 + sum(other[1] > r[1] for other in rows), *r) for r in rows]
    frame = spark.createDataFrame(ranked, "rank int, params string, mean double, std double")
    return frame.orderBy("rank", "params").limit(top_k)


def best_params(found: CrossValidatorModel) -> dict[str, Any]:
    best = max(range(len(found.avgMetrics)), key=lambda i: found.avgMetrics[i])
    return {p.name: v for p, v in found.getEstimatorParamMaps()[best].items()}
