"""Feature selection: chi-squared, mutual information, L1 coefficients."""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.ml.hinge import SquaredHingeSvm
from newsloom.operators.ordering import lookup_join, ranged_rows, running
from newsloom.session import stage

# --- long form: one row per (row, feature) with a value above zero ---------------------------


def chi2_scores(values: DataFrame, classes: DataFrame, feature: str = "word", value: str = "tf",
                label: str = "label") -> DataFrame:
    """Rows (feature, chi2) from rows (feature, label, value) and one row per item in ``classes``.

    Observed is the sum of a feature in a class; expected is the class's share
    of items times the sum of the feature. Two aggregations, no item-wide rows.
    """
    shares = classes.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    shares = shares.withColumn("__share", F.col("__c") / F.lit(classes.count()))
    observed = values.groupBy(feature, label).agg(F.sum(value).cast("double").alias("__o"))
    # a class without the feature adds its whole expectation, so with o summed over
    # classes: sum((o - e)^2 / e) = sum(o^2 / e) - total, where e = share * total
    parts = lookup_join(observed, shares, label, how="inner").groupBy(feature).agg(
        F.sum(F.col("__o") * F.col("__o") / F.col("__share")).alias("__q"), F.sum("__o").alias("__t"))
    return parts.select(feature, (F.col("__q") / F.col("__t") - F.col("__t")).alias("chi2"))


def mutual_information(values: DataFrame, classes: DataFrame, feature: str = "word", label: str = "label",
                       value: str | None = None) -> DataFrame:
    """Rows (feature, mi), in nats, of discrete feature values against the label.

    ``values`` has one row per item with a value above zero; items without a row
    hold zero. Without ``value`` the feature is its presence.
    """
    level = F.lit(1) if value is None else F.col(value)
    per_class = stage(classes.groupBy(label).agg(F.count(F.lit(1)).alias("__c")), "classes")
    # written once, as several sums are taken over it
    seen = stage(values.groupBy(feature, label, level.cast("string").alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")), "seen")
    # the zero level of each (feature, label) is what the seen levels leave of the class;
    # classes a feature never meets are covered by the totals of the feature
    def xlogx(c):
        return F.when(c > 0, c * F.log(c.cast("double"))).otherwise(F.lit(0.0))

    # n * I = sum nlog n(v,l) - sum mlog m(v) - sum clog c(l) + N log N over all levels v incl. zero
    by_class = seen.groupBy(feature, label).agg(F.sum("__n").alias("__s"), F.sum(xlogx(F.col("__n"))).alias("__j"))
    out = lookup_join(by_class, per_class, label, how="inner").groupBy(feature).agg(
        F.sum("__j").alias("__js"), F.sum("__s").alias("__t"), F.sum(xlogx(F.col("__c") - F.col("__s"))).alias("__zm"),
        F.sum(xlogx(F.col("__c"))).alias("__cm"))
    if value is None:  # one level
        out = out.withColumn("__ls", xlogx(F.col("__t")))
    else:
        by_level = seen.groupBy(feature, "__v").agg(F.sum("__n").alias("__m"))
        out = out.join(by_level.groupBy(feature).agg(F.sum(xlogx(F.col("__m"))).alias("__ls")), feature)
    items = per_class.agg(F.sum("__c")).first()[0] or 0
    # classes not met keep all their items at level zero; their c log c terms cancel
    zeros = (F.lit(items) - F.col("__t")).cast("double")
    total = (
        F.col("__js") + F.col("__zm") - F.col("__cm") - F.col("__ls") - xlogx(zeros)
        + F.lit(items * math.log(items) if items else 0.0)
    )
    return out.select(feature, (total / F.lit(items)).alias("mi"))


# --- continuous features: nearest neighbours on one axis -------------------------------------------


def digamma(n) -> Column:
    """The digamma function of a whole number above zero, to ten digits."""
    n = n.cast("double")
    x = n + 6
    near = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * F.pow(x, F.lit(4.0))) - 1 / (252 * F.pow(x, F.lit(6.0)))
    for i in range(6):
        near = near - 1 / (n + i)
    return near


def _halo(ranged: DataFrame, k: int) -> DataFrame:
    """Copies of the ``k`` rows before and behind each range, as rows of that range (flag ``copy``).

    Only the ends of the ranges reach the driver, 2 k rows of each.
    """
    sizes = Window.partitionBy("__range")
    ends = ranged.withColumn("__rows", F.count(F.lit(1)).over(sizes)).filter((F.col("__in") < k) | (F.col("__in") >= F.col("__rows") - k))
    by_range: dict[int, list] = {}
    for r in ends.select("__range", "__in", "f", "y", "x", "id").orderBy("__range", "__in").collect():
        by_range.setdefault(r["__range"], []).append((r["f"], r["y"], r["x"], r["id"]))
    order, copies = sorted(by_range), []
    for at, name in enumerate(order):
        before, behind = [], []
        for i in range(at - 1, -1, -1):
            before = by_range[order[i]][-(k - len(before)):] + before
            if len(before) == k:
                break
        for i in range(at + 1, len(order)):
            behind += by_range[order[i]][:k - len(behind)]
            if len(behind) == k:
                break
        copies += [(name, *r) for r in before + behind]
    schema = "__range long, f int, y string, x double, id long"
    return ranged.sparkSession.createDataFrame(copies, schema).withColumn("copy", F.lit(True))


def neighbour_distances(points: DataFrame, k: int, ranges: int | None = None) -> DataFrame:
    """(f, y, x, id, r, k): for points (f, y, x, id) the distance to the k-th nearest of their feature and class.

    Points are range-partitioned by (feature, class, value) and sorted once, so a
    class that holds most rows is many tasks; each range also sees ``k`` rows of
    its neighbours. A class of fewer points has fewer neighbours; a point alone in
    its class has none and is left out.
    """
    ranged = ranged_rows(points, ["f", "y", "x", "id"], ranges)
    both = ranged.select("__range", "f", "y", "x", "id", F.lit(False).alias("copy")).unionByName(_halo(ranged, k))
    near = Window.partitionBy("__range").orderBy("f", "y", "x", "id")
    # what is left of a neighbour of another feature or class is null
    same = lambda step: F.when((F.lag("f", step).over(near) == F.col("f")) & (F.lag("y", step).over(near) == F.col("y")),
                               F.abs(F.lag("x", step).over(near) - F.col("x")))
    seen = both.withColumn("d", F.array_sort(F.array_compact(F.array(*[same(s) for s in range(-k, k + 1) if s]))))
    return seen.filter("not copy and size(d) > 0").select(
        "f", "y", "x", "id", F.get("d", F.least(F.size("d"), F.lit(k)) - 1).alias("r"), F.least(F.size("d"), F.lit(k)).alias("k"))


def nearest_mutual_information(values: DataFrame, *, feature: str = "f", value: str = "x", label: str = "label", neighbours: int = 3,
                               ranges: int | None = None) -> DataFrame:
    """Rows (feature, mi), in nats, of continuous values (feature, value, label) against the class.

    For every point the distance to its k-th neighbour of the same class is set
    against how many points of any class are nearer than that. Classes of one row
    and values that are null or not a number are left out. Equal values stay
    equal: where the k-th neighbour is no distance away, its equals are counted.
    """
    rows = values.select(F.col(feature).cast("int").alias("f"), F.col(label).cast("string").alias("y"), F.col(value).cast("double").alias("x"))
    rows = rows.filter("f is not null and y is not null and x is not null and not isnan(x)").withColumn("id", F.monotonically_increasing_id())
    near = stage(neighbour_distances(stage(rows, "mi-values"), neighbours, ranges), "mi-near")
    classes = near.groupBy("f", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(digamma(F.col("k"))).alias("k"))
    per_class = classes.groupBy("f").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("n") * digamma(F.col("n"))).alias("c"))
    # places of both ends of each point's neighbourhood among all points: at equal values an upper end comes
    # before the points and a lower end behind them, and the other way round for a neighbourhood without extent
    wide = F.col("r") > 0
    marks = near.select("f", "id", F.explode(F.array(
        F.struct(F.col("x").alias("x"), F.lit(1).alias("kind"), F.lit(0).alias("sign")),
        F.struct((F.col("x") + F.col("r")).alias("x"), F.when(wide, 0).otherwise(2).alias("kind"), F.lit(1).alias("sign")),
        F.struct((F.col("x") - F.col("r")).alias("x"), F.when(wide, 2).otherwise(0).alias("kind"), F.lit(-1).alias("sign")))).alias("m"))
    marks = marks.select("f", F.col("m.x").alias("x"), F.col("m.kind").alias("kind"), "id", F.col("m.sign").alias("sign"))
    counted = running(marks, ["f", "x", "kind", "id"], (F.col("sign") == 0).cast("long"), "before", ranges=ranges)
    inside = counted.filter("sign <> 0").groupBy("f", "id").agg(F.sum(F.col("sign") * F.col("before")).alias("m"))
    met = inside.groupBy("f").agg(F.sum(digamma(F.col("m"))).alias("m"))
    mi = digamma(F.col("n")) + (F.col("k") - F.col("c") - F.col("m")) / F.col("n")
    return per_class.join(met, "f").select(F.col("f").alias(feature), F.greatest(mi, F.lit(0.0)).alias("mi"))


def top_features(scores: DataFrame, k: int, score: str, feature: str = "word") -> DataFrame:
    return scores.orderBy(F.desc(score), feature).limit(k)


# --- vector form: estimators that fit a VectorSlicer ---------------------------------------------


class _Selector(Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    k = Param(Params._dummy(), "k", "features to keep", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", outputCol="selected", k=10):
        super().__init__()
        self._setDefault(k=10)
        self._set(**{"featuresCol": featuresCol, "labelCol": labelCol, "outputCol": outputCol, **self._input_kwargs})

    def _slicer(self, scores: np.ndarray) -> VectorSlicer:
        best = np.lexsort((np.arange(len(scores)), -np.nan_to_num(scores, nan=-np.inf)))
        keep = sorted(int(i) for i in best[: self.getOrDefault(self.k)])
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(), indices=keep)


class SelectChi2(_Selector):
    """Keep the ``k`` features with the largest chi-squared score."""

    def _fit(self, df: DataFrame) -> VectorSlicer:
        per_class = df.groupBy(self.getLabelCol()).agg(
            F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col(self.getFeaturesCol())).alias("s")).collect()
        observed = np.array([r["s"].toArray() for r in per_class])
        share = np.array([r["n"] for r in per_class], dtype=float)[:, None]
        expected = share / share.sum() * observed.sum(axis=0)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            scores = ((observed - expected) ** 2 / expected).sum(axis=0)
        return self._slicer(scores)


class SelectMutualInfo(_Selector):
    """Keep the ``k`` features with the largest mutual information.

    Dense vectors hold continuous values, taken by nearest ``neighbours`` of the
    same class; sparse ones, such as word counts, hold levels that are counted.
    ``bins`` above zero puts values into as many equal-width bins instead. Only
    one number per feature reaches the driver.
    """

    bins = Param(Params._dummy(), "bins", "bins per feature, 0 for none", TypeConverters.toInt)
    neighbours = Param(Params._dummy(), "neighbours", "neighbours of the same class", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", outputCol="selected", k=10, bins=0, neighbours=3):
        super().__init__(**{"featuresCol": featuresCol, "labelCol": labelCol, "outputCol": outputCol, "k": k})
        self._setDefault(bins=0, neighbours=3)
        self._set(bins=bins, neighbours=neighbours)

    def scores(self, df: DataFrame) -> DataFrame:
        """(f, mi) per feature that has a value."""
        x, y = F.col(self.getFeaturesCol()), F.col(self.getLabelCol()).alias("label")
        first = df.select(x.alias("v")).filter("v is not null").first()
        if first is not None and isinstance(first["v"], SparseVector):
            held = F.transform(vector_to_array(x), lambda v, i: F.struct(i.alias("f"), v.alias("x")))
            rows = stage(df.select(y, F.monotonically_increasing_id().alias("id"), F.filter(held, lambda s: s["x"] != 0).alias("s")), "mi-rows")
            values = rows.select("label", F.explode("s").alias("s")).select("label", "s.f", "s.x")
            return mutual_information(values, rows.select("label"), "f", "label", "x")
        values = df.select(y, F.posexplode(vector_to_array(x)).alias("f", "x"))
        return nearest_mutual_information(values, neighbours=self.getOrDefault(self.neighbours))

    def _fit(self, df: DataFrame) -> VectorSlicer:
        bins = self.getOrDefault(self.bins)
        if not bins:
            found = {r["f"]: r["mi"] for r in self.scores(df).collect()}
            scores = np.zeros(1 + max(found, default=-1))
            for f, mi in found.items():
                scores[f] = mi
            return self._slicer(scores)
        ends = df.select(Summarizer.metrics("min", "max").summary(F.col(self.getFeaturesCol())).alias("s")).select(
            "s.min", "s.max").first()
        low, high = ends["min"].toArray(), ends["max"].toArray()
        width = np.where(high > low, (high - low) / bins, 1.0)
        offsets = F.array(*[F.struct(F.lit(float(a)).alias("lo"), F.lit(float(w)).alias("w"))
                            for a, w in zip(low, width)])
        levels = F.zip_with(
            vector_to_array(F.col(self.getFeaturesCol())), offsets,
            lambda x, o: F.least(F.floor((x - o["lo"]) / o["w"]), F.lit(bins - 1)).cast("int"))
        counts = (
            df.select(F.col(self.getLabelCol()).alias("l"), F.posexplode(levels).alias("f", "v"))
            .groupBy("f", "l", "v").agg(F.count(F.lit(1)).alias("n")).collect()  # features x classes x bins
        )
        classes = {c: i for i, c in enumerate(sorted({r["l"] for r in counts}))}
        table = np.zeros((len(low), len(classes), bins))
        for r in counts:
            table[r["f"], classes[r["l"]], r["v"]] = r["n"]
        p = table / table.sum(axis=(1, 2), keepdims=True)
        independent = p.sum(axis=2, keepdims=True) * p.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            scores = np.where(p > 0, p * np.log(p / independent), 0.0).sum(axis=(1, 2))
        return self._slicer(scores)


class SelectL1(_Selector):
    """Keep features whose summed absolute coefficient in an L1-penalised linear model reaches a threshold.

    ``loss`` is ``logistic`` or ``squared_hinge``; ``threshold`` is ``median``, ``mean`` or a number; ``k`` above zero caps the count.
    """

    threshold = Param(Params._dummy(), "threshold", "median, mean or a number", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "inverse regularisation", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    loss = Param(Params._dummy(), "loss", "logistic or squared_hinge", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", outputCol="selected", k=0, threshold="median",
                 C=1.0, maxIter=50, loss="logistic"):
        if loss not in ("logistic", "squared_hinge"):
            raise ValueError(f"unknown loss '{loss}', must be logistic or squared_hinge")
        super().__init__(featuresCol=featuresCol, labelCol=labelCol, outputCol=outputCol, k=k)
        self._set(threshold=str(threshold), C=float(C), maxIter=maxIter, loss=loss)

    def _weights(self, df: DataFrame) -> np.ndarray:
        """(classes, features)"""
        names = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol(), "maxIter": self.getOrDefault(self.maxIter)}
        c = self.getOrDefault(self.C)
        if self.getOrDefault(self.loss) == "squared_hinge":
            return SquaredHingeSvm(C=c, penalty="l1", **names).fit(df).weights()[:, :-1]
        return LogisticRegression(elasticNetParam=1.0, standardization=False, regParam=1.0 / (df.count() * c), **names).fit(df).coefficientMatrix.toArray()

    def _fit(self, df: DataFrame) -> VectorSlicer:
        weight = np.abs(self._weights(df)).sum(axis=0)
        rule = self.getOrDefault(self.threshold)
        bar = {"median": np.median, "mean": np.mean}.get(rule, lambda w: float(rule))(weight)
        keep = np.flatnonzero(weight >= bar)
        if self.getOrDefault(self.k) > 0:
            keep = sorted(keep[np.argsort(-weight[keep], kind="stable")][: self.getOrDefault(self.k)])
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(),
                            indices=[int(i) for i in keep])
