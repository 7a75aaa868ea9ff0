"""Boosted trees of second order: one softmax objective over all classes, histograms summed over tasks.

Features are put into bins once, by quantiles. A round grows one tree per class,
all of them level by level together: each task sums gradient and curvature of its
rows by (class, node, feature, bin), the sums of all tasks meet by shuffle, the
best cut of each feature is found where its sums are, and only one cut per class
and node reaches the driver. Rows stay where they are. Their margins are written
anew every ``KEEP_ROUNDS`` rounds; in between tasks add the newest trees to them.

Gradients are rounded to ``GRAIN``, so that sums do not depend on their order and
a repeated fit gives the same trees. A task holds one sum table: classes x nodes
of a level x features x bins pairs of doubles.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasStepSize, Param,
    Params, TypeConverters,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

KEEP_ROUNDS = 10
GRAIN = 2.0**-24
LEAST_CURVATURE = 1e-16
_STATE = "y int, bins binary, margins binary, pick long"
_SUMS = "class int, node int, feature int, sums binary"
_CUTS = "class int, node int, feature int, gain double, bin int, g_left double, h_left double, g double, h double"


@dataclass
class Round:
    """Trees of one round as heaps: children of node i are 2i and 2i + 1; a feature below zero is a leaf."""

    feature: np.ndarray  # (classes, nodes)
    bin: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(classes: int, depth: int) -> Round:
        shape = (classes, 2 ** (depth + 1))
        return Round(np.full(shape, -1), np.zeros(shape, dtype=np.int64), np.zeros(shape))

    def nodes(self, bins: np.ndarray, k: int, levels: int) -> np.ndarray:
        """The node of class ``k``'s tree that each row is in after so many levels."""
        node, rows = np.ones(len(bins), dtype=np.int64), np.arange(len(bins))
        for _ in range(levels):
            f = self.feature[k][node]
            further = 2 * node + (bins[rows, np.maximum(f, 0)] > self.bin[k][node])
            node = np.where(f >= 0, further, node)
        return node

    def margins(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return np.stack([self.value[k][self.nodes(bins, k, depth)] for k in range(len(self.feature))], axis=1)


def bin_edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Per feature of ``x`` the values that cuts are made behind: quantiles, each once, without the largest."""
    points = [i / bins for i in range(1, bins + 1)]
    found = rows.select(F.posexplode("x").alias("f", "v")).filter(~F.isnan("v") & F.col("v").isNotNull()).groupBy("f").agg(
        F.percentile_approx("v", points, 100 * bins).alias("q"), F.max("v").alias("top")).collect()  # features x bins numbers
    edges = {r["f"]: np.unique([x for x in r["q"] if x < r["top"]]) for r in found}
    width = 1 + max(edges, default=-1)
    return [edges.get(f, np.empty(0)) for f in range(width)]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _binned(edges: list[np.ndarray], classes: int):
    """Rows with a byte or two per feature; a missing or undefined value is in the first bin."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([v + [np.nan] * (len(edges) - len(v)) for v in batch.column("x").to_pylist()], dtype=float).reshape(-1, len(edges))
            bins = np.stack([np.where(np.isnan(x[:, f]), 0, np.searchsorted(e, x[:, f])) for f, e in enumerate(edges)], axis=1).astype(np.uint16)
            zero = np.zeros(classes).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array([zero] * len(bins), pa.binary()),
                 batch.column("pick")], names=["y", "bins", "margins", "pick"])

    return make


def _with_trees(recent: list[Round], depth: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margins = _matrix(batch.column("bins"), np.uint16), _matrix(batch.column("margins"), float).copy()
            for trees in recent:
                margins += trees.margins(bins, depth)
            new = pa.array([r.tobytes() for r in margins], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("margins"), "margins", new)

    return add


def _level_sums(recent: list[Round], trees: Round, level: int, depth: int, features: list[int], edges: list[np.ndarray], share: float, turn: int):
    """A task's sums of gradient and curvature; before the first level also its loss (class -1)."""
    classes, width, first = len(trees.feature), 1 + max((len(e) for e in edges), default=0), 2**level

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, first, len(features), 2, width))
        loss = np.zeros(2)
        for batch in batches:
            y, bins = batch.column("y").to_numpy(), _matrix(batch.column("bins"), np.uint16)
            margins = _matrix(batch.column("margins"), float).copy()
            for known in recent:
                margins += known.margins(bins, depth)
            p = np.exp(margins - margins.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            if level == 0:
                loss += (-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum(), len(y))
            picked = _picked(batch.column("pick").to_numpy(), turn, share)
            bins, p, y = bins[picked], p[picked], y[picked]
            for k in range(classes):
                node = trees.nodes(bins, k, level) - first
                inside = np.flatnonzero(node >= 0)  # others have ended in a leaf above
                g = np.round((p[inside, k] - (y[inside] == k)) / GRAIN) * GRAIN
                h = np.round(np.maximum(2 * p[inside, k] * (1 - p[inside, k]), LEAST_CURVATURE) / GRAIN) * GRAIN
                for i, f in enumerate(features):
                    at = node[inside] * width + bins[inside, f]
                    for j, w in enumerate((g, h)):
                        total[k, :, i, j, :] += np.bincount(at, w, first * width).reshape(first, width)
        met = [(k, n) for k in range(classes) for n in range(first) if total[k, n, :, 1, :].any()]
        out = [(k, n + first, f, total[k, n, i].tobytes()) for k, n in met for i, f in enumerate(features)]
        if level == 0:
            out.append((-1, 0, 0, np.r_[loss, np.zeros(2 * width - 2)].tobytes()))
        if out:
            ks, ns, fs, values = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(ns, pa.int32()), pa.array(fs, pa.int32()), pa.array(values, pa.binary())],
                                             names=["class", "node", "feature", "sums"])

    return sums


def _picked(pick: np.ndarray, turn: int, share: float) -> np.ndarray:
    """Rows of a round's sample, by a hash of the row and the round."""
    if share >= 1:
        return np.ones(len(pick), dtype=bool)
    mixed = (pick.view(np.uint64) ^ np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (mixed >> np.uint64(11)).astype(float) < share * 2.0**53


def best_cut(sums: np.ndarray, penalty: float, least_weight: float) -> tuple[float, int, float, float, float, float]:
    """(gain, bin, left gradient, left curvature, gradient, curvature) of the best cut; gain 0 if there is none."""
    g, h = sums.sum(axis=1)
    left, right = np.cumsum(sums, axis=1)[:, :-1], None
    right = np.array([[g], [h]]) - left
    fits = (left[1] >= least_weight) & (right[1] >= least_weight)
    if not fits.any():
        return 0.0, 0, 0.0, 0.0, g, h
    gain = left[0] ** 2 / (left[1] + penalty) + right[0] ** 2 / (right[1] + penalty) - g**2 / (h + penalty)
    at = int(np.argmax(np.where(fits, gain, -np.inf)))
    return max(float(gain[at]) / 2, 0.0), at, float(left[0, at]), float(left[1, at]), float(g), float(h)


def _cuts(penalty: float, least_weight: float):
    """Best cut per (class, node, feature) from its tasks' sums, which come one after the other."""

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            out = []
            table = _matrix(batch.column("sums"), float)
            names = zip(*(batch.column(c).to_pylist() for c in ("class", "node", "feature")))
            for name, row in zip(names, table):
                if name == key:
                    held = held + row
                    continue
                if key is not None:
                    out.append((*key, *_cut_of(key, held)))
                key, held = name, row
            if out:
                yield _cut_batch(out)
        if key is not None:
            yield _cut_batch([(*key, *_cut_of(key, held))])

    def _cut_of(key, held):
        return (held[0], 0, 0.0, 0.0, 0.0, held[1]) if key[0] < 0 else best_cut(held.reshape(2, -1), penalty, least_weight)

    def _cut_batch(rows):
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.float64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _CUTS.split(", ")])

    return cuts


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasMaxIter, HasStepSize, HasSeed,
                   DefaultParamsReadable, DefaultParamsWritable):
    """Gradient and curvature boosting of one tree per class and round.

    Labels are whole numbers from 0. Rows without a label are left out. A share
    of the rows and one of the features is drawn for every round.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows of a round", TypeConverters.toFloat)
    colsample = Param(Params._dummy(), "colsample", "share of features of a round", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "L2 penalty of a leaf", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least curvature on either side of a cut", TypeConverters.toFloat)
    leastGain = Param(Params._dummy(), "leastGain", "gain that a cut has to exceed", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=300, stepSize=0.05, maxDepth=6, maxBins=256,
                 subsamplingRate=0.8, colsample=0.8, penalty=1.0, leastWeight=1.0, leastGain=0.0, seed=42):
        super().__init__()
        self._setDefault(maxIter=300, stepSize=0.05, maxDepth=6, maxBins=256, subsamplingRate=0.8, colsample=0.8, penalty=1.0,
                         leastWeight=1.0, leastGain=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        depth, get = self.getOrDefault(self.maxDepth), self.getOrDefault
        x = vector_to_array(F.col(self.getFeaturesCol()))
        rows = df.filter(F.col(self.getLabelCol()).isNotNull()).select(F.col(self.getLabelCol()).cast("int").alias("y"), x.alias("x"))
        rows = stage(rows.withColumn("pick", F.xxhash64("y", "x")), "boost-rows")
        ends = rows.agg(F.min("y").alias("low"), F.max("y").alias("high")).first()
        if ends["high"] is None or ends["low"] < 0:
            raise ValueError("labels must be whole numbers from 0, and there must be some")
        classes, edges = ends["high"] + 1, bin_edges(rows, get(self.maxBins))
        if not edges:
            raise ValueError("no features")
        state = stage(rows.mapInArrow(_binned(edges, classes), _STATE), "boost-bins")
        draw, rounds, recent, losses = random.Random(self.getSeed()), [], [], []
        for turn in range(self.getMaxIter()):
            if len(recent) == KEEP_ROUNDS:
                state, recent = stage(state.mapInArrow(_with_trees(recent, depth), _STATE), "boost-bins"), []
            count = max(1, round(get(self.colsample) * len(edges)))
            features = sorted(draw.sample(range(len(edges)), count))
            trees = Round.empty(classes, depth)
            for level in range(depth):
                cuts = self._cuts_of(state, recent, trees, level, features, edges, turn)
                if level == 0:
                    losses += [r["gain"] / max(r["h"], 1) for r in cuts if r["class"] < 0]
                if not self._apply(trees, [r for r in cuts if r["class"] >= 0], level, depth):
                    break
            rounds.append(trees)
            recent.append(trees)
        cuts = self._cuts_of(state, recent, Round.empty(classes, depth), 0, [0], edges, 0)
        losses += [r["gain"] / max(r["h"], 1) for r in cuts if r["class"] < 0]
        return BoostedTreesModel().with_trees(rounds, edges, losses, depth)._copied(self)

    def _cuts_of(self, state: DataFrame, recent: list[Round], trees: Round, level: int, features: list[int], edges: list[np.ndarray], turn: int):
        get = self.getOrDefault
        found = state.mapInArrow(_level_sums(recent, trees, level, get(self.maxDepth), features, edges, get(self.subsamplingRate), turn), _SUMS)
        found = found.repartition("class", "node", "feature").sortWithinPartitions("class", "node", "feature")
        found = found.mapInArrow(_cuts(get(self.penalty), get(self.leastWeight)), _CUTS)
        best = found.groupBy("class", "node").agg(F.max_by(F.struct("feature", "gain", "bin", "g_left", "h_left", "g", "h"),
                                                           F.struct("gain", -F.col("feature"))).alias("cut"))
        return best.select("class", "node", "cut.*").collect()  # one row per class and node of the level

    def _apply(self, trees: Round, cuts: list, level: int, depth: int) -> bool:
        """Enter the level's cuts and the weights of the nodes they make; whether any was made."""
        rate, penalty, any_cut = self.getStepSize(), self.getOrDefault(self.penalty), False
        for r in cuts:
            k, node = r["class"], r["node"]
            if level == 0:
                trees.value[k][node] = -rate * r["g"] / (r["h"] + penalty)
            if level > 0 and trees.feature[k][node // 2] < 0:
                continue
            if r["gain"] <= self.getOrDefault(self.leastGain):
                continue
            any_cut = True
            trees.feature[k][node], trees.bin[k][node] = r["feature"], r["bin"]
            trees.value[k][2 * node] = -rate * r["g_left"] / (r["h_left"] + penalty)
            trees.value[k][2 * node + 1] = -rate * (r["g"] - r["g_left"]) / (r["h"] - r["h_left"] + penalty)
        return any_cut


class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as thresholds on the features' values; ``losses`` is the mean training loss before each round and after the last."""

    trees = Param(Params._dummy(), "trees", "feature, threshold and value of every node, as JSON", TypeConverters.toString)
    losses = Param(Params._dummy(), "losses", "mean training losses", TypeConverters.toListFloat)

    def with_trees(self, rounds: list[Round], edges: list[np.ndarray], losses: list[float], depth: int) -> BoostedTreesModel:
        def thresholds(trees: Round) -> list:
            return [[float(edges[f][b]) if f >= 0 else 0.0 for f, b in zip(fs, bs)] for fs, bs in zip(trees.feature, trees.bin)]

        found = [{"feature": t.feature.tolist(), "threshold": thresholds(t), "value": t.value.tolist()} for t in rounds]
        return self._set(trees=json.dumps({"depth": depth, "rounds": found}), losses=[float(x) for x in losses])

    def _copied(self, made_by: BoostedTrees) -> BoostedTreesModel:
        return self._set(**{p: made_by.getOrDefault(p) for p in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol")})

    def rounds(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))["rounds"]

    def _transform(self, df: DataFrame) -> DataFrame:
        held = json.loads(self.getOrDefault(self.trees))
        depth = held["depth"]
        rounds = [tuple(np.array(r[c]) for c in ("feature", "threshold", "value")) for r in held["rounds"]]
        classes = len(rounds[0][0]) if rounds else 1

        @F.pandas_udf("array<double>")
        def margins(vectors: pd.Series) -> pd.Series:
            x = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 1))
            rows, total = np.arange(len(x)), np.zeros((len(x), classes))
            for feature, threshold, value in rounds:
                for k in range(classes):
                    node = np.ones(len(x), dtype=np.int64)
                    for _ in range(depth):
                        f = feature[k][node]
                        further = 2 * node + (x[rows, np.maximum(f, 0)] > threshold[k][node])
                        node = np.where(f >= 0, further, node)
                    total[:, k] += value[k][node]
            return pd.Series(list(total))

        raw, prob = self.getRawPredictionCol(), self.getProbabilityCol()
        scored = df.withColumn("__margins", margins(vector_to_array(F.col(self.getFeaturesCol()))))
        odds = F.transform("__margins", lambda m: F.exp(m - F.array_max("__margins")))
        scored = scored.withColumn("__odds", odds)
        total = F.aggregate("__odds", F.lit(0.0), lambda a, b: a + b)
        return scored.withColumns({
            raw: array_to_vector("__margins"), prob: array_to_vector(F.transform("__odds", lambda o: o / total)),
            self.getPredictionCol(): (F.array_position("__margins", F.array_max("__margins")) - 1).cast("double"),
        }).drop("__margins", "__odds")
