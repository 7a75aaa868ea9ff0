"""Linear classifiers by the squared hinge loss, one per class against the rest, all of them fitted together.

The objective of a class is ``penalty + C * sum(max(0, 1 - z * (w . x + b))^2)`` with z = 1 for its rows and -1 for
all others; the penalty is ``|w|^2 / 2`` or ``|w|_1``, and the constant b is penalised like any weight. Every pass
sums loss, slopes and curvature inside the tasks; sums of all tasks meet by shuffle in pieces, and only numbers of
the size of the model reach the driver.

* The L2 form takes Newton steps. Curvature tables are held where they are small; beyond ``SQUARE`` numbers the step
  is found by conjugate gradients, each of which is one pass that multiplies the curvature by a direction.
* The L1 form takes proximal Newton steps over a working set of those features that violate the optimality
  conditions most. Features that do not fit into one set come in later rounds, until none violates them.

Labels are whole numbers from 0. A row without a label is left out, a row without a vector is all zeros, and values
that are null or not finite count as 0.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol, HasTol, Param, Params, TypeConverters,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

PIECE = 1024  # numbers of one line of sums
CHUNK = 2048  # rows that a task turns into a matrix at a time
SQUARE = 1 << 22  # numbers in all curvature tables of a task
LARGEST = 1 << 26  # numbers in a model, which every task holds
HALVINGS = 20  # step sizes tried, each half of the one before
CG_STEPS = 40
SWEEPS = 200
_SUMS = "piece int, sums binary"


def entries(vector: Column) -> tuple[Column, Column]:
    """Positions and values of a vector; sparse ones stay as they are."""
    held = F.unwrap_udt(vector)
    values = F.coalesce(held["values"], F.array().cast("array<double>"))
    every = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(held["indices"], every), values


def _flat(at: pa.Array, x: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and value of all entries of two list columns."""
    row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
    values = x.flatten().to_numpy(zero_copy_only=False).astype(float)
    return row, at.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.where(np.isfinite(values), values, 0.0)


@dataclass
class Part:
    """Some rows: labels, and entries in which the constant 1 is the last feature."""

    y: np.ndarray
    row: np.ndarray
    at: np.ndarray
    x: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, features: int) -> Iterator[Part]:
        for start in range(0, batch.num_rows, CHUNK):
            cut = pa.Table.from_batches([batch.slice(start, CHUNK)]).combine_chunks().to_batches()[0]
            row, at, x = _flat(cut.column("at"), cut.column("x"))
            n = cut.num_rows
            yield Part(cut.column("y").to_numpy(), np.concatenate([row, np.arange(n)]),
                       np.concatenate([at, np.full(n, features - 1)]), np.concatenate([x, np.ones(n)]))

    def signs(self, problems: int) -> np.ndarray:
        """(rows, problems): 1 for the rows of a problem's class. Two classes are one problem, of the second class."""
        own = np.array([1]) if problems == 1 else np.arange(problems)
        return np.where(self.y[:, None] == own[None, :], 1.0, -1.0)

    def times(self, w: np.ndarray) -> np.ndarray:
        """(rows, problems): the rows multiplied by each problem's weights."""
        return np.stack([np.bincount(self.row, v[self.at] * self.x, len(self.y)) for v in w], axis=1)

    def back(self, factors: np.ndarray, features: int) -> np.ndarray:
        """(problems, features): the sum of the rows, each times its factor."""
        return np.stack([np.bincount(self.at, f[self.row] * self.x, features) for f in factors.T])

    def matrix(self, place: np.ndarray, size: int) -> np.ndarray:
        """The rows with the features that have a place."""
        found, held = np.zeros((len(self.y), size)), place[self.at] >= 0
        np.add.at(found, (self.row[held], place[self.at[held]]), self.x[held])
        return found


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, dtype=float) for v in group.column("sums").to_pylist())
    return pa.table({"piece": pa.array([group.column("piece")[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


class Problem:
    """Training rows, written once, and the sums over them."""

    def __init__(self, df: DataFrame, features_col: str, label_col: str, c: float):
        at, x = entries(F.col(features_col))
        size = F.unwrap_udt(F.col(features_col))["size"].alias("size")
        rows = df.filter(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("y"), at.alias("at"), x.alias("x"), size)
        self.rows = stage(rows, "hinge-rows")
        sizes = self.rows.agg(F.min("y").alias("low"), F.max("y").alias("high"), F.max(F.array_max("at")).alias("last"), F.max("size").alias("size")).first()
        if sizes["high"] is None or sizes["low"] < 0:
            raise ValueError("labels must be whole numbers from 0, and there must be some")
        self.classes = max(2, sizes["high"] + 1)
        self.problems = 1 if self.classes == 2 else self.classes
        self.features = 1 + max(sizes["size"] or 0, 0 if sizes["last"] is None else 1 + sizes["last"])
        self.c = float(c)
        if self.problems * self.features > LARGEST:
            raise ValueError(f"{self.problems} x {self.features} weights do not fit into a task; keep fewer features")
        self.together = max(1, int((SQUARE / self.problems) ** 0.5))  # features of one curvature table

    def _summed(self, length: int, add: Callable[[np.ndarray, Part], None]) -> np.ndarray:
        features = self.features

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for part in Part.of(batch, features):
                    add(total, part)
            starts = range(0, length, PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(starts)), pa.int32()), pa.array([total[s : s + PIECE].tobytes() for s in starts], pa.binary())],
                                             names=["piece", "sums"])

        found = self.rows.mapInArrow(in_task, _SUMS).groupBy("piece").applyInArrow(_add, _SUMS).collect()  # the size of the model
        return np.concatenate([np.frombuffer(r["sums"], dtype=float) for r in sorted(found, key=lambda r: r["piece"])])

    def slopes(self, w: np.ndarray, columns: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Loss and its slopes at ``w``, and its curvature between ``columns`` if given."""
        problems, features, c = self.problems, self.features, self.c
        size = 0 if columns is None else len(columns)
        place = np.full(features, -1)
        if size:
            place[columns] = np.arange(size)
        ends = np.cumsum([problems, problems * features, problems * size * size])

        def add(total: np.ndarray, part: Part) -> None:
            z = part.signs(problems)
            short = np.maximum(1 - z * part.times(w), 0)
            total[: ends[0]] += c * (short**2).sum(axis=0)
            total[ends[0] : ends[1]] += part.back(-2 * c * z * short, features).ravel()
            if size:
                a, curve = part.matrix(place, size), total[ends[1] :].reshape(problems, size, size)
                for k in range(problems):
                    active = a[short[:, k] > 0]
                    curve[k] += 2 * c * active.T @ active

        found = self._summed(int(ends[2]), add)
        curve = found[ends[1] :].reshape(problems, size, size) if size else None
        return found[: ends[0]], found[ends[0] : ends[1]].reshape(problems, features), curve

    def turned(self, w: np.ndarray, direction: np.ndarray) -> np.ndarray:
        """The loss's curvature at ``w`` times ``direction``."""
        problems, features, c = self.problems, self.features, self.c

        def add(total: np.ndarray, part: Part) -> None:
            active = part.signs(problems) * part.times(w) < 1
            total += part.back(2 * c * active * part.times(direction), features).ravel()

        return self._summed(problems * features, add).reshape(problems, features)

    def losses(self, w: np.ndarray, direction: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """(steps, problems): the loss at each step along ``direction``."""
        problems, c = self.problems, self.c

        def add(total: np.ndarray, part: Part) -> None:
            z, at, by = part.signs(problems), part.times(w), part.times(direction)
            for i, t in enumerate(steps):
                total[i * problems : (i + 1) * problems] += c * (np.maximum(1 - z * (at + t * by), 0) ** 2).sum(axis=0)

        return self._summed(problems * len(steps), add).reshape(len(steps), problems)


def _penalty(w: np.ndarray, l1: bool) -> np.ndarray:
    return np.abs(w).sum(axis=1) if l1 else (w**2).sum(axis=1) / 2


def violation(w: np.ndarray, slope: np.ndarray, l1: bool) -> np.ndarray:
    """How far each weight is from its optimality condition, given the loss's slopes."""
    if not l1:
        return np.abs(slope + w)
    return np.where(w != 0, np.abs(slope + np.sign(w)), np.maximum(np.abs(slope) - 1, 0))


def _newton(problem: Problem, w: np.ndarray, slope: np.ndarray, curve: np.ndarray | None) -> np.ndarray:
    """The L2 form's step: solved where the curvature is held, otherwise by conjugate gradients over passes."""
    right = -(slope + w)
    if curve is not None:
        return np.linalg.solve(curve + np.eye(curve.shape[1]), right[..., None])[..., 0]
    found, left, along = np.zeros_like(w), right.copy(), right.copy()
    size = first = (left**2).sum(axis=1)
    for _ in range(CG_STEPS):
        if (size <= 0.01 * first).all():
            break
        turned = along + problem.turned(w, along)
        by = np.divide(size, (along * turned).sum(axis=1), out=np.zeros_like(size), where=size > 0)[:, None]
        found, left = found + by * along, left - by * turned
        new = (left**2).sum(axis=1)
        along = left + np.divide(new, size, out=np.zeros_like(new), where=size > 0)[:, None] * along
        size = new
    return found


def soft_steps(w: np.ndarray, slope: np.ndarray, curve: np.ndarray, tol: float) -> np.ndarray:
    """Change of the weights that is best for slope, curvature and L1 penalty; one coordinate of all problems at a time."""
    diagonal = np.einsum("kii->ki", curve)
    diagonal = diagonal + 1e-8 * np.maximum(diagonal.max(axis=1, keepdims=True), 1e-8)
    new, g = w.copy(), slope.copy()
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(w.shape[1]):
            goal = new[:, j] - g[:, j] / diagonal[:, j]
            goal = np.sign(goal) * np.maximum(np.abs(goal) - 1 / diagonal[:, j], 0)
            by = goal - new[:, j]
            if by.any():
                new[:, j] = goal
                g += curve[:, j, :] * by[:, None]
                moved = max(moved, float(np.abs(by * diagonal[:, j]).max()))
        if moved <= tol:
            break
    return new - w


def fit_weights(problem: Problem, l1: bool, max_iter: int, tol: float) -> np.ndarray:
    """(problems, features): weights whose optimality conditions are off by at most ``tol`` of the first offence, or of 1."""
    w = np.zeros((problem.problems, problem.features))
    narrow = np.arange(problem.features) if problem.features <= problem.together else None
    loss, slope, curve = problem.slopes(w, narrow)
    bar = tol * max(1.0, float(violation(w, slope, l1).max()))
    for _ in range(max_iter):
        off = violation(w, slope, l1)
        if off.max() <= bar:
            break
        if l1:
            columns = narrow
            if narrow is None:
                worst = off.max(axis=0)
                columns = np.sort(np.lexsort((np.arange(len(worst)), -worst))[: problem.together])
                curve = problem.slopes(w, columns)[2]
            step = np.zeros_like(w)
            step[:, columns] = soft_steps(w[:, columns], slope[:, columns], curve, bar / 10)
        else:
            step = _newton(problem, w, slope, curve)
        value = loss + _penalty(w, l1)
        promised = (slope * step).sum(axis=1) + (_penalty(w + step, True) - _penalty(w, True) if l1 else (w * step).sum(axis=1))
        new_loss, new_slope, new_curve = problem.slopes(w + step, narrow)
        slack = 1e-12 * np.maximum(np.abs(value), 1)
        if not (new_loss + _penalty(w + step, l1) <= value + 1e-4 * promised + slack).all():
            steps = 0.5 ** np.arange(1 + HALVINGS)
            tried = problem.losses(w, step, steps) + np.stack([_penalty(w + t * step, l1) for t in steps])
            good = tried <= value + 1e-4 * steps[:, None] * promised + slack
            size = np.where(good.any(axis=0), steps[good.argmax(axis=0)], 0.0)
            if not size.any():
                break  # no class can be bettered in double precision
            step = size[:, None] * step
            new_loss, new_slope, new_curve = problem.slopes(w + step, narrow)
        w, loss, slope, curve = w + step, new_loss, new_slope, new_curve
    return w


class SquaredHingeSvm(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasMaxIter, HasTol, DefaultParamsReadable,
                      DefaultParamsWritable):
    """Linear SVM with squared hinge loss and L2 or L1 ``penalty``."""

    C = Param(Params._dummy(), "C", "inverse regularisation", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l2 or l1", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", C=1.0, penalty="l2", maxIter=100, tol=1e-5):
        super().__init__()
        if penalty not in ("l1", "l2"):
            raise ValueError(f"unknown penalty '{penalty}', must be l1 or l2")
        self._setDefault(C=1.0, penalty="l2", maxIter=100, tol=1e-5)
        self._set(**{"featuresCol": featuresCol, "labelCol": labelCol, **self._input_kwargs})

    def _fit(self, df: DataFrame) -> SquaredHingeModel:
        problem = Problem(df, self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault(self.C))
        w = fit_weights(problem, self.getOrDefault(self.penalty) == "l1", self.getMaxIter(), self.getTol())
        made = SquaredHingeModel().with_weights(np.concatenate([-w, w]) if problem.problems == 1 else w)
        return made._set(**{p: self.getOrDefault(p) for p in ("featuresCol", "predictionCol", "rawPredictionCol")})


class SquaredHingeModel(Model, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """One line of weights per class; the last weight of a line is the constant."""

    packed = Param(Params._dummy(), "packed", "weights as base64 of doubles", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    def with_weights(self, w: np.ndarray) -> SquaredHingeModel:
        return self._set(packed=base64.b64encode(np.ascontiguousarray(w, dtype=float).tobytes()).decode("ascii"), classes=len(w))

    def weights(self) -> np.ndarray:
        held = np.frombuffer(base64.b64decode(self.getOrDefault(self.packed)), dtype=float)
        return held.reshape(self.getOrDefault(self.classes), -1)

    def _transform(self, df: DataFrame) -> DataFrame:
        w = self.weights()

        @F.pandas_udf("array<double>")
        def margins(at: pd.Series, x: pd.Series) -> pd.Series:
            if not len(at):
                return pd.Series([], dtype=object)
            n = len(at)
            row, at, x = _flat(pa.array(at, pa.list_(pa.int32())), pa.array(x, pa.list_(pa.float64())))
            known = at < w.shape[1] - 1
            row, at, x = row[known], at[known], x[known]
            found = np.stack([v[-1] + np.bincount(row, v[at] * x, n) for v in w], axis=1)
            return pd.Series(list(found))

        raw = self.getRawPredictionCol()
        scored = df.withColumn("__margins", margins(*entries(F.col(self.getFeaturesCol()))))
        return scored.withColumns({
            raw: array_to_vector("__margins"),
            self.getPredictionCol(): (F.array_position("__margins", F.array_max("__margins")) - 1).cast("double"),
        }).drop("__margins")
