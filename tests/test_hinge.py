import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from newsloom.ml import hinge as H
from newsloom.ml import models as M

C = 0.7


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 240)
    x = rng.normal(size=(240, 7)) + np.eye(3, 7)[y] * 1.5
    x[rng.random(x.shape) < 0.4] = 0
    made = [(i, int(c), Vectors.dense(v) if i % 2 else Vectors.sparse(7, {int(f): float(v[f]) for f in np.flatnonzero(v)}))
            for i, (c, v) in enumerate(zip(y, x))]
    return np.hstack([x, np.ones((240, 1))]), y, spark.createDataFrame(made, ["id", "label", "features"]).repartition(5)


def objective(x, z, w, l1):
    short = np.maximum(1 - z * (x @ w), 0)
    return (np.abs(w).sum() if l1 else w @ w / 2) + C * (short**2).sum(), -2 * C * x.T @ (z * short)


def plain(x, z, l1, turns=20000):
    """Proximal gradient steps of a fixed length."""
    w, step = np.zeros(x.shape[1]), 1 / (2 * C * np.linalg.norm(x, 2) ** 2 + 1)
    for _ in range(turns):
        _, g = objective(x, z, w, l1)
        w = w - step * g if l1 else w - step * (g + w)
        if l1:
            w = np.sign(w) * np.maximum(np.abs(w) - step, 0)
    return w


@pytest.mark.parametrize("penalty", ["l2", "l1"])
@pytest.mark.parametrize("square", [H.SQUARE, 3])
def test_equals_plain_descent(data, penalty, square, monkeypatch):
    """Also where curvature tables hold one feature only, so that conjugate gradients and working sets are used."""
    monkeypatch.setattr(H, "SQUARE", square)
    x, y, rows = data
    turns = 100 if square > 3 else 400
    w = H.SquaredHingeSvm(C=C, penalty=penalty, tol=1e-7 if square > 3 else 1e-4, maxIter=turns).fit(rows).weights()
    if penalty == "l1" and square == 3:
        for k in range(3):  # slow, so held against the conditions of an optimum
            _, g = objective(x, np.where(y == k, 1.0, -1.0), w[k], True)
            assert H.violation(w[k], g, True).max() < 0.05
        return
    for k in range(3):
        expected = plain(x, np.where(y == k, 1.0, -1.0), penalty == "l1")
        assert np.allclose(w[k], expected, atol=1e-4), (k, w[k], expected)


def test_scores_and_reloads(data, tmp_path):
    x, y, rows = data
    model = H.SquaredHingeSvm(C=C).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    got = {r["id"]: r for r in H.SquaredHingeModel.load(str(tmp_path / "m")).transform(rows).collect()}
    margins = x @ model.weights().T
    assert np.allclose([got[i]["rawPrediction"].toArray() for i in range(len(x))], margins)
    assert [got[i]["prediction"] for i in range(len(x))] == margins.argmax(axis=1).tolist()


def test_two_classes_are_one_problem(data):
    x, y, rows = data
    w = H.SquaredHingeSvm(C=C, tol=1e-8).fit(rows.withColumn("label", (rows["label"] > 0).cast("int"))).weights()
    assert np.allclose(w[0], -w[1]) and np.allclose(w[1], plain(x, np.where(y > 0, 1.0, -1.0), False), atol=1e-4)


def test_odd_rows(spark):
    v = Vectors
    rows = [(0, v.dense([1.0, 2.0])), (1, v.dense([-1.0, float("nan")])), (1, None), (None, v.dense([9.0, 9.0])), (0, v.sparse(2, [], []))]
    df = spark.createDataFrame(rows, ["label", "features"])
    scored = H.SquaredHingeSvm().fit(df).transform(df).collect()
    assert len(scored) == 5 and all(np.isfinite(r["rawPrediction"].toArray()).all() for r in scored)
    with pytest.raises(ValueError):
        H.SquaredHingeSvm().fit(df.filter("label is null"))
    with pytest.raises(ValueError):
        H.SquaredHingeSvm(penalty="l3")


def test_selection_drops_noise(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    x = np.hstack([(2.0 * y - 1)[:, None] + rng.normal(size=(300, 1)), rng.normal(size=(300, 5)) * 0.1])
    df = spark.createDataFrame([(int(a), Vectors.dense(b)) for a, b in zip(y, x)], ["label", "features"])
    kept = M.make_stage("selector", "l1_svc", C=0.05, threshold="mean").fit(df).getIndices()
    assert kept == [0]
    assert isinstance(M.make_stage("model", "linearsvc"), H.SquaredHingeSvm)
