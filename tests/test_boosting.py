import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from newsloom.ml import features as V
from newsloom.ml.boosting import BoostedTrees, bin_edges


def plain_rounds(x, y, classes, rounds, depth, rate, penalty=1.0, least=1.0):
    """The same trees by the plainest code: every value is a possible cut, nodes are lists of rows."""
    margins, out, losses = np.zeros((len(x), classes)), [], []
    for _ in range(rounds):
        p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        step, trees = np.zeros_like(margins), []
        for k in range(classes):
            g, h = p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k])
            tree, level = {}, {1: np.arange(len(x))}
            for _ in range(depth):
                further = {}
                for node, rows in level.items():
                    whole, best = g[rows].sum() ** 2 / (h[rows].sum() + penalty), (1e-9, None)
                    for f in range(x.shape[1]):
                        for cut in np.unique(x[rows, f])[:-1]:
                            left = rows[x[rows, f] <= cut]
                            right = rows[x[rows, f] > cut]
                            if min(h[left].sum(), h[right].sum()) < least:
                                continue
                            gain = (g[left].sum() ** 2 / (h[left].sum() + penalty) + g[right].sum() ** 2 / (h[right].sum() + penalty) - whole) / 2
                            if gain > best[0] + 1e-6:
                                best = (gain, (f, cut, left, right))
                    if best[1]:
                        f, cut, left, right = best[1]
                        tree[node] = (f, cut)
                        further[2 * node], further[2 * node + 1] = left, right
                    else:
                        step[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + penalty)
                level = further
            for rows in level.values():
                step[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + penalty)
            trees.append(tree)
        margins += step
        out.append(trees)
    return out, margins, losses


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (240, 4)).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] + x[:, 2] > 9)).astype(int)
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, v array<double>, label int")
    return x, y, rows.select("id", "label", V.as_vector(F.col("v")).alias("features")).repartition(5).cache()


def test_trees_equal_a_plain_version(points):
    x, y, df = points
    model = BoostedTrees(maxIter=3, maxDepth=3, stepSize=0.3, subsamplingRate=1.0, colsample=1.0).fit(df)
    trees, margins, losses = plain_rounds(x, y, 3, 3, 3, 0.3)
    for made, want in zip(model.rounds(), trees):
        for k in range(3):
            got = {n: (f, made["threshold"][k][n]) for n, f in enumerate(made["feature"][k]) if f >= 0}
            assert set(got) == set(want[k])
            for n, (f, cut) in want[k].items():
                # a cut may stand at any value between two neighbours of its node
                assert got[n][0] == f and got[n][1] <= x[:, f].max()
    scored = model.transform(df).select("id", vector_to_array("rawPrediction").alias("m"), "prediction").orderBy("id").collect()
    assert np.allclose([r["m"] for r in scored], margins, atol=1e-5)
    assert [int(r["prediction"]) for r in scored] == margins.argmax(axis=1).tolist()
    assert np.allclose(model.getOrDefault(model.losses)[:3], losses, atol=1e-6)


def test_loss_falls_past_the_written_margins_and_fits_repeat(points):
    _, y, df = points
    make = BoostedTrees(maxIter=13, maxDepth=2, stepSize=0.3)
    one, two = make.fit(df), make.fit(df.repartition(3))
    losses = one.getOrDefault(one.losses)
    assert len(losses) == 14 and losses[-1] < 0.6 * losses[0] and all(b < a + 0.01 for a, b in zip(losses, losses[1:]))
    assert one.getOrDefault(one.trees) == two.getOrDefault(two.trees)
    right = one.transform(df).filter("prediction = label").count()
    assert right / len(y) > 0.9


def test_saved_in_a_pipeline(points, tmp_path):
    _, _, df = points
    model = Pipeline(stages=[BoostedTrees(maxIter=2, maxDepth=2)]).fit(df)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pick = lambda m: m.transform(df).select("id", "prediction", vector_to_array("probability")).orderBy("id").collect()
    assert pick(model) == pick(again) and all(abs(sum(r[2]) - 1) < 1e-9 for r in pick(model))


def test_edges_and_odd_input(spark):
    rows = spark.createDataFrame([([1.0, float("nan")],), ([2.0, 5.0],), ([3.0, 5.0],)], "x array<double>")
    first, second = bin_edges(rows, 8)
    assert first.tolist() == [1.0, 2.0] and second.tolist() == []
    df = spark.createDataFrame([(0, [1.0, float("nan")]), (1, [2.0, 5.0]), (None, [3.0, 4.0])], "label int, v array<double>")
    df = df.select("label", V.as_vector(F.col("v")).alias("features"))
    assert BoostedTrees(maxIter=1, maxDepth=1).fit(df).transform(df).count() == 3
    with pytest.raises(ValueError):
        BoostedTrees(maxIter=1).fit(df.filter("label is null"))
