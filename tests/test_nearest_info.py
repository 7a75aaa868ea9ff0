import math
import random

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from newsloom.ml import select as C


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain(points, k):
    """Mutual information of one feature, (x, label) pairs, by all distances."""
    sizes = {}
    for _, y in points:
        sizes[y] = sizes.get(y, 0) + 1
    held = [(x, y) for x, y in points if sizes[y] > 1]
    near, mine, met = 0.0, 0.0, 0.0
    for i, (x, y) in enumerate(held):
        ds = sorted(abs(x - u) for j, (u, v) in enumerate(held) if v == y and j != i)
        used = min(k, len(ds))
        r = ds[used - 1]
        near += psi(used)
        mine += psi(sizes[y])
        met += psi(sum(abs(x - u) < r or (r == 0 and u == x) for u, _ in held))
    n = len(held)
    return max(0.0, psi(n) + (near - mine - met) / n)


def test_scores_equal_a_plain_version_across_range_borders(spark):
    draw = random.Random(8)
    points = {f: [] for f in range(3)}
    for _ in range(150):
        y = draw.choice("aaaab")
        points[0].append((draw.gauss(0 if y == "a" else 2, 1), y))
        points[1].append((float(draw.randint(0, 4)), y))  # many equal values
        points[2].append((draw.random(), y))
    points[0].append((9.0, "alone"))
    rows = [(f, x, y) for f, ps in points.items() for x, y in ps] + [(0, None, "a"), (0, float("nan"), "a"), (0, 1.0, None)]
    df = spark.createDataFrame(rows, "f int, x double, label string")
    for ranges in (1, 40):
        got = {r["f"]: r["mi"] for r in C.nearest_mutual_information(df, ranges=ranges).collect()}
        for f, ps in points.items():
            assert math.isclose(got[f], plain(ps, 3), abs_tol=1e-9), (ranges, f)


def test_selector_takes_dense_vectors_by_neighbours_and_sparse_ones_by_levels(spark):
    draw = random.Random(9)
    rows = [(i % 2, [draw.random(), draw.random() + (i % 2), draw.random()]) for i in range(120)]
    dense = spark.createDataFrame(rows, "label int, v array<double>").select("label", array_to_vector("v").alias("features"))
    model = C.SelectMutualInfo(k=1).fit(dense)
    assert list(model.getIndices()) == [1]
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    sparse = spark.createDataFrame(
        [(i % 2, Vectors.sparse(4, {3: 1.0 + i % 2, 1: 1.0})) for i in range(60)],
        T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())]))
    assert list(C.SelectMutualInfo(k=1).fit(sparse).getIndices()) == [3]


def test_digamma(spark):
    got = spark.range(1, 200).select("id", C.digamma(F.col("id")).alias("p")).collect()
    assert all(math.isclose(r["p"], psi(r["id"]), abs_tol=1e-9) for r in got)
