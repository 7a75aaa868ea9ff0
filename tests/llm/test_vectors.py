"""Searches against brute force, and their defined cases."""

import numpy as np
import pytest
from conftest import rows_of_table

from newsloom.llm import hilbert_search, topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")


def brute(rows, every, k, score):
    ids = np.array([i for i, _ in rows])
    out = []
    for q, v in rows:
        if q % every:
            continue
        s = np.array([score(v, w) for _, w in rows])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out += [(q, r + 1, int(ids[j]), s[j]) for r, j in enumerate(order)]
    return sorted(out)


ODD = [(0, [1.0, 0.5], "x"), (1, None, "x"), (2, [], "x"), (3, [float("nan"), 1.0], "x"), (4, [1.0, None], "x"), (5, [float("inf"), 1.0], "x"),
       (6, [0.0, 0.0], "x"), (None, [1.0, 1.0], "x"), (7, [1.0, 2.0, 3.0], "x"), (8, [0.5, 0.5], "x"), (9, [0.5, 0.5], "x"), (9, [0.5, 0.5], "x"),
       (100, [1.0, -1.0], "x")]


def test_top_k_with_many_ties(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [1.0, 0.0, 0.5] if i % 3 else [float(x) for x in draw.normal(size=3)]) for i in range(900)]
    got = topk.top_k(frame(spark, [(i, v, "x") for i, v in rows]).repartition(6), every=50, k=7, block=5).collect()
    whole = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows]
    assert sorted(map(tuple, got)) == brute(whole, 50, 7, lambda a, b: int((a * b).sum()))


def test_top_k_odd(spark):
    got = [tuple(r) for r in topk.top_k(frame(spark, ODD)).collect()]
    first = [r[2] for r in got if r[0] == 0]
    assert first == [8, 9, 9, 6, 100] or sorted(first) == [6, 8, 9, 9, 100]
    assert {r[0] for r in got} == {0, 100} and topk.top_k(frame(spark, [])).count() == 0


def test_top_k_asks_for_every_row_of_a_repeated_id(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(1, 40)] + [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0])]
    got = topk.top_k(frame(spark, [(i, v, "x") for i, v in rows]), every=50, k=7, block=1).collect()
    asked = [v for i, v in rows if i == 0]
    pairs = sorted((-int(1024 * 1024 * (a[0] * v[0] + a[1] * v[1])), i) for a in asked for i, v in rows if i)[:7]
    assert sorted(map(tuple, got)) == [(0, r + 1, i, -s) for r, (s, i) in enumerate(pairs)]


def test_top_k_bins_do_not_reach_over_the_cut(spark):
    # scores are the first components; the bins of 514 give way to bins of 2, whose 512 would reach 510 scores further
    edge = -131_407 + 514 * 500
    scores = [edge + 520 + i for i in range(9)] + [edge + 3 * i for i in range(150)]
    rows = [(0, [1 / 1024, 0.0]), (1, [0.0, 131_405 / 1024])] + [(i + 2, [s / 1024, 0.0]) for i, s in enumerate(scores)]
    got = topk.top_k(frame(spark, [(i, v, "x") for i, v in rows]), every=1_000).collect()
    whole = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows]
    assert sorted(map(tuple, got)) == brute(whole, 1_000, 10, lambda a, b: int((a * b).sum()))


def test_nearest_asks_for_every_row_of_a_repeated_id(spark):
    rows = [(i, [float(i), 100.0 - i]) for i in range(1, 20)] + [(0, [0.0, 1.0]), (0, [1.0, 0.0])]
    got = hilbert_search.nearest(frame(spark, [(i, v, "x") for i, v in rows]), every=50, k=4, block=1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 99.0), (0, 2, 2, 98.0), (0, 3, 3, 97.0), (0, 4, 4, 96.0)]


def test_products_beyond_floating_point():
    a = np.array([[2**40, 3]], dtype=np.int64)
    b = np.array([[2**20, 1], [2**20, 2]], dtype=np.int64)
    assert topk._products(a, b).tolist() == [[2**60 + 3, 2**60 + 6]]


def test_hilbert_keys_are_a_walk():
    for axes, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * axes)).reshape(axes, -1).T
        keys = hilbert_search.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side**axes))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


@pytest.mark.parametrize("complete", [True, False])
def test_nearest_recall(spark, complete):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(40, 12))
    points = [centres[i % 40] + 0.05 * draw.normal(size=12) for i in range(2_000)]
    rows = [(i, [float(x) for x in p / np.linalg.norm(p)]) for i, p in enumerate(points)]
    got = hilbert_search.nearest(frame(spark, [(i, v, "x") for i, v in rows]), every=20, k=10, complete=complete, block=30).collect()
    want = brute(rows, 20, 10, lambda a, b: float(np.dot(a, b)))
    found = {(r["query_id"], r["vec_id"]) for r in got}
    recall = len(found & {(q, v) for q, _, v, _ in want}) / len(want)
    assert recall == 1.0 if complete else recall >= 0.9


def test_recall_on_the_given_vectors(spark, folder):
    from newsloom.llm.queries import BOOK

    rows = rows_of_table(folder, "select vec_id, embedding from embeddings")
    got = BOOK.queries["op5_hilbert_nearest"](spark, folder).collect()
    want = brute([(i, np.array(v, dtype=float)) for i, v in rows], 20, 20, lambda a, b: float(a @ b))
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found & {(q, v) for q, _, v, _ in want}) / len(want) >= 0.9


def test_nearest_odd(spark):
    got = [tuple(r) for r in hilbert_search.nearest(frame(spark, ODD), every=4).collect()]
    assert [r[2] for r in sorted(got) if r[0] == 0] == [8, 9, 100] and {r[0] for r in got} == {0, 8, 100}
    assert hilbert_search.nearest(frame(spark, [])).count() == 0
