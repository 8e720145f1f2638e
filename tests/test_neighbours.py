"""Nearest neighbours among copies: ties go to the smaller id, whatever the blocks."""

import numpy as np
import pytest

from retentia.operators import knn
from retentia.operators.knn import nearest


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_ties_of_copies_go_to_the_smaller_id(spark, block_rows):
    x = np.random.default_rng(1).integers(0, 3, size=(150, 3)).astype(float)
    x[20:90] = x[3]  # more copies than a block and than k + 1
    x[100:104] = x[5]  # fewer copies than k
    x[100] *= -1  # zeros of either sign are equal
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    got = sorted((r.id, r["rank"], r.nn) for r in nearest(df, 3, block_rows).collect())
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    want = [(i, k + 1, int(j)) for i in range(len(x)) for k, j in enumerate(np.argsort(dist[i], kind="stable")[:3])]
    assert got == want


def test_groups_equal_all_pairs_with_far_points_and_a_hot_cell(spark, monkeypatch):
    """Groups of several cells, a crowded place, far points that seek apart, and large offsets; no point is copied to a group twice."""
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(300, 4)), rng.normal(size=(200, 4)) * 1e-3 + 2, rng.normal(size=(25, 4)) * 40]) + 1e6
    df = spark.createDataFrame([(3 * i - 100, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    monkeypatch.setattr(knn, "CELL_ROWS", 16)
    monkeypatch.setattr(knn, "MEET_CELLS", 2)
    got = sorted((r.id, r["rank"], r.nn, r.d) for r in nearest(df, 4, 20).collect())
    square = np.zeros((len(x), len(x)))
    for j in range(4):
        square += (x[:, j : j + 1] - x[None, :, j]) ** 2
    np.fill_diagonal(square, np.inf)
    want = [(3 * i - 100, k + 1, 3 * int(j) - 100, float(np.sqrt(square[i, j]))) for i in range(len(x)) for k, j in enumerate(np.argsort(square[i], kind="stable")[:4])]
    assert got == sorted(want)


def test_seekers_meet_batches_in_any_order_and_twice():
    rng = np.random.default_rng(4)
    x, ids = rng.integers(0, 6, size=(700, 3)).astype(float), np.arange(700)
    one, two = knn._Seekers(ids[:90], x[:90], 5), knn._Seekers(ids[:90], x[:90], 5)
    one.meet(ids, x)
    for part in (slice(400, 700), slice(0, 3), slice(0, 500), slice(380, 420)):
        two.meet(ids[part], x[part])
    key = ["id", "rank"]
    assert one.found().sort_values(key).reset_index(drop=True).equals(two.found().sort_values(key).reset_index(drop=True))
    assert len(one.found()) == 450
