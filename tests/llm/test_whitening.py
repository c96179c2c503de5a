"""Whitening against a plain eigen-decomposition, and its cases."""

import numpy as np
import pytest

from dugout.llm import whitening


def plain(vectors):
    x = np.unique(np.floor(64 * vectors) + 1_000_000, axis=0)
    y = x - x.mean(axis=0)
    e, v = np.linalg.eigh(y.T @ y / len(x))
    return len(x), x.sum(axis=0), e[::-1], v[:, ::-1]


def check(spark, vectors, components=4):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components).toPandas()
    n, s, e, v = plain(vectors)
    k = got["component"].max()
    x = np.floor(64 * vectors) + 1_000_000
    white = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
    mine = got.sort_values(["vec_id", "component"])["whitened"].to_numpy().reshape(len(vectors), k)
    assert (got["n"] == n).all() and len(got) == len(vectors) * k
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    assert got.sort_values(["vec_id", "component"])["deviation"].tolist()[::k] == dev
    assert got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, e[:k] / e.sum(), rtol=1e-9)
    return mine, white, e


def test_components_equal_a_plain_eigen_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((300, 9)) * np.geomspace(3, 0.05, 9)
    vectors[50:90] = vectors[7]                                 # copies count once in the fit
    mine, white, _ = check(spark, vectors)
    assert np.allclose(np.abs(mine), np.abs(white), atol=1e-8)
    assert np.allclose(np.abs((mine * white).sum(axis=0)), (white ** 2).sum(axis=0), rtol=1e-9)     # one sign for all rows


def test_repeated_eigenvalues_are_all_found(spark):
    # plus and minus each axis: one eigenvalue, as often as there are dimensions
    vectors = np.concatenate([np.eye(8), -np.eye(8)])
    mine, _, e = check(spark, vectors, 5)
    assert np.allclose(e, e[0], rtol=1e-3) and mine.shape[1] == 5


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(2)
    flat = rng.standard_normal((50, 2)) @ np.round(rng.standard_normal((2, 6)) * 4)
    flat = np.round(flat)
    rank = np.linalg.matrix_rank(np.unique(flat, axis=0) - np.unique(flat, axis=0).mean(axis=0))
    mine, white, _ = check(spark, flat, 6)
    assert mine.shape[1] == rank and np.allclose(np.abs(mine), np.abs(white[:, :rank]), atol=1e-7)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 9), (None, [3.0, 1.0], 9), (3, None, 9), (4, [1.0, None], 9), (5, [nan, 1.0], 9), (6, [inf, 1.0], 9), (7, [], 9),
            (8, [1.0, 2.0, 3.0], 9), (9, [1e30, -1e30], 9), (1, [1.0, 2.0], 9)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")).toPandas()
    ids = got["vec_id"].tolist()
    assert sorted((i for i in ids if i == i), key=float) == [1] * 2 * got["component"].max() + [9] * got["component"].max() and got["vec_id"].isna().sum() == got["component"].max()
    assert got[got["vec_id"] == 9]["deviation"].isna().all()      # beyond 64 bits
    for empty in ([], [(1, [2.0, 3.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(empty, "vec_id long, embedding array<double>")).collect() == []


@pytest.mark.parametrize("n", [3, 40])
def test_deviations_are_exact_beyond_64_bits(n):
    x = np.array([[1 << 40, 5], [7, 9]], np.int64)
    sums = [(1 << 41) + 3, 11]
    whole = np.array([s // n for s in sums])
    for got, row in zip(whitening._deviations(x, n, whole, sums), x.tolist()):
        want = sum((n * a - b) ** 2 for a, b in zip(row, sums))
        assert got == (want if want < 1 << 63 else None)
