from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from skirmish.llm.whitening import Whitening, whiten

VECTORS = "vec_id long, embedding array<float>, label int"


def whole(v):
    return tuple(floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def brute(rows):
    """n, sums, covariance in exact fractions, over the different vectors."""
    kept = [(i, whole(v)) for i, v, *_ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    different = sorted({x for _, x in kept})
    n = len(different)
    sums = [sum(column) for column in zip(*different, strict=True)]
    a = np.array([[n * c - s for c, s in zip(x, sums, strict=True)] for x in different], object)
    v = np.array([[float(Fraction(int(p), n**3)) for p in row] for row in a.T @ a])
    return kept, n, sums, v


def table(seed, n, d, scale=0.125):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, d)) @ (rng.standard_normal((d, d)) * np.linspace(1, 3, d)) * scale
    return [(i, [float(c) for c in v], 0) for i, v in enumerate(mixed)]


def odd(rows, d):
    nan, inf = float("nan"), float("inf")
    return [*rows, (900, None, 1), (901, [nan] * d, 1), (902, [inf] + [0.0] * (d - 1), 1), (903, [None] * d, 1), (904, rows[3][1], 1), (904, rows[3][1], 1), (None, rows[5][1], 1), (905, [0.0] * d, None)]


@pytest.mark.parametrize("d", [5, 24])
def test_is_brute_force(spark, d):
    rows = odd(table(d, 60, d), d)
    kept, n, sums, v = brute(rows)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    for name in ("x", "n", "component", "c0", "s0", "w0", "deviation"):
        df = df.withColumn(name, F.lit(7))
    got = whiten(df).toPandas()
    k = min(16, d)
    assert len(got) == k * len(kept) and (got["n"] == n).all() and got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].max() < 1e-9
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    assert np.allclose(got.groupby("component")["explained"].first(), values[:k] / np.trace(v), rtol=1e-9)
    want = sorted((-1 if i is None else i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in kept)
    one = got[got["component"] == 1]
    assert sorted(zip(one["vec_id"].fillna(-1).astype(int), one["deviation"].tolist(), strict=True)) == want
    # Whitened numbers give back the eigenvectors: components are uncorrelated over the fit list, of unit variance.
    by_id = {(-1 if i is None else i): np.array([c - s / n for c, s in zip(x, sums, strict=True)]) for i, x in kept}
    different = {tuple(x): (-1 if i is None else i) for i, x in kept}
    z = got.assign(vec_id=got["vec_id"].fillna(-1)).drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened").loc[list(different.values())].to_numpy()
    x = np.array([by_id[i] for i in different.values()])
    assert np.abs(z.T @ z / n - np.eye(k)).max() < 1e-9
    vectors = np.linalg.lstsq(x, z * np.sqrt(values[:k]), rcond=None)[0]
    assert np.allclose(np.linalg.norm(vectors, axis=0), 1) and np.abs(v @ vectors - vectors * values[:k]).max() < 1e-6 * values[0]


def test_far_from_zero_and_of_uneven_scale(spark):
    """Products are of centred columns: a spread of 1 beside one of 2**20 around 10**9 is kept."""
    rng = np.random.default_rng(1)
    rows = [(i, [1e7 + float(a), 2.0**14 * float(b), float(c)], 0) for i, (a, b, c) in enumerate(rng.standard_normal((300, 3)))]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).toPandas()
    x = np.array([[floor(64 * c) for c in v] for _, v, _ in rows], float)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert np.allclose(got.groupby("component")["explained"].first(), values / values.sum(), rtol=1e-6) and got["identity_error"].max() < 1e-6


def test_rank_and_lengths(spark):
    """Fewer components than dimensions where the vectors lie in a plane; each length by itself; one vector has none."""
    plane = [(i, [float(i % 7), float(i % 5), float(i % 7 + i % 5)], 0) for i in range(35)]
    line = [(100 + i, [float(i)], 0) for i in range(9)]
    alone = [(200, [1.0, 2.0], 0), (201, [1.0, 2.0], 0), (202, [], 0)]
    got = whiten(spark.createDataFrame(plane + line + alone, VECTORS)).toPandas()
    assert got[got["vec_id"] < 100].groupby("vec_id")["component"].apply(list).map(tuple).unique().tolist() == [(1, 2)]
    assert got[got["vec_id"] >= 100].groupby("vec_id")["component"].apply(list).map(tuple).unique().tolist() == [(1,)] and got["vec_id"].max() < 200


def test_deviation_beyond_a_long_is_null():
    model = Whitening(1 << 31, [0], np.ones(1), np.ones((1, 1)), np.ones(1))
    assert model.deviations(np.array([[1], [1 << 20]])) == [1 << 62, None]
    assert Whitening(3, [10], np.ones(1), np.ones((1, 1)), np.ones(1)).deviations(np.array([[3], [4]])) == [1, 4]


def test_too_large_and_empty(spark):
    with pytest.raises(Exception, match="2\\*\\*46"):
        whiten(spark.createDataFrame([(1, [1e30], 0)], VECTORS)).count()
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 0


def test_pairs_are_one_aggregation(spark):
    """Sums are taken before they travel: a row of numbers a task, no vector."""
    from skirmish.llm import whitening

    df = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    a, b = np.arange(50.0), np.arange(50.0) % 7
    assert np.allclose(whitening.covariance(df, [f"(a - {a.mean()}D)", f"(b - {b.mean()}D)"], 50), np.cov(np.stack([a, b]), bias=True))
