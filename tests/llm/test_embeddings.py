from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from skirmish.llm.embeddings import at_least, bucket_keys, collision, near_duplicates, plan, sketch_distance, sketches, with_near_sketch

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    out = {i: (0, i) for i, *_ in rows}
    usable = [(i, v) for i, v, _ in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    for n in {len(v) for _, v in usable}:
        out |= brute_of_length([(i, v) for i, v in usable if len(v) == n])
    return out


def brute_of_length(good):
    x = np.array([v for _, v in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[n].min() for n in near])
    ids = np.array([i for i, _ in good])
    return {i: (int(n.sum()) - 1, int(ids[label == k].min())) for (i, _), n, k in zip(good, near, label, strict=True)}


def groups(rng, n_groups=30, dim=32):
    rows = []
    for g in range(n_groups):
        centre = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 12))):
            rows.append(centre + rng.standard_normal(dim) * rng.choice([0.0, 0.03, 0.1, 0.25]))
    return [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(rows)]


@pytest.mark.parametrize("bucket_limit", [4096, 3])
def test_links_and_components(spark, bucket_limit):
    rows = groups(np.random.default_rng(3))
    odd = [(5000, None, 0), (5001, [0.0] * 32, 0), (5002, [float("nan")] * 32, 0), (5003, [None] * 32, 0), (5004, [float("inf")] * 32, 0), (5005, [], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows + odd, SCHEMA), bucket_limit=bucket_limit).collect()}
    want = brute(rows + odd)
    assert set(got) == set(want)
    true, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert true > 200 and 0.95 * true <= found <= true
    assert all(got[i][0] <= want[i][0] for i in want), "no link below the limit"
    assert sum(got[i][1] != want[i][1] for i in want) <= 0.03 * len(want)


@pytest.mark.parametrize("bucket_limit", [4096, 3])
def test_every_length_is_compared(spark, bucket_limit):
    rng = np.random.default_rng(5)
    rows = [(i, v, 0) for i, (_, v, _) in enumerate([*groups(rng, 12, 32), *groups(rng, 6, 5), *groups(rng, 4, 200), (0, [1.0, 0.0], 0), (0, [1.0, 0.01], 0), (0, [1.0, 0.02], 0), (0, [2.0], 0), (0, [3.5], 0), (0, [-1.0], 0)])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), bucket_limit=bucket_limit).collect()}
    want = brute(rows)
    assert all(got[i] == want[i] for i in list(want)[-6:]) and [want[i][0] for i in list(want)[-6:]] == [2, 2, 2, 1, 1, 0]
    assert all(got[i][0] <= want[i][0] for i in want) and sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())


def test_the_limit_itself_links_and_nothing_below(spark):
    """19 of 20 exactly: (20, 0, 0, 0, 0) and (19, 6, 1, 1, 1); the other is lower by a part in 10^15."""
    limit, below = [19.0, 6.0, 1.0, 1.0, 1.0], [19.0, 6.0, 1.0, 1.0, 1.0 + 4e-13]
    assert at_least(np.array([20.0, 0, 0, 0, 0]), np.array(limit), Fraction("0.95")) and not at_least(np.array([20.0, 0, 0, 0, 0]), np.array(below), Fraction("0.95"))
    for other, want in ((limit, 1), (below, 0)):
        got = near_duplicates(spark.createDataFrame([(1, [20.0, 0.0, 0.0, 0.0, 0.0]), (2, other)], "vec_id long, embedding array<double>"), recall=0.9999)
        assert [r["n_links"] for r in got.collect()] == [want] * 2


def test_recall_on_planted_vectors(spark):
    """50,000 vectors; 4,000 have a partner at cosine 0.95 to 0.97, a ball of 300 lies much closer."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((50_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= (side * x[:4000]).sum(1, keepdims=True) * x[:4000]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.9501, 0.97, (4000, 1))
    x[4000:8000] = c * x[:4000] + np.sqrt(1 - c * c) * side
    x[9000:9300] = x[9000] + 0.004 * rng.standard_normal((300, 64))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x.astype(np.float32)))}))
    got = near_duplicates(df.repartition(4)).toPandas().set_index("vec_id").sort_index()
    pairs = got["component_id"].to_numpy()[4000:8000] == np.arange(4000)
    assert pairs.mean() >= 0.95
    ball = got.loc[9000:9299]
    assert (ball["component_id"] == 9000).all() and ball["n_links"].sum() >= 0.99 * 300 * 299 and (ball["n_links"] <= 299).all()
    assert (got["n_links"].drop(range(8000)).drop(range(9000, 9300)) == 0).mean() == 1


def test_sketches_are_near_where_vectors_are():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((50_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    key, sketch = np.repeat(np.arange(50_000), 2), np.stack([sketches(a, 1), sketches(b, 1)], 1).ravel()
    assert with_near_sketch(key, sketch, sketch_distance(0.95)).mean() > 0.9999
    strange = np.stack([sketches(a, 1), np.roll(sketches(a, 1), 1)], 1).ravel()
    assert with_near_sketch(key, strange, sketch_distance(0.95)).mean() < 0.01
    large = with_near_sketch(np.zeros(100, np.int64), np.r_[sketch[:2], sketches(a[5000:5098], 1)], 20)
    assert large[:2].all() and not large[2:].all()


def test_copies_and_clashing_columns(spark):
    rows = [(i % 3 if i % 4 else None, [1.0, 2.0, -0.0], 7) for i in range(12)] + [(50, [2.0, 4.0, 0.0], 7), (51, [-1.0, 5.0, 1.0], 7)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS no", "2 AS key", "3 AS t", "4 AS weight", "5 AS keys", "6 AS n_links")
    got = sorted((tuple(r) for r in near_duplicates(df).collect()), key=repr)
    assert len(got) == 14
    assert all(r[1] == 12 and r[2] == 0 and r[3] == (r[0] == 0) for r in got if r[0] != 51) and (51, 0, 51, True) in got


def test_collision_probability_is_as_planned():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((20_000, 24))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal(a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    same = np.stack([bucket_keys(x, 3, 8, 1.2, 1) for x in (a, b)])
    assert (same[0] == same[1]).mean() == pytest.approx(collision(np.sqrt(0.1), 1.2) ** 3, abs=0.03)
    k, tables = plan(10**6)
    assert 1 - (1 - collision(np.sqrt(0.1), 1.2) ** k) ** tables >= 0.97


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()[0]["component_id"] == 1
