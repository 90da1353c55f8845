import numpy as np
import pytest

from seriesforge.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, code string, rank string"


def table(spark, vectors, ids=None):
    rows = [(i, v, 1, 0.5, "x", "y") for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(ids, vectors, k=20):
    v = np.array(vectors, np.float32).astype(np.float64)
    dots = np.zeros((len(v), len(v)))
    for x in v.T:  # one dimension after the other; sum() would round otherwise
        dots += x[:, None] * x
    out = {}
    for q, i in enumerate(ids):
        if i % 20 == 0:
            scores = [(-dots[q, c], j) for c, j in enumerate(ids) if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("d", [3, 64, 70])
def test_recall_against_all_pairs(spark, monkeypatch, d):
    r = np.random.default_rng(d)
    vectors = r.standard_normal((600, d)).astype(np.float32) * r.choice([0.1, 1, 3], (600, 1))
    vectors[100:300] = vectors[100]  # ties in great number
    monkeypatch.setattr(N, "SHARD_ROWS", 150)
    monkeypatch.setattr(N, "QUERY_BLOCK", 12)
    want = plain(range(600), vectors.tolist())
    found = {}
    for row in N.nearest(table(spark, vectors.tolist())).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    assert found.keys() == want.keys()
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))


def test_bounds_hold():
    r = np.random.default_rng(2)
    v, q = r.standard_normal((500, 64)), r.standard_normal((40, 64))
    mean, turn = v.mean(axis=0), N.rotation(64)
    codes, scalars = N.encode(v, mean, turn)
    estimate, most = N._Queries(q, mean, turn).estimates(slice(0, 40), codes, scalars, N.EPSILON)
    true = q @ v.T
    assert (most >= true).mean() > 0.998
    assert np.corrcoef(estimate.ravel(), true.ravel())[0, 1] > 0.75  # they tell something
    assert abs((estimate - true).mean()) < 0.1
    assert np.allclose(turn @ turn.T, np.eye(64))


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 0.0], [0.5, 0.5], [0.0, 1.0], [0.5, 0.5]]
    bad = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.0, 3.0]]
    df = table(spark, [*good, *bad, [9.0, 9.0], good[1], [0.0, 1.0]], [0, 1, 2, 5, 20, 40, 60, 80, 100, 120, 140, None, 1, 1])
    found = [tuple(r) for r in N.nearest(df).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 0.5), (0, 2, 5, 0.5), (0, 3, 2, 0.0)]


def test_one_vector_and_none(spark):
    assert N.nearest(table(spark, [[1.0, 2.0]])).count() == 0
    assert N.nearest(table(spark, [[1.0, 2.0]]).limit(0)).columns == ["query_id", "rank", "vec_id", "score"]
    assert N.nearest(table(spark, [None, [0.0]])).count() == 0
