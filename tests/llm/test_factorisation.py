from itertools import combinations
from zlib import crc32

import numpy as np
import pytest

from seriesforge.llm import factorisation as fm

SF = "/root/testdata/sf0.01"


def test_score_sums_all_pairs(prose):
    source = np.random.default_rng(3)
    machine = fm.Machine(0.3, source.normal(size=fm.WIDTH), source.normal(0, 0.3, (fm.WIDTH, 4)))
    for text, stated in ((prose(1, 40), 5), ("", None), ("a a A b!\n\nc 1", 14)):
        at, values = fm.features(text.encode(), stated)
        linear = sum(machine.weights[i] * v for i, v in zip(at, values))
        pairs = sum(machine.factors[i] @ machine.factors[j] * v * w for (i, v), (j, w) in combinations(zip(at, values), 2))
        assert machine.raw(at, values) == pytest.approx(machine.bias + linear + pairs, rel=1e-5, abs=1e-5)


def test_gradient_is_the_slope():
    source = np.random.default_rng(5)
    at = np.array([10, 20, 30, 10, 40, 20, 30, 40])
    drawn = fm.Drawn(at, source.random(8), np.array([3, 2, 3]), np.array([1.0, 0.0, 1.0]))
    machine = fm.Machine(0.1, source.normal(size=4), source.normal(size=(4, 2)))
    _, bias, weights, factors = fm.gradient(machine, drawn)

    def loss(change):
        changed = fm.Machine(machine.bias, machine.weights.copy(), machine.factors.copy())
        change(changed)
        return fm.gradient(changed, drawn)[0]

    step = 1e-4
    for k in range(4):
        up, down = (loss(lambda m, s=s: m.weights.__setitem__(k, m.weights[k] + s)) for s in (step, -step))
        assert weights[k] == pytest.approx((up - down) / (2 * step), abs=1e-5)
        for f in range(2):
            up, down = (loss(lambda m, s=s: m.factors.__setitem__((k, f), m.factors[k, f] + s)) for s in (step, -step))
            assert factors[k, f] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = fm.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    good = [p for p, y in held if y == 1]
    bad = [p for p, y in held if y == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.2


def test_held_out_labels_and_names_teach_nothing(spark, docs_of, prose):
    """Flipped labels of the held-out fold, other langs and sources leave the scores as they are."""
    texts = [prose(i, 60) if i % 2 else f"{prose(i, 30).upper()} ###" for i in range(80)]
    labels = [(i, i % 2) for i in range(80)]
    flipped = [(i, 1 - y if crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    docs = docs_of(texts, extra=True)
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "NULL AS source", "n_chars")
    schema = "doc_id bigint, quality int"
    a = fm.score(docs, fm.fit(docs, spark.createDataFrame(labels, schema)))
    b = fm.score(other, fm.fit(other, spark.createDataFrame(flipped, schema)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {i % 2 for i, s in a.collect() if s >= 0.7} == {1}


def test_awkward_rows(spark, docs_of, awkward, prose):
    docs = docs_of([*awkward, prose(9, 20), prose(9, 20)], extra=True)
    schema = "doc_id bigint, quality int"
    some = [(0, 1), (0, 0), (3, 0), (5, 1), (9, None), (None, 1), (999, 0)]
    for labels in (some, [(5, 1)], [(5, 0)], []):
        rows = {r["doc_id"]: r["score"] for r in fm.digest(docs, spark.createDataFrame(labels, schema)).collect()}
        assert len(rows) == len(awkward) + 2 and all(0 <= s <= 1 for s in rows.values())
        assert rows[len(awkward)] == rows[len(awkward) + 1]
    assert all(s < 1e-6 for s in rows.values())
    bare = docs.select("doc_id", "text")
    assert fm.score(bare, fm.Machine.constant(0.4)).select("score").distinct().first()[0] == pytest.approx(0.4)
    assert fm.digest(docs_of([]), spark.createDataFrame(some, schema)).count() == 0
