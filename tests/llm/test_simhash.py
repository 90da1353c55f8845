import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seriesforge.llm import simhash
from seriesforge.llm.common import stored
from seriesforge.llm.components import smallest_reachable


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=2):
    """{id: smallest reachable id} by comparing all pairs."""
    parent = {i: i for i in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprints_of_awkward_texts(spark, docs_of, awkward):
    found = {r["doc_id"]: r for r in simhash.digest(simhash.near_duplicates(docs_of(awkward, extra=True))).collect()}
    fps = {i: plain_fingerprint(t) for i, t in enumerate(awkward)}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(fps)
    assert found[0]["component_id"] == found[1]["component_id"] == found[2]["component_id"] == 0


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_links_lose_no_component(spark, hot):
    """Random fingerprints with planted clusters and chains, with and without hot buckets."""
    r = random.Random(7)
    fps = [r.getrandbits(64) for _ in range(150)]
    for seed in fps[:12]:
        at = seed
        for _ in range(12):
            for _ in range(r.randint(1, 2)):
                at ^= 1 << r.randrange(64)
            fps.append(at)
            fps.append(seed ^ (1 << r.randrange(64)))
    fps = dict(enumerate(dict.fromkeys(fps)))
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in fps.items()]
    distinct = spark.createDataFrame(rows, "fp bigint, node bigint")
    labels = {row["id"]: row["label"] for row in smallest_reachable(simhash.links(distinct, hot=hot)).collect()}
    assert {i: labels.get(i, i) for i in fps} == plain_components(fps)


def test_no_pair_is_lost_outside_hot_buckets(spark):
    r = random.Random(9)
    base = [r.getrandbits(63) for _ in range(40)]
    fps = {}
    for b in base:
        for f in (b, b ^ 1 << r.randrange(63), b ^ 1 << r.randrange(63) ^ 1 << r.randrange(62)):
            fps.setdefault(f, len(fps))
    found = {tuple(e) for e in simhash.links(spark.createDataFrame(list(fps.items()), "fp bigint, node bigint")).collect()}
    ids = {i: f for f, i in fps.items()}
    assert found == {(a, b) for a in ids for b in ids if a < b and bin(ids[a] ^ ids[b]).count("1") <= 2}


def test_thresholds_keep_the_pigeonhole(spark):
    """Thresholds add up to radius - m + 1, so no pair within the radius passes all partitions."""
    r = np.random.default_rng(1)
    skewed = (r.random((4000, 64)) < np.linspace(0.02, 0.5, 64)).astype(float)
    skewed[:, 1] = skewed[:, 0]
    for n, both in ((4000, skewed.T @ skewed), (10**10, skewed.T @ skewed * 2.5e6), (0, np.zeros((64, 64)))):
        plan = simhash.allocate(n, both)
        assert sorted(b for bits, _ in plan for b in bits) == list(range(64))
        assert sum(t for _, t in plan) == 2 - len(plan) + 1
    assert any(0 in g and 1 in g for g in simhash.group_bits(4000, skewed.T @ skewed, 3))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 220)] + [(500, i) for i in range(501, 700)] + [(9, 9)]
    edges = spark.createDataFrame(chain, "a bigint, b bigint")
    labels = {r["id"]: r["label"] for r in smallest_reachable(edges).collect()}
    assert labels == {i: 100 for i in range(100, 221)} | {i: 500 for i in range(500, 700)}


def test_empty_table(spark, docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_one(docs_of([])).count() == 0


def test_keep_one(spark, docs_of, prose):
    text = prose(5, 300)
    docs = docs_of([text, text, text.upper(), prose(6, 300), text, None], ids=[4, 2, 7, 1, 2, None], extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.select("doc_id").collect()) == [(False, 1), (False, 2), (True, None)]
    assert kept.where(F.col("doc_id") == 2).first()["text"] == text


def test_exploded_rows_are_not_broadcast(spark):
    """Keys and one-bit neighbours are many rows of a small table: both sides of their joins are shuffled."""
    import io
    from contextlib import redirect_stdout

    rows = spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 63), i) for i in range(200)], "fp bigint, node bigint")
    distinct = stored(rows, "simhash-distinct")  # of known size
    text = io.StringIO()
    with redirect_stdout(text):
        simhash.links(distinct, hot=2).explain()
    inner = [line for line in text.getvalue().splitlines() if "Join [" in line and "Inner" in line]
    assert len(inner) == 2 and all("SortMergeJoin" in line for line in inner)
