"""The registered corpus queries against their SQL, and the pipeline against its parts."""

from itertools import combinations

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from seriesforge.llm import decontaminate, secrets, toxicity
from seriesforge.llm.queries import QUERIES, RANKS, SQL

from tests.conftest import SF
from tests.llm.test_near_copies import plain_shingles

TABLES = "documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(repr(tuple(r[names.index(n)] for n in order)) for r in result.fetchall())
    assert sorted(repr(tuple(r[n] for n in order)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_a_row_per_document(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def smallest_of_near_copies(texts):
    """All pairs of texts compared by their five-word shingle sets; the smallest id of each chain of near copies."""
    label = {i: i for i in texts}

    def first(i):
        while label[i] != i:
            i = label[i]
        return i

    sets = {i: plain_shingles(t) for i, t in texts.items()}
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
            a, b = sorted((first(a), first(b)))
            label[b] = a
    return {i for i in label if label[i] == i}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for (name, stage), step in zip(corpus_pipeline.STAGES, range(5)):
        out = stage(spark, docs, SF)
        if step < 4:
            assert out.columns == names
        rows = {r["doc_id"]: r for r in out.collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] < 0.5}
        elif name == "simhash_near_dedup":
            want = smallest_of_near_copies(kept)
        elif name == "decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            want = {r["doc_id"] for r in decontaminate.find_contamination(docs, bench).where("not contaminated").collect()}
        else:
            want = set(kept)
        assert set(rows) == want, name
        if step == 3:
            words = secrets.learn_words(docs)
            for i, r in rows.items():
                spans = secrets.spans_of(kept[i].encode(), ranks=words)
                assert (r["text"] == kept[i]) == (not spans) and r["n_chars"] == len(r["text"])
        elif step < 3:
            assert all(r["text"] == kept[i] for i, r in rows.items())
        kept = {i: r["text"] for i, r in rows.items()} if step < 4 else kept
        docs = out if step < 4 else docs
    assert all(r["round_trip"] for r in rows.values()) and {r["n_tokens"] == len(r["ids"]) for r in rows.values()} == {True}


def test_pipeline_of_awkward_rows(spark, docs_of, awkward):
    docs = docs_of([*awkward, "password=abcdefghijklmnop"])
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"]: r["text"] for r in docs.collect()}[0] is None
    out = corpus_pipeline.encode_bytes(spark, docs, SF).collect()
    assert all(r["round_trip"] for r in out)
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
    assert RANKS


def test_pipeline_rows_come_in_small_batches(spark, docs_of, prose):
    """What the workers of a stage hold follows a MB of rows, not all rows of a task; each stage leaves it so."""
    docs = docs_of([prose(i, 20_000) for i in range(60)]).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, SF)
        found = [r["n"] for r in docs.mapInArrow(sizes, "n bigint").collect()]
        assert sum(found) > 4_000_000 and max(found) < 1_500_000, (name, found)
