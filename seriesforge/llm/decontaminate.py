"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

Benchmark items and documents are normalised alike (A-Z lower-cased, words of digits, a-z and all
non-ASCII characters, joined by one space). Every run of ``window`` words of an item is a pattern; an
item of fewer words is one pattern. The automaton finds all patterns in one pass over a document; word
positions lead back to offsets in the original text.

Defined results: a NULL or wordless text has no words, no hits and is not contaminated; wordless or NULL
items never match; repeated documents are judged one by one, repeated items each count; an empty benchmark
hits nothing; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import per_batch, prepare, utf8

WINDOW = 13
#: Contaminated from one hit word in this many.
ONE_IN = 20
#: Characters of patterns in one automaton. Larger benchmarks are cut into several automata of at most this.
AUTOMATON_CHARS = 16_000_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per pattern with the items that contain it: (pattern, n_words, items)."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, patterns, sizes = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i : i + window]
                ids.append(item)
                patterns.append(b" ".join(part))
                sizes.append(len(part))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(patterns, pa.binary()), pa.array(sizes, pa.int32())],
            names=["item", "pattern", "n_words"],
        )

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return (
        per_batch(rows, cut, "item string, pattern binary, n_words int")
        .groupBy("pattern", "n_words")
        .agg(F.collect_set("item").alias("items"))
    )


def _automaton(rows: list[tuple[bytes, int, list[str]]]) -> ahocorasick.Automaton | None:
    """Patterns are framed by spaces, so that only whole words match."""
    machine = ahocorasick.Automaton()
    for pattern, size, items in rows:
        machine.add_word(f" {pattern.decode('latin-1')} ", (size, tuple(items)))
    if not rows:
        return None
    machine.make_automaton()
    return machine


def _original_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point spans of runs of hit words."""
    inside = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    runs = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in zip(runs[0::2], runs[1::2])]


def _scan(docs: DataFrame, rows: list[tuple[bytes, int, list[str]]]) -> DataFrame:
    """Per document: its word count, hit spans in words and in code points, and the items found."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(shared.value)
        for batch in batches:
            counts, word_spans, spans, found = [], [], [], []
            for text in utf8(batch.column(1)):
                normal = b" ".join(text.translate(_FOLD).split())
                n = normal.count(b" ") + 1 if normal else 0
                counts.append(n)
                matches = list(machine.iter(f" {normal.decode('latin-1')} ")) if machine and n else []
                if not matches:
                    word_spans.append([])
                    spans.append([])
                    found.append([])
                    continue
                # A match ends on the space behind its last word; that space's number is the word's number plus one.
                spaces = np.flatnonzero(np.frombuffer(b" " + normal + b" ", np.uint8) == 32)
                last = np.searchsorted(spaces, [end for end, _ in matches])
                delta = np.zeros(n + 1, np.int64)
                np.add.at(delta, last - [size for _, (size, _) in matches], 1)
                np.add.at(delta, last, -1)
                hit = (np.cumsum(delta[:-1]) > 0).astype(np.int8)
                runs = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
                word_spans.append([{"start": int(a), "end": int(b)} for a, b in zip(runs[0::2], runs[1::2])])
                spans.append([{"start": a, "end": b} for a, b in _original_spans(text, hit)])
                found.append(sorted({item for _, (_, items) in matches for item in items}))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kept = {name: column for name, column in zip(batch.schema.names, batch.columns) if name != "text"}
            yield pa.RecordBatch.from_pydict(
                kept
                | {
                    "n_words": pa.array(counts, pa.int64()),
                    "word_spans": pa.array(word_spans, span),
                    "spans": pa.array(spans, span),
                    "items": pa.array(found, pa.list_(pa.string())),
                }
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    spans = "array<struct<start: bigint, end: bigint>>"
    return docs.mapInArrow(run, f"{kept}, n_words bigint, word_spans {spans}, spans {spans}, items array<string>")


def _collected(patterns: DataFrame) -> list[tuple[bytes, int, list[str]]]:
    return [(bytes(r["pattern"]), r["n_words"], r["items"]) for r in patterns.collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    one_in: int = ONE_IN,
    automaton_chars: int = AUTOMATON_CHARS,
    keep_key: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (code points), items, contaminated (and text_key if asked).

    The patterns' total length is measured first. Up to ``automaton_chars`` they form one broadcast automaton;
    beyond, they are dealt by hash over as many automata as needed and each scans the texts once.
    """
    prepare(docs.sparkSession)
    patterns = windows(benchmark, item_col, text_col, window)
    weight = F.length("pattern") + 64 + F.aggregate("items", F.lit(0), lambda a, x: a + F.length(x) + 8)
    total = patterns.agg(F.sum(weight)).first()[0] or 0
    shards = max(1, -(-total // automaton_chars))
    texts = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    if shards == 1:
        found = _scan(texts.withColumn("text_key", text_key()) if keep_key else texts, _collected(patterns))
    else:
        keyed = texts.withColumn("text_key", text_key())
        own = [patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == shard) for shard in range(shards)]
        parts = [_scan(keyed, _collected(part)) for part in own]
        # Rows that share id and text have equal results: they meet here and are counted out again.
        found = (
            reduce(DataFrame.unionByName, parts)
            .groupBy("doc_id", "text_key", "n_words")
            .agg(
                (F.count("*") / shards).cast("int").alias("copies"),
                _united(F.array_sort(F.flatten(F.collect_set("word_spans")))).alias("word_spans"),
                _united(F.array_sort(F.flatten(F.collect_set("spans")))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            )
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )
    return _judged(found, one_in)


def text_key() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that are not contaminated, unchanged.

    Ids alone may repeat with other texts, so contaminated rows are named by id and text.
    """
    judged = find_contamination(docs, benchmark, keep_key=True, **options).where("contaminated").select("doc_id", "text_key").distinct()
    keyed = docs.withColumn("__text_key", text_key())
    same = keyed["doc_id"].eqNullSafe(judged["doc_id"]) & (keyed["__text_key"] == judged["text_key"])
    return keyed.join(judged, same, "left_anti").drop("__text_key")


def _judged(found: DataFrame, one_in: int) -> DataFrame:
    n_hit = F.aggregate("word_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).select(
        "doc_id",
        "n_words",
        "n_hit",
        "spans",
        "items",
        ((F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        *[c for c in ("text_key",) if c in found.columns],
    )


def _united(column: Column) -> Column:
    """Sorted spans with overlapping ones merged."""
    empty = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")

    def add(done, span):
        last = F.get(done, F.size(done) - 1)
        grown = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))),
        )
        return F.when((F.size(done) > 0) & (last["end"] > span["start"]), grown).otherwise(
            F.concat(done, F.array(F.struct(span["start"].alias("start"), span["end"].alias("end"))))
        )

    return F.aggregate(column, empty, add)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
