"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Three relations, all kept as packed columns: documents in batches of text; the n-grams of each batch with their counts,
exploded to rows and dealt by hash over count tables; and the answers of those tables, which meet their batch again and
are summed per document. A batch passes each n-gram on once, so a frequent one costs a row per batch and table and no
table grows with it.

A token is scored by the longest n-gram (up to ``order``) that other documents hold: its count over that of its
context, times ``backoff`` for every order given up. A document's own n-grams are taken off the counts first. A word
that no other document holds counts ``UNSEEN``. Words are runs of anything but ASCII white space, A-Z lower-cased.

Defined results: NULL, empty and wordless texts have no tokens and a NULL mean; repeated rows are documents of their
own and see each other's n-grams; a single document scores all its words as unseen; an empty table gives no rows;
further columns are ignored. n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import prepare, stored, utf8

ORDER = 2
BACKOFF = 0.4
UNSEEN = 0.5
BATCH_TEXT = 5 << 20
#: Text whose n-grams one count table holds.
TABLE_TEXT = 24 << 20
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, byte by byte: first the lowest bytes of all, so that high zeros cost nothing."""
    planes = [a.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _loose(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _numbers(blob: bytes, arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(_loose(blob), np.uint8).reshape(arrays, 8, -1)
    return [np.ascontiguousarray(planes.T).view("<u8").ravel() for planes in raw]


def in_batches(docs: DataFrame, limit: int = BATCH_TEXT) -> DataFrame:
    """(batch, doc_ids, sizes, texts): documents laid end to end, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "batch": pa.array([uuid.uuid4().hex]),
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                    "texts": pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(texts))], pa.binary()),
                }
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if size >= limit:
                    yield packed()
                    ids, texts, size = [], [], 0
        if ids:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "batch string, doc_ids array<bigint>, sizes array<int>, texts binary")


class Grams:
    """The n-grams of a batch: per order the distinct hashes, and which of them ends at each token (-1: none)."""

    def __init__(self, sizes: list[int], blob: bytes, order: int):
        data, words, at, lengths = _loose(blob) if sizes and sum(sizes) else b"", [], 0, []
        for size in sizes:
            own = data[at : at + size].lower().split()
            words += own
            lengths.append(len(own))
            at += size
        self.lengths = np.array(lengths, np.int64)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), self.lengths)
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
        del words, data
        one = np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in numbers), np.uint64, len(numbers))[ids]
        place = np.arange(len(ids)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.distinct, self.which, self.counts = [], [], []
        run = one
        for n in range(1, order + 1):
            if n > 1:
                run = (run[:-1] ^ (run[:-1] >> np.uint64(31))) * _MULTIPLY + one[n - 1 :]
            inside = place[n - 1 :] >= n - 1
            distinct, inverse, counts = np.unique(run[inside], return_inverse=True, return_counts=True)
            which = np.full(len(ids), -1, np.int32)
            which[n - 1 :][inside] = inverse
            self.distinct.append(distinct)
            self.which.append(which)
            self.counts.append(counts)


def _tables_of(hashes: np.ndarray, tables: int) -> np.ndarray:
    """Table of each sorted hash: equal ranges of the hash, so that a table's share of a batch is a slice."""
    return np.searchsorted(hashes, np.array([(t << 64) // tables for t in range(tables)], np.uint64))


def exploded(batches: DataFrame, order: int, tables: int) -> DataFrame:
    """(table, batch, part, grams): each batch's distinct n-grams and counts of one order, dealt over the tables."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in rows:
            for name, sizes, blob in zip(*(rows_.column(c).to_pylist() for c in ("batch", "sizes", "texts"))):
                grams = Grams(sizes, blob, order)
                out = []
                for n in range(order):
                    cuts = np.append(_tables_of(grams.distinct[n], tables), len(grams.distinct[n]))
                    for t in range(tables):
                        a, b = cuts[t], cuts[t + 1]
                        if b > a:
                            own = grams.distinct[n][a:b]
                            out.append((t, name, n, _squeeze(np.diff(own, prepend=np.uint64(0)), grams.counts[n][a:b])))
                if out:
                    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=["table", "batch", "part", "grams"])

    return batches.mapInArrow(run, "table int, batch string, part int, grams binary")


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _numbers(blob, 2)
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def answers(grams: DataFrame) -> DataFrame:
    """(batch, table, part, totals, asked): the corpus counts of the n-grams that each batch asked a table for, and how
    many n-grams the batch itself has there."""

    def count(key, table):
        names, parts, blobs = (table.column(c).to_pylist() for c in ("batch", "part", "grams"))
        totals: list[bytes | None] = [None] * len(names)
        sums = [0] * len(names)
        for part in sorted(set(parts)):
            mine = [i for i, p in enumerate(parts) if p == part]
            asked = [_unpacked(blobs[i]) for i in mine]
            distinct, inverse = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
            summed = np.bincount(inverse, weights=np.concatenate([c for _, c in asked])).astype(np.int64)
            at = 0
            for i, (own, counts) in zip(mine, asked):
                sums[i] = int(counts.sum())
                totals[i] = _squeeze(summed[inverse[at : at + len(own)]])
                at += len(own)
        number = pa.array([key[0].as_py()] * len(names), pa.int32())
        return pa.table(
            {
                "batch": pa.array(names),
                "table": number,
                "part": pa.array(parts, pa.int32()),
                "totals": pa.array(totals, pa.binary()),
                "asked": pa.array(sums, pa.int64()),
            }
        )

    return grams.groupBy("table").applyInArrow(count, "batch string, table int, part int, totals binary, asked bigint")


def _scores(grams: Grams, totals: list[np.ndarray], tokens: int, backoff: float) -> np.ndarray:
    """Sum of log scores of each document."""
    n = len(grams.doc)
    rest = (tokens - grams.lengths)[grams.doc]
    outside = []
    for which, total in zip(grams.which, totals):
        own = np.zeros(n, np.int64)
        real = np.flatnonzero(which >= 0)
        pair = grams.doc[real].astype(np.int64) * (len(total) + 1) + which[real]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        own[real] = total[which[real]] - counts[inverse]
        outside.append(own)
    order = len(totals)
    score = (order - 1) * log(backoff) + np.log(np.maximum(outside[0], UNSEEN)) - np.log(np.maximum(rest, 1))
    for k in range(1, order):
        seen = np.flatnonzero(outside[k] > 0)
        score[seen] = (order - 1 - k) * log(backoff) + np.log(outside[k][seen]) - np.log(outside[k - 1][seen - 1])
    return np.bincount(grams.doc, weights=score, minlength=len(grams.lengths))


def score(docs: DataFrame, *, order: int = ORDER, backoff: float = BACKOFF, batch_text: int = BATCH_TEXT, table_text: int = TABLE_TEXT) -> DataFrame:
    """One row per document: doc_id, n_tokens, log_score (natural, summed) and mean_log_score."""
    prepare(docs.sparkSession)
    batches = stored(in_batches(docs, batch_text), "lm-batches")
    text = batches.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    tables = max(1, -(-text // table_text))
    grams = exploded(batches, order, tables)
    replies = stored(answers(grams), "lm-answers")

    tokens = replies.where("part = 0").agg(F.sum("asked")).first()[0] or 0

    def summed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for ids, sizes, blob, got in zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "sizes", "texts", "got"))):
                grams = Grams(sizes, blob, order)
                totals = []
                for part in range(order):
                    mine = sorted((g["table"], g["totals"]) for g in got or [] if g["part"] == part)
                    totals.append(np.concatenate([np.zeros(0, np.int64), *[_numbers(t, 1)[0].astype(np.int64) for _, t in mine]]))
                values = _scores(grams, totals, tokens, backoff)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(grams.lengths), pa.array(values)], names=["doc_id", "n_tokens", "log_score"]
                )

    gathered = replies.groupBy("batch").agg(F.collect_list(F.struct("table", "part", "totals")).alias("got"))
    scored = batches.join(gathered, "batch", "left").mapInArrow(summed, "doc_id bigint, n_tokens bigint, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")))
