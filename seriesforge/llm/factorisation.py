"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its distinct words, hashed to buckets and weighted so that their squares sum to one; one
indicator for the bin of each structure statistic (letters, signs, repetition, lines, word lengths, ...); and one for
the bin of the length that the table states, and whether it is right. The machine adds a weight for each feature and,
for each pair of features, the inner product of their factors; the sum over pairs is half the difference of the square
of sums and the sum of squares, so a score takes time in proportion to the features, not to their pairs.

Learning draws at most about ``TRAIN_ROWS`` labelled documents by hash, outside the held-out fold (crc32(doc_id as
text) mod 4 is 2), and takes ``STEPS`` gradient steps over them in one task; that bound is a parameter, and whatever is
learnt has a fixed size. Labels, lang, source and doc_id are no inputs of a score.

Defined results: NULL and empty texts are scored by their statistics, as any other; a missing, NULL or wrong n_chars is
a feature; repeated rows score alike; rows without a label and labels without a document teach nothing; contradicting
labels of one document count as good; without labels of both kinds every score is the share of good ones (0 without
any); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log, log2, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import prepare, stored

#: Bound on the labelled rows that are learnt from.
TRAIN_ROWS = 6_000
FOLDS, HELD_OUT = 4, 2
WORD_BUCKETS = 1 << 16
RANK = 8
STEPS = 60
BINS = 16
STATISTICS = 16
#: Rows behind the word buckets: a bin for each statistic, then stated length and whether it is right.
WIDTH = WORD_BUCKETS + BINS * (STATISTICS + 2)

_CLASSES = np.full(256, 6, np.int8)  # 0 upper, 1 lower, 2 digit, 3 space, 4 sentence mark, 5 other sign, 6 beyond ASCII
_CLASSES[:128] = 5
_CLASSES[65:91], _CLASSES[97:123], _CLASSES[48:58] = 0, 1, 2
_CLASSES[[9, 10, 11, 12, 13, 32]] = 3
_CLASSES[list(b".,;:'\"-()")] = 4


def _share(part: float, whole: float) -> int:
    """Bin of a share, finer near zero."""
    return min(BINS - 1, int(BINS * sqrt(part / whole))) if whole else 0


def _size(n: float) -> int:
    return min(BINS - 1, int(log2(1 + n)))


def statistics(text: bytes, words: list[bytes], counts: Counter) -> list[int]:
    """The bin of each structure statistic."""
    size, n = len(text), len(words)
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digit, space, mark, sign, wide = np.bincount(_CLASSES, weights=byte, minlength=7).tolist()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    most = max(counts.values(), default=0)
    signed = sum(not w[-1:].isalnum() and w[-1:] < b"\x80" for w in counts)
    return [
        _size(size),
        _size(n),
        _share(upper, upper + lower),
        _share(digit, size),
        _share(mark, size),
        _share(sign, size),
        _share(wide, size),
        _share(space, size),
        _share(float(byte[10]), size),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(n - len(counts), n),
        _share(repeats, n),
        _share(most, n),
        _share(sum(c for w, c in counts.items() if len(w) <= 3), n),
        _share(signed, len(counts)),
        min(BINS - 1, int(sum(map(len, words)) / n)) if n else 0,
    ]


def features(text: bytes, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values) of a document; a position may come twice, and then its values add up."""
    words = text.lower().split()
    counts = Counter(words)
    at = [crc32(w) % WORD_BUCKETS for w in counts]
    bins = statistics(text, words, counts)
    real = len(text.decode("utf-8", "replace"))
    bins += [_size(stated) if stated is not None and stated >= 0 else 0, 0 if stated is None else 1 if stated == real else 2]
    at += [WORD_BUCKETS + BINS * i + b for i, b in enumerate(bins)]
    values = np.ones(len(at), np.float32)
    values[: len(counts)] = 1 / sqrt(max(1, len(counts)))
    return np.array(at, np.int32), values


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    @classmethod
    def constant(cls, share: float) -> Machine:
        share = min(1 - 1e-9, max(1e-9, share))
        return cls(log(share / (1 - share)), np.zeros(0, np.float32), np.zeros((0, 0), np.float32))

    def raw(self, at: np.ndarray, values: np.ndarray) -> float:
        """Log odds: pairs by the square of sums less the sum of squares."""
        if not len(self.weights):
            return self.bias
        own = self.factors[at] * values[:, None]
        sums = own.sum(axis=0)
        return float(self.bias + self.weights[at] @ values + 0.5 * (sums @ sums - (own * own).sum()))

    def score(self, text: bytes, stated: int | None) -> float:
        return 1 / (1 + exp(-max(-30.0, min(30.0, self.raw(*features(text, stated))))))


class Drawn:
    """Documents laid end to end, with their positions numbered from 0."""

    def __init__(self, at: np.ndarray, values: np.ndarray, sizes: np.ndarray, y: np.ndarray):
        self.positions, self.at = np.unique(at, return_inverse=True)
        self.values, self.sizes, self.y = values.astype(np.float32), sizes, y
        self.starts = np.cumsum(sizes) - sizes

    def per_document(self, entries: np.ndarray) -> np.ndarray:
        return np.add.reduceat(entries, self.starts)

    def per_position(self, entries: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=entries, minlength=len(self.positions))


def gradient(machine: Machine, drawn: Drawn):
    """(loss, bias, weights, factors): mean logistic loss, and its slopes at the drawn positions."""
    z = machine.bias + drawn.per_document(machine.weights[drawn.at] * drawn.values)
    owns, sums = [], []
    for factor in np.ascontiguousarray(machine.factors.T):
        owns.append(factor[drawn.at] * drawn.values)
        sums.append(drawn.per_document(owns[-1]))
        z = z + 0.5 * (sums[-1] ** 2 - drawn.per_document(owns[-1] ** 2))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    y = drawn.y
    loss = float(-np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))
    pull = (p - y) / len(y)
    each = np.repeat(pull, drawn.sizes) * drawn.values
    factors = [drawn.per_position(each * (np.repeat(s, drawn.sizes) - own)) for s, own in zip(sums, owns)]
    return loss, float(pull.sum()), drawn.per_position(each), np.stack(factors, axis=1)


def train(at: np.ndarray, values: np.ndarray, sizes: np.ndarray, y: np.ndarray, *, rank: int = RANK, steps: int = STEPS) -> Machine:
    """Adam over all drawn documents in each step, with a pull towards zero; positions never seen stay at zero."""
    drawn = Drawn(at, values, sizes, y)
    n = len(drawn.positions)
    factors = np.random.default_rng(7).normal(0, 0.01, (n, rank)).astype(np.float32)
    machine = Machine(Machine.constant(float(y.mean())).bias, np.zeros(n, np.float32), factors)
    first, second = [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]
    for step in range(1, steps + 1):
        _, *slopes = gradient(machine, drawn)
        slopes[1] = slopes[1] + 1e-5 * machine.weights
        slopes[2] = slopes[2] + 1e-5 * machine.factors
        moved = []
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope * slope
            moved.append((first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6))
        machine.bias -= 0.1 * float(moved[0])
        machine.weights = (machine.weights - 0.1 * moved[1]).astype(np.float32)
        machine.factors = (machine.factors - 0.02 * moved[2]).astype(np.float32)
    whole = Machine(machine.bias, np.zeros(WIDTH, np.float32), np.zeros((WIDTH, rank), np.float32))
    whole.weights[drawn.positions], whole.factors[drawn.positions] = machine.weights, machine.factors
    return whole


def _fold(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def _inputs(docs: DataFrame):
    stated = F.col("n_chars").try_cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"), stated.alias("stated")


def _featured(rows: DataFrame) -> DataFrame:
    """(y, at, values) of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t.as_py() or b"", s) for t, s in zip(batch.column("text"), batch.column("stated").to_pylist())]
            if made:
                columns = [batch.column("y"), pa.array([a for a, _ in made], pa.list_(pa.int32())), pa.array([v for _, v in made], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["y", "at", "values"])

    return rows.mapInArrow(run, "y double, at array<int>, values array<float>")


def fit(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, rank: int = RANK, steps: int = STEPS) -> Machine:
    """Learn from at most about ``rows`` labelled documents outside the held-out fold."""
    prepare(docs.sparkSession)
    usable = labels.where((_fold("doc_id") != HELD_OUT) & F.col("quality").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = min(1.0, rows / max(1, usable.count()))
    # Drawn by hash, so that its size is bounded by ``rows``: small enough to send to every task.
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < int(share * (1 << 20)))
    drawn = drawn.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 1).cast("double").alias("y"))
    sample = stored(_featured(docs.select(*_inputs(docs)).join(F.broadcast(drawn), "doc_id").select("y", "text", "stated")), "quality-sample")
    both = sample.agg(F.count("*").alias("n"), F.avg("y").alias("mean")).first()
    if not both["n"] or both["mean"] in (0.0, 1.0):
        return Machine.constant(both["mean"] or 0.0)

    def learn(rows: pa.Table) -> pa.Table:
        at, values, y = (rows.column(c).to_pylist() for c in ("at", "values", "y"))
        order = sorted(range(len(y)), key=lambda i: (at[i], values[i][0], y[i]))  # a rerun learns the same
        sizes = np.array([len(at[i]) for i in order])
        flat = lambda lists, kind: np.concatenate([np.array(lists[i], kind) for i in order])
        made = train(flat(at, np.int32), flat(values, np.float32), sizes, np.array([y[i] for i in order]), rank=rank, steps=steps)
        return pa.table({"bias": [made.bias], "weights": [made.weights.tobytes()], "factors": [made.factors.tobytes()]})

    # The drawn rows meet in one task; their number is bounded by ``rows``.
    row = sample.withColumn("all", F.lit(True)).groupBy("all").applyInArrow(learn, "bias double, weights binary, factors binary").first()
    return Machine(row["bias"], np.frombuffer(row["weights"], np.float32), np.frombuffer(row["factors"], np.float32).reshape(WIDTH, rank))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per document: doc_id and its score from 0 to 1."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [shared.value.score(t.as_py() or b"", s) for t, s in zip(batch.column("text"), batch.column("stated").to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.select(*_inputs(docs)).mapInArrow(run, "doc_id bigint, score double")


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The columns of the contract."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        (_fold("doc_id") == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
