"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint bit is 1 if it is set in more than half of the XXH64 hashes (seed 42) of a text's word
shingles. Fingerprints link at ``radius`` or fewer differing bits, and linked ones form components.

Search: bits are grouped so that correlated ones share a partition. Two fingerprints within radius r differ
by at most t_i bits in some partition i whenever the thresholds add up to r - m + 1 over m partitions, so each
fingerprint is stored once per partition and probes, in each partition, every value within t_i flips. Number of
partitions and thresholds come from a dynamic programme over the estimated number of probes and candidates.
Candidates are verified on the whole fingerprint.

A bucket with more than ``hot`` fingerprints is not joined with itself. Its members are linked by one-bit
neighbourhoods instead: fingerprints within two bits share a value that is at most one flip away from both, so
each member meets the smallest fingerprint at every such value. That adds 65 rows per member, never a pair per
pair, and loses no component.

Defined results: NULL, empty and wordless texts have fingerprint 0 and link like any other; fewer words than
a shingle make one shingle of all of them; exact copies and repeated rows share a fingerprint; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import per_batch, prepare, stored, utf8
from seriesforge.llm.components import smallest_reachable

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
MAX_PARTITIONS = 4
HOT_BUCKET = 1000
#: Hashes unpacked to bits at a time.
_CHUNK = 1 << 16


def _lowered(text: bytes) -> bytes:
    """bytes.lower changes A-Z only, bytes.split cuts at the six ASCII spaces only."""
    return b" ".join(text.lower().split())


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    normal = _lowered(text)
    if not normal:
        return 0
    spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
    n = max(1, len(spaces) + 2 - shingle)
    if n == 1:
        return xxhash.xxh64_intdigest(normal, SEED)
    starts = [0, *(spaces[: n - 1] + 1).tolist()]
    ends = [*spaces[shingle - 1 :].tolist(), len(normal)]
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, _CHUNK):
        part = [xxhash.xxh64_intdigest(normal[s:e], SEED) for s, e in zip(starts[a : a + _CHUNK], ends[a : a + _CHUNK])]
        ones += np.unpackbits(np.array(part, ">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    prepare(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(t, shingle) for t in utf8(batch.column(1))), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return per_batch(rows, work, "doc_id bigint, fp bigint")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have both bit i and bit j set, over all of them."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(0).to_numpy(zero_copy_only=False).astype(">i8").view(np.uint8)
        bits = np.unpackbits(raw).reshape(-1, BITS).astype(np.float32)
        both = (bits.T @ bits).astype(np.int64).ravel()
        return pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS), pa.int32()), pa.array(both), pa.array([batch.num_rows] * BITS * BITS, pa.int64())],
            names=["cell", "both", "n"],
        )

    sums = per_batch(fps.select("fp"), work, "cell int, both bigint, n bigint").groupBy("cell").agg(F.sum("both"), F.sum("n"))
    both, n = np.zeros(BITS * BITS), 0
    for cell, value, rows in sums.collect():
        both[cell], n = value, rows
    return n, both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal size; each grows by the bit most correlated with those it has."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = BITS // m + (g < BITS % m)
        rest = sorted(free)
        group = [max(rest, key=lambda b: correlation[b, rest].sum())]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: correlation[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def _within(p: np.ndarray, most: int) -> list[float]:
    """Chance that two random fingerprints differ by at most 0..most of these bits."""
    chance = np.zeros(most + 2)
    chance[0] = 1.0
    for q in p:
        differ = 2 * q * (1 - q)
        chance[1:] = chance[1:] * (1 - differ) + chance[:-1] * differ
        chance[0] *= 1 - differ
        chance[-1] = 0
    return list(np.cumsum(chance[: most + 1]))


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds (-1: not probed) of least estimated cost per fingerprint.

    For each number of partitions, a dynamic programme over partitions and the threshold sum spent so far adds
    the probes a threshold needs and the candidates it is expected to find.
    """
    p = both.diagonal() / max(n, 1)
    best_cost, best = float("inf"), []
    for m in range(1, min(MAX_PARTITIONS, radius + 2) + 1):
        groups = group_bits(n, both, m)
        total = radius - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            chance = _within(p[group], radius)
            grown: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in table.items():
                for t in range(-1, radius + 1):
                    probes = sum(comb(len(group), k) for k in range(t + 1))
                    more = cost + (probes + 1 + n * chance[t] if t >= 0 else 0)
                    if more < grown.get(spent + t, (float("inf"),))[0]:
                        grown[spent + t] = (more, [*chosen, t])
            table = grown
        if total in table and table[total][0] < best_cost:
            best_cost, best = table[total][0], list(zip(groups, table[total][1]))
    return best


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _mask(bits: list[int]) -> int:
    """Bit 0 is the most significant one."""
    return sum(1 << (BITS - 1 - b) for b in bits)


def _flips(bits: list[int], most: int) -> list[int]:
    return [_signed(_mask(list(chosen))) for k in range(most + 1) for chosen in combinations(bits, k)]


def _longs(values: list[int]):
    return F.expr("array(" + ",".join(f"{v}L" if v > -(1 << 63) else "(-9223372036854775807L - 1L)" for v in values) + ")")


def links(distinct: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges (a, b) between nodes whose fingerprints differ by at most ``radius`` bits.

    ``distinct`` has one row per fingerprint (fp, node). Outside hot buckets every close pair is an edge; the
    members of hot buckets are tied to one member per shared one-bit neighbour.
    """
    n, both = bit_moments(distinct)
    plan = [(k, bits, t) for k, (bits, t) in enumerate(allocate(n, both, radius)) if t >= 0]
    if radius > 2:
        raise ValueError("hot buckets are linked by one-bit neighbourhoods, which reach two bits")

    def keyed(spread: bool) -> DataFrame:
        parts = []
        for k, bits, t in plan:
            part = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))))
            values = F.transform(_longs(_flips(bits, t if spread else 0)), lambda x, part=part: part.bitwiseXOR(x))
            parts.append(F.transform(values, lambda v, k=k: F.struct(F.lit(k).alias("part"), v.alias("value"))))
        return distinct.select("fp", "node", F.explode(F.concat(*parts)).alias("key")).select("fp", "node", "key.part", "key.value")

    index, probes = keyed(False), keyed(True)
    crowded = index.groupBy("part", "value").count().where(F.col("count") > hot).select("part", "value")
    a = probes.join(crowded, ["part", "value"], "left_anti").select("part", "value", F.col("fp").alias("fp_a"), F.col("node").alias("a"))
    b = index.select("part", "value", F.col("fp").alias("fp_b"), F.col("node").alias("b"))
    close = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= radius
    # Spark sizes what is exploded as if it were not, and would broadcast millions of rows of a small table.
    pairs = a.join(b.hint("merge"), ["part", "value"]).where(close & (F.col("a") != F.col("b"))).select("a", "b")

    members = probes.join(crowded, ["part", "value"], "left_semi").select("fp", "node").distinct()
    near = members.select("node", F.explode(F.transform(_longs(_flips(list(range(BITS)), 1)), lambda x: F.col("fp").bitwiseXOR(x))).alias("value"))
    centres = near.groupBy("value").agg(F.min("node").alias("centre"))
    ties = near.join(centres.hint("merge"), "value").where(F.col("node") != F.col("centre")).select(F.col("node").alias("a"), F.col("centre").alias("b"))
    return pairs.unionByName(ties).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    doc_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    hot: int = HOT_BUCKET,
) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id reachable over links)."""
    fps = stored(fingerprints(docs, doc_col, text_col, shingle), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-distinct")
    labels = smallest_reachable(links(distinct, radius, hot))
    classes = distinct.join(labels, distinct["node"] == labels["id"], "left").select(
        "fp", F.coalesce("label", "node").alias("component_id")
    )
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the near-duplicates of a smaller doc_id; the rest unchanged.

    Of rows that repeat a doc_id one stays. Rows without a doc_id can't be told apart by it, and stay.
    """
    found = stored(near_duplicates(docs, **options), "simhash-components")
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id IS NULL"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
