"""Phrases of a corpus, scored against their parts, from a weighted de Bruijn graph of words.

Nodes are word pairs, and a triple ``a b c`` is an edge from ``a b`` to ``b c``. Only edges are counted in the texts;
a piece is closed by an end mark, so each word occurrence is the beginning of exactly one edge, and edges into the end
mark are the corrections that pieces which end at a node or word ask for. All else follows from the graph: a node's
count is the flow that leaves it, end mark included, and a word's count is the flow of the nodes it begins.

A node whose flow enters by one edge and leaves by one edge is inner to a path; paths are compacted, as every phrase
along them has the same count. Inner nodes are never phrases of their own.

Edges travel packed: a task counts those of a few MB of text, and its distinct edges go to buckets by hash, one row a
bucket, as sorted and compressed lines. Buckets follow from the size of the corpus, and the hash of an edge spreads a
frequent word or pair over all of them. A bucket adds up its edges and passes on flow a node at a time.

Defined results: NULL, empty and wordless texts hold no words; NULL lang is ``und``; repeated rows count again; scores
that tie are ordered by count and phrase; languages without a candidate and an empty table give no rows; further
columns are ignored; texts of any length are read in blocks. Counts are 64-bit, products exact (38 digits). Arithmetic
beyond 38 digits (phrases counted over 10**16 times) raises.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import prepare, stored

BLOCK_TEXT = 8 << 20
#: Text whose edges one bucket adds up.
BUCKET_TEXT = 16 << 20
#: Edges of a compacted path that stand in one row.
PATH_ROW = 1000

# Every separator of pieces becomes a full stop; A-Z are lower-cased.
_MARKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b"." * len(_MARKS))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PACKED = "lang string, bucket int, body binary, counts binary"


def _pack(values: np.ndarray) -> bytes:
    """Positive counts, mostly small: the low bytes of all come first, so that zeros compress away."""
    return pa.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


class Lines:
    """Lines of text laid end to end, each with its line break, and where they end."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray):
        self.raw, self.ends = raw, ends

    @classmethod
    def of(cls, raw: bytes) -> Lines:
        data = np.frombuffer(raw, np.uint8)
        return cls(data, np.flatnonzero(data == 10) + 1)

    @classmethod
    def of_array(cls, values: pa.Array) -> Lines:
        """From an array of binary values, none of them cut off its buffers."""
        values = pa.concat_arrays([values])
        _, offsets, data = values.buffers()
        ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        return cls(raw[ends[0] : ends[-1]], ends[1:] - ends[0])

    def __len__(self) -> int:
        return len(self.ends)

    def array(self) -> pa.Array:
        offsets = np.concatenate([np.zeros(1, np.int64), self.ends.astype(np.int64)])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.raw)])

    def take(self, order: np.ndarray) -> Lines:
        return Lines.of_array(self.array().take(pa.array(order)))

    def slice(self, a: int, b: int) -> bytes:
        return self.raw[self.ends[a - 1] if a else 0 : self.ends[b - 1]].tobytes()

    def before(self, mark: int) -> Lines:
        """What stands before the one ``mark`` of each line, as lines."""
        starts = np.concatenate([np.zeros(1, np.int64), self.ends[:-1]])
        at = np.flatnonzero(self.raw == mark)
        step = np.zeros(len(self.raw) + 1, np.int8)
        step[starts] += 1
        step[at + 1] -= 1
        raw = self.raw[np.cumsum(step[:-1], dtype=np.int8).astype(bool)]
        ends = np.cumsum(at + 1 - starts)
        raw[ends - 1] = 10
        return Lines(raw, ends)

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(x) for x in self.array().to_pylist()), np.uint64, len(self))


def _rows(lang: str, bucket: np.ndarray, lines: Lines, counts: np.ndarray) -> Iterator[tuple]:
    """One packed row per bucket; rows come sorted by bucket."""
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], len(bucket))):
        text = lines.slice(a, b)
        body = len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)
        yield lang, int(bucket[a]), body, _pack(counts[a:b])


def _unpacked(body: bytes) -> Lines:
    return Lines.of(pa.decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True))


def _record(rows: list[tuple]) -> pa.RecordBatch:
    lang, bucket, body, counts = zip(*rows) if rows else ((), (), (), ())
    columns = [pa.array(lang, pa.string()), pa.array(bucket, pa.int32()), pa.array(body, pa.binary()), pa.array(counts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "body", "counts"])


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def _spread(value: np.ndarray, buckets: int) -> np.ndarray:
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return ((value >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def count_edges(tokens: list[bytes], begins: int, lang: str, buckets: int) -> list[tuple]:
    """Packed edges that begin at the first ``begins`` of ``tokens``, where ``.`` ends a piece.

    An edge is the line ``a b<TAB>c``; ``b`` and ``c`` are empty behind the end of the piece.
    """
    coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
    by_text = pc.array_sort_indices(coded.dictionary)
    words = coded.dictionary.take(by_text)
    # Numbers follow the order of the words, so that sorted edges are sorted lines; 0 is the end.
    number = np.empty(len(words), np.int64)
    number[by_text.to_numpy()] = np.arange(1, len(words) + 1)
    mark = pc.index(coded.dictionary, pa.scalar(b".", pa.large_binary())).as_py()
    if mark >= 0:
        number[mark] = 0
    ids = number[coded.indices.to_numpy(zero_copy_only=False)]
    padded = np.concatenate([ids, np.zeros(2, np.int64)])
    a, b, c = padded[:begins], padded[1 : begins + 1], padded[2 : begins + 2]
    real = a > 0
    a, b = a[real], b[real]
    c = np.where(b > 0, c[real], 0)
    if not len(a):
        return []
    width = len(words) + 1
    pair, pair_of = np.unique(a * width + b, return_inverse=True)
    key, n = np.unique(pair_of.astype(np.int64) * width + c, return_counts=True)
    c, ab = key % width, pair[key // width]
    a, b = ab // width, ab % width
    texts = pa.concat_arrays([pa.array([b""], pa.large_binary()), words])
    h = np.concatenate([np.zeros(1, np.uint64), _hashes(words)])
    bucket = _spread((h[a] * _MIX ^ h[b]) * _MIX ^ h[c], buckets)
    order = np.argsort(bucket.astype(np.int32), kind="stable")
    first, second, third = (texts.take(pa.array(x[order])) for x in (a, b, c))
    marks = [pa.scalar(m, pa.large_binary()) for m in (b" ", b"\t", b"\n", b"")]
    edges = pc.binary_join_element_wise(first, marks[0], second, marks[1], third, marks[2], marks[3])
    return list(_rows(lang, bucket[order], Lines.of_array(edges), n[order].astype(np.int64)))


def _edge_blocks(docs: DataFrame, buckets: int, block_text: int) -> DataFrame:
    """Packed edges of blocks of text; documents of a language follow each other, and long ones are cut between words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, list[bytes]] = {}
        size = 0

        def counted(lang: str, carry: list[bytes], data: bytes, last: bool) -> tuple[list[tuple], list[bytes]]:
            tokens = carry + data.replace(b".", b" . ").split()
            begins = len(tokens) if last else max(0, len(tokens) - 2)
            return (count_edges(tokens, begins, lang, buckets) if begins else []), tokens[begins:]

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, texts in open_.items():
                rows, _ = counted(lang, [], b".".join(texts), True)
                if rows:
                    yield _record(rows)
            open_.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                data = (text.as_py() or b"").translate(_FOLD)
                if len(data) > block_text:  # on its own, block by block; the last two words begin the next block
                    at, carry = 0, []
                    while at < len(data):
                        stop = at + block_text
                        if stop < len(data):
                            ends = [x for x in (data.find(s, stop) for s in (b" ", b"\t", b".")) if x >= 0]
                            stop = min(ends, default=len(data))
                        else:
                            stop = len(data)
                        rows, carry = counted(lang, carry, data[at:stop], stop == len(data))
                        if rows:
                            yield _record(rows)
                        at = stop
                    continue
                open_.setdefault(lang, []).append(data)
                size += len(data)
                if size >= block_text:
                    yield from flushed()
                    size = 0
        yield from flushed()

    return docs.mapInArrow(run, _PACKED)


def _total(lines: Lines, counts: np.ndarray) -> tuple[Lines, np.ndarray]:
    """Distinct lines and their summed counts."""
    total = pa.table({"k": lines.array(), "n": counts}).group_by("k", use_threads=False).aggregate([("n", "sum")])
    return Lines.of_array(total.column("k").combine_chunks()), total.column("n_sum").to_numpy()


def _summed(table: pa.Table) -> tuple[Lines, np.ndarray]:
    """Distinct lines of packed rows, and their counts."""
    parts = [_unpacked(body) for body in table.column("body").to_pylist()]
    counts = [_unpack(packed, len(own)) for packed, own in zip(table.column("counts").to_pylist(), parts)]
    return _total(Lines.of_array(pa.concat_arrays([own.array() for own in parts])), np.concatenate(counts))


def _words_of(lines: Lines, often: np.ndarray, marks: bytes) -> list[pa.Array]:
    """The words of the lines chosen, one array per place; ``marks`` stand between them."""
    rows = lines.array().filter(pa.array(often)).to_pylist()
    out = []
    for mark in reversed(marks):
        halves = [r.removesuffix(b"\n").rsplit(bytes([mark]), 1) for r in rows]
        out.insert(0, pa.array([x[1] for x in halves], pa.large_binary()))
        rows = [x[0] for x in halves]
    return [pa.array(rows, pa.large_binary()), *out]


_FOUND = "lang string, bucket int, body binary, counts binary, w1 string, w2 string, w3 string, n bigint"


def _found(lang: str, rows: list[tuple], words: Sequence[pa.Array], counts: np.ndarray) -> pa.Table:
    """Packed rows, then plain rows of up to three words and a count, under one schema."""
    packed = _record(rows)
    m, k = len(rows), len(counts)
    text = [pa.concat_arrays([pa.nulls(m, pa.string()), w.cast(pa.large_string()).cast(pa.string())]) for w in words]
    text += [pa.nulls(m + k, pa.string())] * (3 - len(text))
    columns = [
        pa.array([lang] * (m + k), pa.string()),
        pa.concat_arrays([packed.column("bucket"), pa.nulls(k, pa.int32())]),
        pa.concat_arrays([packed.column("body"), pa.nulls(k, pa.binary())]),
        pa.concat_arrays([packed.column("counts"), pa.nulls(k, pa.binary())]),
        *text,
        pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(counts, pa.int64())]),
    ]
    return pa.Table.from_arrays(columns, names=["lang", "bucket", "body", "counts", "w1", "w2", "w3", "n"])


@dataclass
class Graph:
    """What is left of the graph at a least count: edges (lang, w1, w2, w3, n), nodes (lang, w1, w2, n), words
    (lang, w1, n), and the words of each language (lang, n)."""

    edges: DataFrame
    nodes: DataFrame
    words: DataFrame
    sizes: DataFrame


def build(docs: DataFrame, *, least: int = 10, block_text: int = BLOCK_TEXT, bucket_text: int = BUCKET_TEXT) -> Graph:
    """Count the edges of ``docs`` (text, lang) and derive all shorter counts from them."""
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_text))

    def add_edges(key, table):
        lang = key[0].as_py()
        lines, counts = _summed(table)
        flow_of, flow = _total(lines.before(ord("\t")), counts)
        bucket = _spread(flow_of.hashes(), buckets)
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        rows = list(_rows(lang, bucket[order], flow_of.take(order), flow[order]))
        often = counts >= least
        words = _words_of(lines, often, b" \t")
        whole = pc.not_equal(words[2], pa.scalar(b"", words[2].type))
        return _found(lang, rows, [w.filter(whole) for w in words], counts[often][whole.to_numpy(zero_copy_only=False)])

    def add_nodes(key, table):
        lang = key[0].as_py()
        lines, counts = _summed(table)
        flow_of, flow = _total(lines.before(ord(" ")), counts)
        often = counts >= least
        first, second = _words_of(lines, often, b" ")
        whole = pc.not_equal(second, pa.scalar(b"", second.type))
        kept = counts[often][whole.to_numpy(zero_copy_only=False)]
        (alone,) = _words_of(flow_of, np.ones(len(flow_of), bool), b"")
        alone = pa.array([w.removesuffix(b"\n") for w in alone.to_pylist()], pa.large_binary())
        words = pa.concat_arrays([first.filter(whole), alone])
        others = pa.concat_arrays([second.filter(whole), pa.nulls(len(flow_of), second.type)])
        return _found(lang, [], [words, others], np.concatenate([kept, flow]))

    groups = 3 * buckets  # partitions, so that several languages spread
    blocks = _edge_blocks(texts, buckets, block_text).repartition(groups, "lang", "bucket")
    summed = stored(blocks.groupBy("lang", "bucket").applyInArrow(add_edges, _FOUND), "phrases-edges")
    flows = summed.where("bucket IS NOT NULL").select("lang", "bucket", "body", "counts").repartition(groups, "lang", "bucket")
    found = stored(flows.groupBy("lang", "bucket").applyInArrow(add_nodes, _FOUND), "phrases-nodes")
    words = stored(found.where("w2 IS NULL").groupBy("lang", "w1").agg(F.sum("n").alias("n")), "phrases-words")
    return Graph(
        summed.where("bucket IS NULL").select("lang", "w1", "w2", "w3", "n"),
        found.where("w2 IS NOT NULL").select("lang", "w1", "w2", "n"),
        words.where(F.col("n") >= least),
        words.groupBy("lang").agg(F.sum("n").alias("n")),
    )


def _node(a: str, b: str) -> Column:
    return F.concat_ws(" ", a, b)


def compact(graph: Graph) -> DataFrame:
    """(lang, head, part, words, n, inner_start): paths of the graph, each edge in one of them, cut after ``PATH_ROW`` edges.

    An inner node has an edge in and an edge out that carry all its flow. Flow only enters where a piece begins, so a
    closed ring of inner nodes can't exist, and each inner node finds the first of its path by pointer doubling: as
    many rounds as the longest path between two branchings has binary digits.
    """
    flow = graph.nodes.select("lang", _node("w1", "w2").alias("node"), F.col("n").alias("flow"))
    edges = graph.edges.select("lang", _node("w1", "w2").alias("source"), _node("w2", "w3").alias("target"), "w1", "w2", "w3", "n")
    entered = edges.join(flow.withColumnRenamed("node", "target"), ["lang", "target"]).where("n = flow")
    left = edges.join(flow.withColumnRenamed("node", "source"), ["lang", "source"]).where("n = flow")
    inner = entered.select("lang", F.col("target").alias("node"), F.col("source").alias("before")).join(
        left.select("lang", F.col("source").alias("node")), ["lang", "node"]
    )
    inner = stored(inner, "phrases-inner")
    first = inner.select("lang", F.col("node").alias("before"), F.lit(True).alias("known"))
    # ``back`` is an inner node ``steps`` before this one; done where nothing inner stands before it.
    chain = inner.join(first, ["lang", "before"], "left").select(
        "lang", "node", F.when(F.col("known"), F.col("before")).otherwise(F.col("node")).alias("back"),
        F.when(F.col("known"), 1).otherwise(0).cast("bigint").alias("steps"), F.col("known").isNull().alias("done"),
    )
    chain = stored(chain, "phrases-chain")
    while not chain.where("NOT done").isEmpty():
        there = chain.select(
            "lang", F.col("node").alias("back"), F.col("back").alias("back_"), F.col("steps").alias("steps_"), F.col("done").alias("done_")
        )
        chain = stored(
            chain.where("done").unionByName(
                chain.where("NOT done").join(there, ["lang", "back"]).select(
                    "lang", "node", F.col("back_").alias("back"), (F.col("steps") + F.col("steps_")).alias("steps"), F.col("done_").alias("done")
                )
            ),
            "phrases-chain",
        )
    # An edge out of an inner node continues that node's path; an edge into one begins it; any other is a path of its own.
    ends = chain.select("lang", F.col("node").alias("source"), F.col("back").alias("of_source"), F.col("steps").alias("steps"))
    starts = chain.select("lang", F.col("node").alias("target"), F.col("back").alias("of_target"))
    placed = edges.join(ends, ["lang", "source"], "left").join(starts, ["lang", "target"], "left")
    at = F.coalesce(F.col("steps") + 1, F.lit(0))
    placed = placed.select(
        "lang", "w1", "w2", "w3", "n", F.col("of_source").isNotNull().alias("inner"),
        F.coalesce("of_source", "of_target", F.concat_ws(" ", "w1", "w2", "w3")).alias("head"), at.alias("at"),
        F.expr(f"coalesce(steps + 1, 0) div {PATH_ROW}").alias("part"),
    )
    triples = F.sort_array(F.collect_list(F.struct("at", "w1", "w2", "w3", "inner")))
    return placed.groupBy("lang", "head", "part", "n").agg(triples.alias("triples")).select(
        "lang",
        "head",
        "part",
        F.concat(F.expr("array(triples[0].w1, triples[0].w2)"), F.col("triples.w3")).alias("words"),
        "n",
        F.element_at("triples", 1)["inner"].alias("inner_start"),
    )


def _triples_of(paths: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, n, inner): the edges along the paths; ``inner`` tells that the first pair is an inner node."""
    places = F.posexplode(F.expr("transform(sequence(0, size(words) - 3), i -> struct(words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3))"))
    long = paths.select("lang", "n", "inner_start", places.alias("i", "t"))
    return long.select("lang", "t.*", "n", ((F.col("i") > 0) | F.col("inner_start")).alias("inner"))


def _score(a: str, parts: Sequence[tuple[str, str]]) -> Column:
    """(score, l, r) of the lowest-scoring cut, the first of those that tie."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    top = big(a) * big(a) * F.lit(1_000_000).cast("decimal(38,0)")
    cuts = []
    for k, (l, r) in enumerate(parts):
        below = big(l) * big(r)
        whole = ((top - F.pmod(top, below)) / below).cast("bigint")
        cuts.append(F.struct(whole.alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")))
    return F.array_min(F.array(*cuts))


def mine(docs: DataFrame, *, least: int = 10, covered_percent: int = 50, top: int = 2000, **sizes) -> DataFrame:
    """Phrases of two and three words: lang, rank, phrase, a, l, r, n, score; ``top`` of each language."""
    graph = build(docs, least=least, **sizes)
    triples = stored(_triples_of(compact(graph)), "phrases-triples")
    word = lambda at, name: graph.words.select("lang", F.col("w1").alias(at), F.col("n").alias(name))
    pair = lambda x, y, name: graph.nodes.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("n").alias(name))
    three = (
        triples.join(pair("w1", "w2", "f12"), ["lang", "w1", "w2"])
        .join(pair("w2", "w3", "f23"), ["lang", "w2", "w3"])
        .join(word("w1", "f1"), ["lang", "w1"])
        .join(word("w3", "f3"), ["lang", "w3"])
        .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), _score("n", [("f1", "f23"), ("f12", "f3")]).alias("cut"))
    )
    # The largest count of a longer phrase that holds the pair; inner nodes lie on a path that carries all their flow.
    sides = F.inline(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")), F.struct(F.col("w2").alias("x"), F.col("w3").alias("y"))))
    longer = triples.select("lang", "n", sides).groupBy("lang", "x", "y").agg(F.max("n").alias("longer"))
    inner = triples.where("inner").select("lang", F.col("w1").alias("x"), F.col("w2").alias("y"))
    two = (
        pair("x", "y", "n")
        .join(inner, ["lang", "x", "y"], "left_anti")
        .join(longer, ["lang", "x", "y"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("n")))
        .join(word("x", "f1"), ["lang", "x"])
        .join(word("y", "f2"), ["lang", "y"])
        .select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), F.col("n").alias("a"), _score("n", [("f1", "f2")]).alias("cut"))
    )
    scored = stored(three.unionByName(two).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "phrases-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranks within shares of a language first, so that no task orders more than a share and the shares' tops.
    shares = max(1, scored.count() // 100_000)
    salted = scored.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(graph.sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
