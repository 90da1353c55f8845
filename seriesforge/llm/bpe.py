"""Byte-level BPE encoding and decoding.

Pre-tokenisation needs no regular expression. Each code point is looked up in a class table; two characters of
look-ahead turn the classes into eight symbols (letter, number, other, the start of a two- or three-character
contraction, white space before white space or the end, a last space, other last white space) and a ninth between
texts. A symbol is a transition function on eight states. Functions compose associatively, so a block of text is
reduced to one function, the functions of all blocks are scanned, and a last pass walks all blocks side by side from
their known first states and marks where tokens begin. Pieces between those marks are merged by rank; merged pieces
are cached. Token ends (in bytes) are kept: decoding puts each token into the slice they name and checks its size.

Defined results: NULL and empty texts have no tokens and decode to nothing; repeated rows are encoded alike;
strings that look like special tokens are ordinary text; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.llm.common import prepare, utf8

CACHED_PIECES = 50_000
#: Bytes of text taken through the scan together, or one text if that is longer.
SCAN_BYTES = 1 << 18
_BLOCK = 256
#: Tokens decoded together.
_TOGETHER = 1 << 16
#: Longer pieces are merged with a heap.
_LONG_PIECE = 64

# Unicode White_Space, and the contractions of the pattern.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_LETTER, _NUMBER, _OTHER, _SHORT, _LONG, _SPACE_ON, _SPACE_LAST, _WHITE_LAST, _BREAK = range(9)
_FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _AFTER_SPACE, _IN_WHITE, _TWO_LEFT, _ONE_LEFT = range(8)
#: Between two texts; beyond all code points.
_GAP = sys.maxunicode + 1


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """_LETTER, _NUMBER, _OTHER or _SPACE_ON (any white space) of each code point."""
    first = "".join(unicodedata.category(chr(c))[0] for c in range(_GAP))
    kinds = np.frombuffer(first.encode(), np.uint8)
    table = np.full(_GAP + 1, _OTHER, np.uint8)
    table[:-1][kinds == ord("L")] = _LETTER
    table[:-1][kinds == ord("N")] = _NUMBER
    table[WHITE_SPACE] = _SPACE_ON
    table[_GAP] = _BREAK
    return table


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and begins[state, symbol]: whether a token begins with that symbol."""
    follow = np.zeros((8, 9), np.uint8)
    begins = np.ones((8, 9), bool)
    follow[:, _LETTER], follow[:, _NUMBER], follow[:, _OTHER] = _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS
    for symbol, state in ((_LETTER, _IN_LETTERS), (_NUMBER, _IN_NUMBERS), (_OTHER, _IN_OTHERS)):
        begins[[state, _AFTER_SPACE], symbol] = False
    for symbol, left in ((_SHORT, _ONE_LEFT), (_LONG, _TWO_LEFT)):
        follow[:, symbol] = left
        follow[[_IN_OTHERS, _AFTER_SPACE], symbol] = _IN_OTHERS
        begins[[_IN_OTHERS, _AFTER_SPACE], symbol] = False
    follow[_TWO_LEFT, _LETTER], follow[_ONE_LEFT, _LETTER] = _ONE_LEFT, _FRESH
    begins[[_TWO_LEFT, _ONE_LEFT], _LETTER] = False
    follow[:, _SPACE_ON], follow[:, _SPACE_LAST] = _IN_WHITE, _AFTER_SPACE
    begins[_IN_WHITE, _SPACE_ON] = False
    return follow, begins  # _WHITE_LAST and _BREAK begin a token and lead to _FRESH


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the nine functions: their numbers, the image of each state, and the product table."""
    follow, begins = _transitions()
    known = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    symbols = [tuple(int(x) for x in follow[:, s]) for s in range(9)]
    while todo:
        f = todo.pop()
        for g in symbols:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    images = np.array(list(known), np.uint8)
    product = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], np.uint16)
    return follow, begins, images, product, np.array([known[s] for s in symbols], np.uint16)


def _symbols(points: np.ndarray) -> np.ndarray:
    symbols = _classes()[points]
    after = np.append(symbols[1:], _BREAK)
    white = symbols == _SPACE_ON
    last = white & (after != _SPACE_ON) & (after != _BREAK)
    symbols[last] = np.where(points[last] == 0x20, _SPACE_LAST, _WHITE_LAST)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.append(points, [_GAP, _GAP])
        one, two = padded[quotes + 1], padded[quotes + 2]
        for c in CONTRACTIONS:
            hit = one == ord(c[0])
            if len(c) == 2:
                hit &= two == ord(c[1])
            symbols[quotes[hit]] = _SHORT if len(c) == 1 else _LONG
    return symbols


def token_starts(points: np.ndarray) -> np.ndarray:
    """Indices where a piece (or a gap) begins in a sequence of code points, with ``_GAP`` between texts."""
    follow, begins, images, product, number = _monoid()
    symbols = _symbols(points)
    n = len(symbols)
    blocks = -(-n // _BLOCK)
    rows = np.full(blocks * _BLOCK, _BREAK, np.uint8)
    rows[:n] = symbols
    rows = np.ascontiguousarray(rows.reshape(blocks, _BLOCK).T)

    step = np.ascontiguousarray(product[:, number]).ravel()
    whole = number[rows[0]].astype(np.intp)
    for row in rows[1:]:
        whole = step[whole * 9 + row].astype(np.intp)
    reach = 1
    while reach < blocks:  # inclusive scan by doubling
        whole[reach:] = product[whole[:-reach], whole[reach:]]
        reach *= 2

    state = np.full(blocks, _FRESH, np.intp)
    state[1:] = images[whole[:-1], _FRESH]
    follow, begins = follow.ravel(), begins.ravel()
    marks = np.empty(rows.shape, bool)
    for i, row in enumerate(rows):
        at = state * 9 + row
        marks[i] = begins[at]
        state = follow[at].astype(np.intp)
    return np.flatnonzero(marks.T.ravel()[:n])


_NO_RANK = 1 << 60


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Join the neighbouring pair of lowest rank, leftmost first, until no pair has a rank."""
    if piece in ranks:
        return (ranks[piece],)
    n = len(piece)
    if n > _LONG_PIECE:
        return _merge_long(piece, ranks)
    rank_of = ranks.get
    cuts = list(range(n + 1))  # part i is piece[cuts[i] : cuts[i + 1]]
    pairs = [rank_of(piece[i : i + 2], _NO_RANK) for i in range(n - 1)]
    while pairs:
        least = min(pairs)
        if least == _NO_RANK:
            break
        i = pairs.index(least)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank_of(piece[cuts[i] : cuts[i + 2]], _NO_RANK)
        if i:
            pairs[i - 1] = rank_of(piece[cuts[i - 1] : cuts[i + 1]], _NO_RANK)
    return tuple([ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here
    before = list(range(-1, n - 1))
    live = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not live[i] or j >= n or end[j] != stop:
            continue
        live[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return tuple(ranks[piece[i : end[i]]] for i in range(n) if live[i])


class _Pieces(dict):
    """Merged pieces; of two generations, the older one is dropped when the younger is full."""

    def __init__(self, ranks: dict[bytes, int], size: int):
        super().__init__()
        self.ranks, self.size, self.old = ranks, size, {}

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        ids = self.old.get(piece) or merge(piece, self.ranks)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary of at most a few MB: base64 of the token and its rank, one per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encode_batch(texts: list[bytes], pieces: _Pieces) -> Iterator[list[int]]:
    """Ids of each text."""
    size, begin = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SCAN_BYTES:
            yield from _encode_together(texts[begin:i], pieces)
            size, begin = 0, i
        size += len(text)
    if begin < len(texts):
        yield from _encode_together(texts[begin:], pieces)


def _encode_together(texts: list[bytes], pieces: _Pieces) -> Iterator[list[int]]:
    read = [t.decode() for t in texts]
    points = np.frombuffer("\0".join(read).encode("utf-32-le"), np.uint32).copy()
    points[(np.cumsum([len(t) + 1 for t in read]) - 1)[:-1]] = _GAP
    starts = token_starts(points)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    width[points == _GAP] = 0
    offset = np.concatenate(([0], np.cumsum(width)))
    data = b"".join(texts)
    starts = starts[points[starts] != _GAP]
    at = offset[starts]
    bounds = np.searchsorted(at, np.concatenate(([0], np.cumsum([len(t) for t in texts])))).tolist()
    # 0xFF occurs in no UTF-8 text, so it can part the pieces.
    parted = np.insert(np.frombuffer(data, np.uint8), at, 0xFF).tobytes().split(b"\xff")[1:]
    found = list(map(pieces.__getitem__, parted))
    for lo, hi in zip(bounds, bounds[1:]):
        yield list(chain.from_iterable(found[lo:hi]))


def encode(
    docs: DataFrame,
    ranks_path: str,
    *,
    text_col: str = "text",
    ids_col: str = "ids",
    ends_col: str | None = "token_ends",
    cached: int = CACHED_PIECES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the ids of each whole text, and with the byte offset at which each token ends.

    ``ranks_path`` is read by the driver; the vocabulary (a few MB) is broadcast. ``ends_col=None`` leaves the
    offsets out, ``keep_text=False`` the text.
    """
    prepare(docs.sparkSession)
    ranks = load_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(t) for t in ranks]
    names = [c for c in docs.columns if c not in (ids_col, ends_col) and (keep_text or c != text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(shared.value, cached)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [np.array(i, np.int32) for i in encode_batch(list(utf8(batch.column("__utf8"))), pieces)]
            out = {name: batch.column(name) for name in names}
            flat = pa.array(np.concatenate(ids))
            cuts = pa.array([0, *accumulate(map(len, ids))], pa.int32())
            out[ids_col] = pa.ListArray.from_arrays(cuts, flat)
            if ends_col:
                ends = [np.cumsum(sizes[i]) for i in ids]
                out[ends_col] = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(ends) if ends else [], pa.int64()))
            yield pa.RecordBatch.from_pydict(out)

    fields = [docs.schema[c] for c in names] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if ends_col:
        fields.append(T.StructField(ends_col, T.ArrayType(T.LongType())))
    given = docs.select(*names, F.col(text_col).cast("binary").alias("__utf8"))
    return given.mapInArrow(run, T.StructType(fields))


def _put_together(ids: np.ndarray, ends: np.ndarray, vocabulary: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """Each token's bytes in the slice that its offsets name."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes)):
        raise ValueError("ids that the vocabulary lacks")
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    begins = np.concatenate(([0], ends))
    if not np.array_equal(np.diff(begins), sizes[ids]) or not sizes[ids].all():
        raise ValueError("token ends that do not belong to the ids")
    for a in range(0, len(ids), _TOGETHER):
        some = ids[a : a + _TOGETHER]
        begin, end = begins[a : a + len(some)], begins[a + len(some)]
        out[begin[0] : end] = vocabulary[np.repeat(starts[some] - begin, sizes[some]) + np.arange(begin[0], end)]
    return out.tobytes()


def decode(
    encoded: DataFrame, ranks_path: str, *, ids_col: str = "ids", ends_col: str | None = "token_ends", bytes_col: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes that the ids stand for in place of the ids and their offsets.

    Every token goes to the slice between its neighbours' ends. Ends that do not belong to the ids raise.
    ``ends_col=None``: the ends follow from the ids.
    """
    prepare(encoded.sparkSession)
    tokens = sorted((i, t) for t, i in load_ranks(ranks_path).items())
    sizes = np.zeros(tokens[-1][0] + 1, np.int64)
    sizes[[i for i, _ in tokens]] = [len(t) for _, t in tokens]
    shared = encoded.sparkSession.sparkContext.broadcast((b"".join(t for _, t in tokens), sizes))
    names = [c for c in encoded.columns if c not in (ids_col, ends_col, bytes_col)]

    def lists(column) -> tuple[np.ndarray, list[int]]:
        return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0)))).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, sizes = shared.value
        vocabulary, starts = np.frombuffer(body, np.uint8), np.concatenate(([0], np.cumsum(sizes)))
        for batch in batches:
            flat, cuts = lists(batch.column(ids_col))
            ends, end_cuts = lists(batch.column(ends_col)) if ends_col else (None, cuts)
            if end_cuts != cuts:
                raise ValueError("token ends that do not belong to the ids")
            texts = []
            for a, b in zip(cuts, cuts[1:]):
                ids = flat[a:b]
                texts.append(_put_together(ids, ends[a:b] if ends_col else np.cumsum(sizes[ids]), vocabulary, starts, sizes))
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | {bytes_col: pa.array(texts, pa.binary())})

    fields = [encoded.schema[c] for c in names] + [T.StructField(bytes_col, T.BinaryType())]
    return encoded.mapInArrow(run, T.StructType(fields))


def digest(docs: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of the contract: encode, decode, and take the digests of both."""
    encoded = encode(docs.select("doc_id", "text"), ranks_path, keep_text=False).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        "ids",
        "token_ends",
    )
    return decode(encoded, ranks_path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
