"""Secret scans: three fixed patterns, and a guess-cost dynamic programme for values in credential context.

The patterns are applied to UTF-8 bytes (so that letter case is ASCII only) and reported in code points. The
dynamic programme finds the cheapest way to guess a value as a sequence of known words, dates, repeats, keyboard
walks and brute-force spans; a value that costs ``MIN_BITS`` or more is a secret. It judges the values that follow
a credential word and an assignment, and adds those that patterns do not cover completely, beside the patterns' spans.

A word costs the logarithm of its rank. Frequent parts of passwords come first; behind them come the words of the
corpus by the number of documents that hold them. Credential values are left out of that count, so that a secret that
is copied often does not become a word. Only words of ``MIN_DOCUMENTS`` documents or more count, and of those the
``MAX_WORDS`` most frequent, of equally frequent ones the alphabetically first: the dictionary stays below a few MB.

Defined results: NULL and empty texts have no spans; repeated rows are scanned alike; the cost of a value is linear
in its length, so long values are judged whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import per_batch, prepare, release_memory, utf8

MIN_BITS = 36.0
#: Documents that must hold a word of the dictionary, and its most words.
MIN_DOCUMENTS = 3
MAX_WORDS = 50_000
KINDS = ("assign", "access", "hex", "guess")

# The patterns of the contract.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Words that announce a credential, for the method's own candidates.
_CONTEXT = re.compile(
    rb"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret)[_-]?key|credentials?|auth|login)["']?\x20*(?:[:=]|\x20is\x20)\x20*["']?([^\s"'<>,;|]{8,})""",
    re.I,
)
_ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_CONTEXT_HINTS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"login")
_HEX_CLASS = bytes(0x68 if 48 <= c <= 57 or 97 <= c <= 102 else 0x20 for c in range(256))

# Frequent parts of passwords and placeholders, most frequent first.
WORDS = (
    "password pass word admin user login welcome letmein master secret token key api test example sample default change changeme "
    "your my the this here value string root guest hello dragon monkey sunshine princess football baseball shadow superman batman "
    "michael jordan love iloveyou summer winter spring autumn qwerty none null true false undefined placeholder redacted hidden "
    "required optional insert enter private public access server client database service account system dev prod staging local host"
).split()
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


@lru_cache(maxsize=1)
def _next_keys() -> dict[str, str]:
    """Keys that touch a key: its neighbours in the row, and those a half key away above and below."""
    at = {key: (x, y) for y, row in enumerate(KEY_ROWS) for x, key in enumerate(row)}
    near = lambda a, b: (a[1] == b[1] and abs(a[0] - b[0]) == 1) or (b[1] - a[1] == 1 and a[0] - b[0] in (0, 1)) or (a[1] - b[1] == 1 and b[0] - a[0] in (0, 1))
    return {k: "".join(o for o, q in at.items() if near(p, q)) for k, p in at.items()}


def _char_bits(c: str) -> float:
    """Brute force: the size of the class a character belongs to."""
    return log2(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)


_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")
_MAX_WORD = 24
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
#: Letters that stand between other signs than those values are made of.
_WORD = re.compile(rf"(?<![\w+/=.@$!-])[^\W\d_]{{3,{_MAX_WORD}}}(?![\w+/=@$-])")
_LEET = str.maketrans("013457@$!", "oieastasi")


def words_of(text: bytes) -> set[str]:
    """Lower-case words outside credential values."""
    if any(h in text.lower() for h in _CONTEXT_HINTS):
        text = _CONTEXT.sub(b" 0 ", _ASSIGN.sub(b" 0 ", text))
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


def learn_words(
    docs: DataFrame, *, text_col: str = "text", min_documents: int = MIN_DOCUMENTS, max_words: int = MAX_WORDS
) -> dict[str, int]:
    """Ranks of words, counted over whole texts; a batch passes each word on once."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in utf8(batch.column(0)):
                counts.update(words_of(text))
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        release_memory()

    counted = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "word string, n bigint")
    frequent = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents)
    found = [r["word"] for r in frequent.orderBy(F.desc("n"), "word").limit(max_words).select("word").collect()]
    return {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *found]))}


def guess_bits(value: str, ranks: dict[str, int] = _RANK) -> float:
    """Least cost of guessing ``value``, in bits.

    best[j] is the least cost of the first j characters. From each position a segment of every kind is offered: a
    word (its rank, one bit for capitals, one for substitutions), a date (days of a century), a repeat (of one to four
    characters, the cost of one copy plus the count), a walk over touching keys or neighbouring characters (the start,
    and a bit per turn), or one character by brute force. Each segment but the first costs one bit more.
    """
    low, n = value.lower(), len(value)
    keys = _next_keys()
    best = [0.0] + [float("inf")] * n

    def offer(end: int, cost: float) -> None:
        if cost < best[end]:
            best[end] = cost

    # Ends of the longest walk and of the longest repeat from each position, found from right to left.
    walk, turns, way = [0] * (n + 1), [0] * (n + 1), [None] * (n + 1)
    walk[n] = n
    for i in range(n - 1, -1, -1):
        walk[i] = i + 1
        if i + 1 < n:
            a, b = low[i], low[i + 1]
            step = ord(b) - ord(a)
            kind = ("code", step) if abs(step) == 1 and a.isalnum() and b.isalnum() else ("key", keys[a].index(b)) if b in keys.get(a, "") else None
            if kind:
                same = walk[i + 1] > i + 2 and way[i + 1][0] == kind[0]
                walk[i] = walk[i + 1] if same else i + 2
                turns[i] = turns[i + 1] + (way[i + 1] != kind) if same else 0
                way[i] = kind
    same_as = {p: [0] * (n + 1) for p in range(1, 5)}
    for p, run in same_as.items():
        for i in range(n - p - 1, -1, -1):
            run[i] = run[i + 1] + 1 if low[i] == low[i + p] else 0
    plain = low.translate(_LEET)
    for i in range(n):
        base = best[i] + (1.0 if i else 0.0)
        offer(i + 1, best[i] + _char_bits(value[i]) + (0.0 if i else 1.0))
        for size in range(3, min(_MAX_WORD, n - i) + 1):
            part = low[i : i + size]
            rank = ranks.get(part)
            changed = rank is None
            rank = rank or ranks.get(plain[i : i + size])
            if rank:
                offer(i + size, base + log2(rank + 1) + changed + (value[i : i + size] != part))
        date = _DATE.match(value, i)
        if date:
            offer(date.end(), base + log2(36525 if date.end() - i > 4 else 200))
        for p, run in same_as.items():
            if run[i] >= max(p, 2):
                offer(i + p + run[i], base + sum(_char_bits(c) for c in value[i : i + p]) + log2(run[i] / p + 1))
        if walk[i] - i >= 3:
            offer(walk[i], base + log2(47) + turns[i] + log2(walk[i] - i))
    return best[n]


def spans_of(text: bytes, min_bits: float = MIN_BITS, ranks: dict[str, int] = _RANK) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and kind."""
    low = text.lower()
    found: list[tuple[int, int, str]] = []
    if any(h in low for h in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= _LEAST["access"]]
    if b"h" * _LEAST["hex"] in text.translate(_HEX_CLASS):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= _LEAST["hex"]]
    if any(h in low for h in _CONTEXT_HINTS):
        covered: list[list[int]] = []  # runs of bytes that patterns cover, in order
        for start, end, _ in sorted(found):
            if covered and start <= covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], end)
            else:
                covered.append([start, end])
        begins = [start for start, _ in covered]
        for m in _CONTEXT.finditer(text):
            before = bisect_right(begins, m.start(1))  # runs that begin at the value or before it
            if before and covered[before - 1][1] >= m.end(1):
                continue
            if guess_bits(m[1].decode("utf-8", "replace"), ranks) >= min_bits:
                found.append((m.start(1), m.end(1), "guess"))
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def _points(text: bytes, spans: list[tuple[int, int, str]]) -> list[dict]:
    if not spans:
        return []
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"kind": k, "start": int(points[s]), "end": int(points[e])} for s, e, k in spans]


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(
    docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", min_bits: float = MIN_BITS, words: dict[str, int] | None = None
) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end in code points), by start and kind.

    ``words`` (rank by word) is learnt from the texts where it is not given.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn_words(docs, text_col=text_col) if words is None else words)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [_points(t, spans_of(t, min_bits, shared.value)) for t in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW_SPANS)], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return per_batch(rows, work, f"doc_id bigint, spans {SPANS}")


MARK = "[SECRET]"


def redact(
    docs: DataFrame,
    *,
    text_col: str = "text",
    length_col: str | None = None,
    min_bits: float = MIN_BITS,
    mark: str = MARK,
    words: dict[str, int] | None = None,
) -> DataFrame:
    """``docs`` with every run of overlapping spans replaced by ``mark``; rows without spans stay as they are.

    ``length_col`` (bigint), where given, gets the new number of code points of a changed text. ``words`` as in ``scan``.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn_words(docs, text_col=text_col) if words is None else words)
    place = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        lengths = batch.column(length_at).to_pylist() if length_at is not None else None
        for row, value in enumerate(batch.column(place)):
            text = value.as_py()
            spans = spans_of(text.encode(), min_bits, shared.value) if text else []
            if spans:
                raw, out, at = text.encode(), [], 0
                for start, end, _ in spans:
                    if start >= at:
                        out += [raw[at:start], mark.encode()]
                    at = max(at, end)
                text = b"".join([*out, raw[at:]]).decode()
                if lengths is not None:
                    lengths[row] = len(text)
            texts.append(text)
        columns = list(batch.columns)
        columns[place] = pa.array(texts, pa.string())
        if lengths is not None:
            columns[length_at] = pa.array(lengths, batch.schema.types[length_at])
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return per_batch(docs, work, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        number("guess"),
    )
