"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A chunk of text that holds digits or signs that may stand for letters, repeats a letter three times or more, or consists of single
letters set apart is a character lattice: every sign offers the letters it may stand for, every repetition one or two
copies, every gap between single characters a word break or none. A Viterbi search under a trigram character model picks the most likely word. The restored words and their
beginnings are looked up among features learnt from labelled documents; the strongest evidence, its amount and its
density go through a logistic function.

Learning uses all labelled rows whose crc32(doc_id as text) mod 5 is not 0. One half of them gives the character model
and the features, the other half the logistic weights; Spark adds up the counts of the one and, for each Newton step, the
sums of the other. Labels, lang, source and doc_id are no inputs of a score.

Defined results: NULL, empty and letterless texts are scored by their lack of evidence; repeated rows score alike;
rows without a label and labels without a document teach nothing; without labels of both kinds every score is the
share of toxic labels (0 without any); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, inf, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import per_batch, prepare, release_memory, stored, utf8

#: Labels up to which they are broadcast to the texts.
BROADCAST_ROWS = 1_000_000
FOLDS = 5
#: Features are whole words and beginnings of these lengths.
BEGINNINGS = (4, 5, 6, 7)
#: Letters that all features of a word share.
HEAD = min(BEGINNINGS)
LEAST_TOXIC_DOCS = 4
LEAST_Z = 4.0
#: Of an Arrow batch; what is counted in one takes some twenty times as much.
BATCH_BYTES = "2m"
#: Words whose trigrams are counted at once.
COUNTED_WORDS = 50_000
CACHED_CHUNKS = 200_000
#: Longer chunks are decoded each time, so that the cache stays small.
CACHED_CHARS = 200

# Letters that digits and signs stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou",
}
#: Log-likelihood of the channel: a sign for a letter, a dropped copy of a repeated letter.
_SIGN, _DROP = log(0.2), log(0.5)
_LEET = re.compile("[" + re.escape("".join(STANDS_FOR)) + "]")
_LETTERS = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"(?<!\S)[^\W\d_](?:[\s.\-_*]{1,3}[^\W\d_]){2,}(?!\S)")
#: Three or more single characters between white space, with or without marks around; and one of them after its gap.
_RUN = re.compile(r"(?<!\S)[.\-_]*[^\s.\-_][.\-_]*(?:\s+[.\-_]*[^\s.\-_][.\-_]*){2,}(?!\S)")
_PLACE = re.compile(r"([\s.\-_]*)([^\s.\-_])")
_MARKS = "!?()[]{}<>|*#+.,:;-_=~\"'"
#: Signs around a word that stand for no letter.
_PLAIN_MARKS = ".,:;?\"'-_=~<>)[]{}"
_EDGE = re.compile(r"^\W+|[\W_]+$")


@dataclass
class CharModel:
    """Add-one trigram model over the commonest letters; ``^`` begins and ``$`` ends a word."""

    counts: dict[str, float] = field(default_factory=dict)
    contexts: dict[str, float] = field(default_factory=dict)
    letters: int = 1

    def __post_init__(self):
        """Logarithms of seen trigrams, of others after a seen context, and of the rest."""
        of = lambda n, context: log((n + 0.1) / (self.contexts.get(context, 0) + 0.1 * self.letters))
        self.seen = {gram: of(n, gram[:2]) for gram, n in self.counts.items()}
        self.unseen = {context: of(0, context) for context in self.contexts}
        self.unknown = of(0, "")

    def __reduce__(self):
        return CharModel, (self.counts, self.contexts, self.letters)

    @classmethod
    def of(cls, trigrams: dict[str, int]) -> CharModel:
        contexts: Counter[str] = Counter()
        for gram, n in trigrams.items():
            contexts[gram[:2]] += n
        return cls(dict(trigrams), dict(contexts), len({g[2] for g in trigrams}) + 1)

    def log_p(self, context: str, letter: str) -> float:
        p = self.seen.get(context + letter)
        return p if p is not None else self.unseen.get(context, self.unknown)


def trigrams_of(word: str) -> Iterator[str]:
    framed = f"^^{word}$"
    return (framed[i : i + 3] for i in range(len(framed) - 2))


def lattice(chunk: str) -> list[list[tuple[str, float]]]:
    """Per position the possible letters (empty: none) with their channel log-likelihood."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(chunk):
        c, j = chunk[i], i + 1
        if c in STANDS_FOR:
            out.append([(letter, _SIGN - log(len(STANDS_FOR[c]))) for letter in STANDS_FOR[c]])
        elif c.isalpha():
            while j < len(chunk) and chunk[j] == c:
                j += 1
            copies = j - i
            if copies >= 3:
                out.append([(c, 0.0), (c + c, _DROP)])
            else:
                out += [[(c, 0.0)]] * copies
        i = j
    return out


def decode(chunk: str, model: CharModel) -> str:
    """The most likely word of a chunk's lattice."""
    return _best(lattice(chunk), model)


def spaced_lattice(run: str) -> list[list[tuple[str, float]]]:
    """The lattice of single characters set apart: every gap is a word break (a space) or nothing."""
    out: list[list[tuple[str, float]]] = []
    i, places = 0, [(m[2], m[1]) for m in _PLACE.finditer(run)]
    while i < len(places):
        c, gap = places[i]
        j = i + 1
        while j < len(places) and places[j][0] == c and c.isalpha():
            j += 1
        options = [option for position in lattice(c) for option in position]
        if j - i >= 3:
            # One or two copies, or the end of one word and the beginning of the next.
            options = [(c, 0.0), *((letters, _DROP) for letters in (c + c, f"{c} {c}", f"{c}{c} {c}", f"{c} {c}{c}"))]
        else:
            j = i + 1
        if c == "*":  # also a separator
            options = [*options, ("", _DROP)]
        if options:
            if out:  # a wide gap is more likely to end a word
                out.append([("", _SIGN if len(gap) > 1 and gap.isspace() else 0.0), (" ", 0.0)])
            out.append(options)
        i = j
    return out


def _best(positions: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The most likely words of a lattice; states are the last two letters, and a space ends a word.

    Paths share their beginnings, so time and memory are linear in the lattice.
    """
    log_p, seen, unseen, unknown = model.log_p, model.seen.get, model.unseen.get, model.unknown
    beams: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for options in positions:
        grown: dict[str, tuple[float, tuple | None]] = {}
        for context, (score, path) in beams.items():
            for letters, channel in options:
                at, total = context, score + channel
                if len(letters) == 1 and letters != " ":  # the common case, without calls
                    p = seen(at + letters)
                    total += p if p is not None else unseen(at, unknown)
                    at = at[1] + letters
                    if at not in grown or total > grown[at][0]:
                        grown[at] = (total, (path, letters))
                    continue
                for letter in letters:
                    if letter == " ":
                        total += log_p(at, "$") if at != "^^" else -inf
                        at = "^^"
                    else:
                        total += log_p(at, letter)
                        at = at[1] + letter
                if at not in grown or total > grown[at][0]:
                    grown[at] = (total, (path, letters))
        beams = grown
    path = max(((score + log_p(context, "$"), path) for context, (score, path) in beams.items()), key=lambda b: b[0])[1]
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def readings_of(chunk: str) -> tuple[list[str], list[str]]:
    """Words that a lower-cased chunk between white space holds, and the parts of it that are to be decoded."""
    if chunk.isalpha():
        return [chunk], [chunk] if _TRIPLE.search(chunk) else []
    plain = chunk.strip(_PLAIN_MARKS)
    if plain.isalpha() and not _TRIPLE.search(plain):
        return [plain], []
    words = _LETTERS.findall(chunk)
    if not words and not _LEET.search(chunk):
        return words, []
    core = _EDGE.sub("", chunk)
    if not core:
        # Signs only: those that also end a sentence or set a word apart may be noise at an edge.
        left = chunk.lstrip(_MARKS)
        readings = dict.fromkeys([chunk, left, chunk.rstrip(_MARKS), left.rstrip(_MARKS)])
        return [], [reading for reading in readings if _LEET.search(reading)]
    readings = [] if core.isalpha() and not _TRIPLE.search(core) else [core]
    # A sign at an edge may be noise or a letter: all readings are offered.
    if chunk != core:
        at = chunk.index(core)
        end = at + len(core)
        before, after = (not STANDS_FOR.keys().isdisjoint(edge) for edge in (chunk[:at], chunk[end:]))
        readings += [chunk[:end]] * before + [chunk[at:]] * after + [chunk] * (before and after)
    parts = [p for p in re.split(r"[.\-_*]+", core) if p]
    if len(parts) >= 3 and all(len(p) == 1 for p in parts):
        words.append("".join(parts))
    return words, readings


def restored(chunk: str, model: CharModel) -> list[str]:
    """Words that a lower-cased chunk between white space may stand for."""
    words, readings = readings_of(chunk)
    return list(dict.fromkeys([*words, *(decode(reading, model) for reading in readings)]))


def spaced_words(text: str, model: CharModel) -> set[str]:
    """The words that the most likely paths through runs of single characters yield."""
    return {word for m in _RUN.finditer(text) for word in _best(spaced_lattice(m[0]), model).split()}


def _spaced(text: str) -> list[str]:
    """Runs of single letters set apart, read as one word each."""
    return ["".join(c for c in m[0] if c.isalpha()) for m in _APART.finditer(text)]


def features_of(word: str) -> list[str]:
    """A whole word, marked by its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    letters: CharModel
    weights: dict[str, float]
    logistic: list[float]


class _Scorer:
    """Evidence of chunks, cached: the strongest feature of the words that a chunk stands for.

    All features of a word begin with its first ``HEAD`` letters (or all letters and the end mark), so a word whose
    head no feature has is dropped unseen, and a lattice that leads to no such head is not decoded.
    """

    def __init__(self, model: Model):
        self.model = model
        self.heads = {feature[:HEAD] for feature in model.weights}
        self.beginnings = {head[:n] for head in self.heads for n in range(HEAD + 1)}
        #: Of the chunks seen: evidence above nothing, those without, and single characters set apart.
        self.strong: dict[str, tuple[float, str]] = {}
        self.weak: set[str] = set()
        self.single: set[str] = set()

    def word(self, word: str) -> tuple[float, str]:
        found, n = (0.0, ""), len(word)
        if n < 3 or (word[:HEAD] if n >= HEAD else word + "$") not in self.heads:
            return found
        weight = self.model.weights.get
        for feature in features_of(word):
            value = weight(feature)
            if value is not None and (value, feature) > found:
                found = value, feature
        return found

    def reaches(self, positions: list[list[tuple[str, float]]]) -> bool:
        """Whether a path through a lattice yields a word whose head a feature has."""
        found = {""} & self.beginnings
        for options in positions:
            grown = {(at + letters)[:HEAD] for at in found for letters, _ in options}
            found = grown & self.beginnings
            if not found:
                return False
            if any(len(at) == HEAD for at in found):
                return True
        return any(at + "$" in self.heads for at in found)

    def chunk(self, chunk: str) -> tuple[float, str]:
        words, readings = readings_of(chunk)
        found = max(map(self.word, words), default=(0.0, ""))
        for reading in readings:
            positions = lattice(reading)
            if self.reaches(positions):
                found = max(found, self.word(_best(positions, self.model.letters)))
        return found

    def look_up(self, chunks: set[str]) -> tuple[list[tuple[float, str]], set[str]]:
        """The evidence of chunks, where there is any, and the single characters among them."""
        strong, weak, single, heads = self.strong, self.weak, self.single, self.heads
        long_hits, long_single = [], set()
        for chunk in chunks.difference(weak, strong):
            if chunk[:HEAD] not in heads and len(chunk) >= HEAD and chunk.isalpha() and not _TRIPLE.search(chunk):
                if len(chunk) <= CACHED_CHARS:
                    weak.add(chunk)
                continue
            found = self.chunk(chunk)
            alone = len(chunk) == 1 or len(chunk.strip(".-_")) == 1
            if len(chunk) > CACHED_CHARS:
                if found[0] > 0:
                    long_hits.append(found)
                if alone:
                    long_single.add(chunk)
                continue
            if found[0] > 0:
                strong[chunk] = found
            else:
                weak.add(chunk)
            if alone:
                single.add(chunk)
        return [strong[c] for c in strong.keys() & chunks] + long_hits, (single & chunks) | long_single

    def evidence(self, text: str) -> list[float]:
        """Of the distinct chunks: the strongest and second strongest evidence, its sum, its density, and the most
        that one feature has gathered."""
        if len(self.weak) + len(self.strong) >= CACHED_CHUNKS:
            self.weak.clear(), self.strong.clear(), self.single.clear()
        low = text.lower()
        words = low.split()
        chunks = set(words)
        hits, single = self.look_up(chunks)
        if single and b"\1\1\1" in bytes(map(single.__contains__, words)):
            more = {*_spaced(low), *spaced_words(low, self.model.letters)} - chunks
            hits += self.look_up(more)[0]
            chunks |= more
        hits.sort(reverse=True)
        if not hits:
            return [0.0] * 5
        total, gathered = sum(v for v, _ in hits), Counter()
        for value, feature in hits:
            gathered[feature] += value
        size = log(2 + len(chunks))
        return [hits[0][0], hits[1][0] if len(hits) > 1 else 0.0, log1p(total), total / size**2, max(gathered.values()) / size]

    def score(self, text: str) -> float:
        z = self.model.logistic[0] + sum(w * x for w, x in zip(self.model.logistic[1:], self.evidence(text)))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def _fold(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def _trigram_counts(words: list[str], times: list[int]) -> dict[str, int]:
    """How often each trigram of the framed words occurs, if each word occurs as often as ``times`` says."""
    points = np.frombuffer("".join(f"^^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    inside = (points[:-2] != ord("$")) & (points[1:-1] != ord("$"))  # begins and ends in the same word
    grams, which = np.unique((points[:-2] << 42 | points[1:-1] << 21 | points[2:])[inside], return_inverse=True)
    counts = np.bincount(which, np.repeat(times, [len(w) + 3 for w in words])[:-2][inside])
    letters = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1)
    return {"".join(map(chr, g)): int(n) for g, n in zip(letters.tolist(), counts)}


def _counts(sample: DataFrame) -> DataFrame:
    """(kind, item, toxic, clean): trigrams by occurrence, features by document, counted over each batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_in, starts_in = (Counter(), Counter()), (Counter(), Counter())  # documents, clean and toxic ones
            for label, text in zip(batch.column("toxic").to_pylist(), utf8(batch.column("text"))):
                words = set(_LETTERS.findall(text.decode().lower()))
                words_in[bool(label)].update(words)
                starts: set[str] = words
                for n in reversed(BEGINNINGS):  # shorter ones are beginnings of the longer, and of words that have no longer
                    starts = {w[:n] for w in starts if len(w) >= HEAD}
                    starts_in[bool(label)].update(w for w in starts if len(w) == n)
            clean, toxic = starts_in
            grams: Counter[str] = Counter()
            for found, features in zip(words_in, starts_in):
                features.update({word + "$": n for word, n in found.items() if len(word) >= 3})
                words = list(found)
                for k in range(0, len(words), COUNTED_WORDS):
                    some = words[k : k + COUNTED_WORDS]
                    grams.update(_trigram_counts(some, [found[w] for w in some]))
            items = [(0, g, n, 0) for g, n in grams.items()] + [(1, f, toxic[f], clean[f]) for f in toxic.keys() | clean.keys()]
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array([i[0] for i in items], pa.int32()),
                    "item": pa.array([i[1] for i in items], pa.string()),
                    "toxic": pa.array([i[2] for i in items], pa.int64()),
                    "clean": pa.array([i[3] for i in items], pa.int64()),
                }
            )
        release_memory()

    return (
        sample.mapInArrow(run, "kind int, item string, toxic bigint, clean bigint")
        .groupBy("kind", "item")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _step_sums(seen: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(second derivatives, gradient) of the log-likelihood at ``w``, added up over all rows (toxic, value)."""
    width = len(w)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.hstack([np.ones((batch.num_rows, 1)), np.array(batch.column("value").to_pylist())])
        y = batch.column("toxic").to_numpy(zero_copy_only=False).astype(float)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        sums = np.concatenate([((x * (p * (1 - p) + 1e-9)[:, None]).T @ x).ravel(), x.T @ (y - p)])
        return pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["cell", "value"])

    sums = np.zeros(width * width + width)
    for cell, value in per_batch(seen, work, "cell int, value double").groupBy("cell").agg(F.sum("value")).collect():
        sums[cell] = value
    return sums[: width * width].reshape(width, width), sums[width * width :]


def _logistic(seen: DataFrame, ridge: float = 1e-4) -> list[float]:
    """Newton steps for a ridge logistic regression of ``toxic`` on the five numbers in ``value``, with an intercept."""
    n = seen.count()
    w, penalty = np.zeros(6), np.diag([1e-6] + [ridge] * 5)
    for _ in range(50):
        curvature, gradient = _step_sums(seen, w)
        step = np.linalg.solve(curvature + penalty * n, gradient - penalty @ w * n)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all labelled documents outside the held-out fold."""
    prepare(docs.sparkSession, BATCH_BYTES)
    usable = labels.where((_fold("doc_id") != 0) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = usable.count() <= BROADCAST_ROWS
    sample = stored(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(usable) if few else usable, "doc_id")
        .select("text", (F.col("toxic") == 1).alias("toxic"), (_fold("doc_id") <= 2).alias("first")),
        "toxicity-sample",
    )
    sizes = {r["first"]: (r["toxic"], r["n"] - r["toxic"]) for r in sample.groupBy("first").agg(F.sum(F.col("toxic").cast("int")).alias("toxic"), F.count("*").alias("n")).collect()}
    toxic = sum(t for t, _ in sizes.values())
    clean = sum(c for _, c in sizes.values())
    prior = log((toxic + 1e-9) / (clean + 1e-9)) if toxic + clean else -30.0
    if not toxic or not clean:
        return Model(CharModel(), {}, [max(-30.0, min(30.0, prior)), *[0.0] * 5])
    halves = all(min(sizes.get(h, (0, 0))) >= 5 for h in (True, False))
    t, c = sizes[True] if halves else (toxic, clean)
    counts = stored(_counts(sample.where("first") if halves else sample), "toxicity-counts")
    # As Arrow columns: trigrams and features follow the distinct words of the labelled texts, and none is left out.
    letters = counts.where("kind = 0").select("item", "toxic").toArrow()
    p1, p0 = (F.col("toxic") + 0.5) / (t + 1), (F.col("clean") + 0.5) / (c + 1)
    even = (F.col("toxic") + F.col("clean") + 1) / (t + c + 2)
    z = (p1 - p0) / F.sqrt(even * (1 - even) * (1 / t + 1 / c))
    weights = (
        counts.where((F.col("kind") == 1) & (F.col("toxic") >= min(LEAST_TOXIC_DOCS, max(2, t // 20))))
        .select("item", F.log(p1 / p0).alias("weight"), z.alias("z"))
        .where((F.col("weight") > 1) & (F.col("z") >= min(LEAST_Z, t**0.5)))
        .select("item", "weight")
        .toArrow()
    )
    grams, features = (dict(zip(*(c.to_pylist() for c in learnt.columns))) for learnt in (letters, weights))
    model = Model(CharModel.of(grams), features, [])
    rest = sample.where("not first") if halves else sample
    seen = stored(_with_model(rest, model, lambda s, text: s.evidence(text), "array<double>", ["toxic"]), "toxicity-evidence")
    model.logistic = _logistic(seen)
    return model


def _with_model(docs: DataFrame, model: Model, work, kind: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``value`` = work(scorer, text) for each row; the model is bounded by its parameters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.list_(pa.float64()) if kind.startswith("array") else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            if batch.num_rows:
                values = [work(scorer, t.decode()) for t in utf8(batch.column("__text"))]
                yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in keep} | {"value": pa.array(values, arrow)})
        release_memory()

    fields = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keep)
    return docs.select(*keep, F.col("text").cast("binary").alias("__text")).mapInArrow(run, f"{fields}value {kind}")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id and its score from 0 to 1."""
    prepare(docs.sparkSession, BATCH_BYTES)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _with_model(rows, model, lambda s, text: s.score(text), "double", ["doc_id"]).withColumnRenamed("value", "score")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    prepare(docs.sparkSession, BATCH_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array([scorer.score(v.as_py() or "") < threshold for v in batch.column(place)], pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the contract."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        (_fold("doc_id") == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
