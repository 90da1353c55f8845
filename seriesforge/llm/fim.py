"""Fill-in-the-middle: documents rearranged so that a model learns to write what stands between two given parts.

A text is cut into units (``UNIT``: a run of ASCII letters, or any other code point). One ``fullmatch`` of ``(unit)*``
keeps every repetition of its group, and ``match.ends(1)`` is the list of unit ends: its length is n, and the two cut
offsets are looked up in it. Repetitions are possessive, so nothing is kept for backtracking.

Which texts are rearranged, where they are cut and in which order their parts stand follows from a hash of ``doc_id``
alone, so a rerun or another partitioning gives the same rows.

Defined results: NULL and empty texts, texts that hold one of the three marks, and the share drawn by ``plain_percent``
stay plain (their text as it is); a NULL doc_id hashes like the text ``null``; repeated rows are rearranged alike; a
text without letters has as many units as code points; an empty table gives no rows; further columns pass through, and
those named like a result are replaced. Texts beyond ``PIECE`` code points are matched in pieces that end behind
something other than a letter, where no unit can be cut, so a long text costs its unit ends and not its match objects.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import prepare

UNIT = r"[A-Za-z]++|[^A-Za-z]"
PIECE = 1 << 20
_UNITS = regex.compile(rf"({UNIT})*+")
_NOT_LETTER = regex.compile(r"[^A-Za-z]")
_RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        for mark in marks:
            # A mark that starts and ends like no other part can't arise where a text and a mark meet.
            if len(mark) < 2 or any(mark[:i] == other[-i:] for other in marks for i in range(1, min(len(mark), len(other)))):
                raise ValueError(f"marks must not overlap each other: {marks}")
        if any(a in b for a in marks for b in marks if a is not b) or len(set(marks)) < 3:
            raise ValueError(f"marks must not hold each other: {marks}")


def unit_ends(text: str) -> np.ndarray:
    """End offset of every unit, in code points."""
    ends, at = [], 0
    while at < len(text):
        stop = len(text)
        if stop - at > PIECE:
            found = _NOT_LETTER.search(text, at + PIECE - 1)
            stop = found.end() if found else stop
        ends.append(np.array(_UNITS.fullmatch(text, at, stop).ends(1), np.int64))
        at = stop
    return np.concatenate(ends) if ends else np.zeros(0, np.int64)


def draws(doc: str) -> tuple[int, int, int, int]:
    """Four numbers from the hash of a document's id."""
    digest = sha256(b"1:" + doc.encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def rearranged(text: str, doc: str, marks: Marks, plain_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    h1, h2, h3, h4 = draws(doc)
    ends = unit_ends(text)
    n = len(ends)
    if not text or h3 % 100 >= 100 - plain_percent or any(m in text for m in (marks.prefix, marks.suffix, marks.middle)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{marks.suffix}{suffix}{marks.prefix}{prefix}{marks.middle}{middle}"
    return n, "psm", a, b - a, f"{marks.prefix}{prefix}{marks.suffix}{suffix}{marks.middle}{middle}"


def transform(docs: DataFrame, *, marks: Marks = Marks(), plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``docs`` with n, form (plain, psm, spm), prefix_chars, middle_chars and output beside its columns."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c not in _RESULTS]
    inputs = docs.select(*kept, F.col("doc_id").cast("string").alias("__doc"), F.col("text").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                rearranged((t.as_py() or b"").decode("utf-8", "surrogateescape"), d.as_py() or "null", marks, plain_percent, spm_percent)
                for d, t in zip(batch.column("__doc"), batch.column("__text"))
            ]
            if rows:
                n, form, prefix, middle, output = zip(*rows)
                made = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                made.append(pa.array([o.encode("utf-8", "surrogateescape") for o in output], pa.binary()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *_RESULTS])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    out = inputs.mapInArrow(run, schema + "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(rows: DataFrame, *, marks: Marks = Marks(), name: str = "restored") -> DataFrame:
    """Add the text that ``form`` and ``output`` came from.

    No text that is rearranged holds a mark, and no mark can arise at a seam, so the first occurrence is the mark.
    """

    def parts(first: str, second: str):
        """Between the first two marks, between the second and the last, and after it."""
        rest = F.expr(f"substr(output, {len(first) + 1})")
        head = F.substring_index(rest, second, 1)
        tail = F.substr(rest, F.length(head) + F.lit(len(second) + 1))
        body = F.substring_index(tail, marks.middle, 1)
        return head, body, F.substr(tail, F.length(body) + F.lit(len(marks.middle) + 1))

    prefix, suffix, middle = parts(marks.prefix, marks.suffix)
    text = F.when(F.col("form") == "psm", F.concat(prefix, middle, suffix))
    suffix, prefix, middle = parts(marks.suffix, marks.prefix)
    text = text.when(F.col("form") == "spm", F.concat(prefix, middle, suffix)).otherwise(F.col("output"))
    return rows.withColumn(name, text)


def digest(rows: DataFrame) -> DataFrame:
    """The columns of the contract."""
    back = restore(rows)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return back.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha("output").alias("output_sha256"),
        sha("restored").alias("restored_sha256"),
    )
