"""WARC archives of pages, and the merged index of their captures.

Pages are written as WARC/1.1 records by Spark's text writer (a record is one value, the blank lines between records
are the line separator), so files go through the commit protocol of the shared file system. Archives are read back as
binary files and cut by Content-Length; every archive gives one capture run, sorted by URL key, timestamp and page.
Runs are cut at common borders, so that each slice of the key space receives one sorted piece of each run, and a
loser tree merges the pieces of a slice. Slices follow each other, so slice and position order all captures.

Of captures with equal payloads of at least ``least_bytes`` the one with the smallest page_id is the response and the
others are revisits of it; that minimum is taken per digest before it meets the captures.

Defined results: a NULL html is an empty payload, a NULL url the empty key; repeated rows are captures of their own and
the repeats of one page_id are all responses or all revisits; pages without a page_id are never referred to; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.llm.common import per_batch, prepare, stored
from seriesforge.session import scratch_path

#: Wanted size of an archive, and the most one may hold whatever its pages' sizes are.
ARCHIVE_BYTES = 16 << 20
ARCHIVE_LIMIT = 128 << 20
#: Captures per slice of the merged index, and sampled captures per slice that place its borders.
SLICE_ROWS = 50_000
BORDER_SAMPLE = 20
#: Most slices; a larger index has larger slices.
MAX_SLICES = 20_000
_END = "\r\n\r\n"


def write_archives(pages: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One response record per row of ``pages`` (page_id, url, html), uncompressed, in files below ``path``.

    The number of records per file follows the mean payload, and is low enough that no file passes
    ``ARCHIVE_LIMIT`` even if all its payloads are as long as the longest.
    """
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload) + 600 + F.coalesce(F.octet_length("url"), F.lit(0))
    mean, longest = pages.agg(F.avg(size), F.max(size)).first()
    records = max(1, int(min(archive_bytes / (mean or 1), ARCHIVE_LIMIT / (longest or 1))))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    # Pages carry no time: a capture's second is derived from its page.
    date = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(_END),
    )
    one_line = F.translate(F.coalesce("url", F.lit("")), "\r\n", "")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        page,
        F.lit(">\r\nWARC-Date: "),
        date,
        F.lit("\r\nWARC-Target-URI: "),
        one_line,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(head) + F.octet_length(payload)).cast("string"),
        F.lit(_END),
        head,
        payload,
    )
    pages.select(record.alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", records).text(path)


def url_key(url: str) -> str:
    """Host labels reversed, without ``www``, then port, path and query in lower case; no fragment."""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    labels = [x for x in host.split(".") if x]
    if len(labels) > 1 and re.fullmatch(r"www\d*", labels[0]):
        labels = labels[1:]
    shown = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(labels))}{shown}){parts.path or '/'}{query}".lower()


def records_of(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an archive."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        lines = content[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        end = head + 4 + int(headers["content-length"])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield at, end + 4 - at, headers, content[head + 4 : end]
        at = end + 4


CAPTURE = "urlkey string, ts string, page_id bigint, payload_bytes bigint, payload_digest string, offset bigint, length bigint"


def capture_runs(spark, path: str) -> DataFrame:
    """One row per archive: its file and its captures as arrays, sorted by (urlkey, ts, page_id)."""
    names = [f.split()[0] for f in CAPTURE.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = []
        for content in batch.column(1):
            captures = []
            for offset, length, headers, block in records_of(content.as_py()):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                page = headers["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
                ts = re.sub(r"\D", "", headers["warc-date"])
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                captures.append((url_key(headers["warc-target-uri"]), ts, int(page) if page else None, len(payload), digest, offset, length))
            captures.sort(key=_order)
            runs.append([dict(zip(names, c)) for c in captures])
        kind = pa.list_(pa.struct([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in CAPTURE.split(", ")]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind)], names=["file", "captures"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return per_batch(files, work, f"file string, captures array<struct<{CAPTURE}>>")


def _order(capture) -> tuple:
    """Sort key of a capture, by position or by name; a missing page comes first."""
    key, ts, page = (capture["urlkey"], capture["ts"], capture["page_id"]) if isinstance(capture, dict) else capture[:3]
    return key, ts, page is not None, page or 0


class LoserTree:
    """Merge sorted sequences. Inner nodes hold the loser of their match, so the next winner needs one match per level."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        size = 1
        while size < max(1, len(runs)):
            size *= 2
        self.size, self.losers = size, [None] * size
        self.heads = [self._head(r) if r < len(runs) else None for r in range(size)]
        winners = list(range(size))
        first = size
        while first > 1:
            first //= 2
            played = []
            for node in range(first):
                a, b = winners[2 * node], winners[2 * node + 1]
                win, lose = (a, b) if self._beats(a, b) else (b, a)
                self.losers[first + node] = lose
                played.append(win)
            winners = played
        self.winner = winners[0]

    def _head(self, run: int):
        return self.key(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None

    def _beats(self, a: int, b: int) -> bool:
        """An exhausted run loses; equal heads go to the run of smaller number."""
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None else (x, a) < (y, b)

    def __iter__(self) -> Iterator:
        while self.heads[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            node, win = (self.size + run) // 2, run
            while node >= 1:
                if self._beats(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2
            self.winner = win


def borders(runs: DataFrame, slice_rows: int = SLICE_ROWS) -> list[tuple]:
    """Sort keys that cut all captures into slices of about ``slice_rows``.

    They come from about ``BORDER_SAMPLE`` captures per slice, drawn by hash of the capture, so the driver sees at
    most some ``BORDER_SAMPLE * MAX_SLICES`` keys; they balance the slices and never change the result. Keys include timestamp and page, so
    a URL captured very often is cut as well.
    """
    captures = runs.select(F.explode("captures").alias("c")).select("c.urlkey", "c.ts", "c.page_id", "c.offset")
    n = captures.count()
    slices = min(-(-n // slice_rows), MAX_SLICES)
    if slices < 2:
        return []
    kept = F.pmod(F.xxhash64("urlkey", "ts", "page_id", "offset"), F.lit(10**6)) < int(10**6 * BORDER_SAMPLE * slices / n) + 1
    sample = sorted(_order((r["urlkey"], r["ts"], r["page_id"])) for r in captures.where(kept).collect())
    return [sample[i * len(sample) // slices] for i in range(1, slices)] if sample else []


def merged_index(runs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All captures in global order: slice, position (from 0 in each slice), file and the capture's columns."""
    prepare(runs.sparkSession)
    cuts = runs.sparkSession.sparkContext.broadcast(borders(runs, slice_rows))
    piece = T._parse_datatype_string(f"slice int, file string, captures array<struct<{CAPTURE}>>")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        slices, files, pieces = [], [], []
        for file, captures in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            begin = 0
            for number in range(len(cuts.value) + 1):
                end = len(captures)
                if number < len(cuts.value):
                    low, end = begin, len(captures)
                    while low < end:
                        mid = (low + end) // 2
                        low, end = (mid + 1, end) if _order(captures[mid]) < cuts.value[number] else (low, mid)
                    end = low
                if end > begin:
                    slices.append(number)
                    files.append(file)
                    pieces.append(captures[begin:end])
                begin = end
        kind = batch.schema.field("captures").type
        return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(files), pa.array(pieces, kind)], names=piece.names)

    def merge(key, table):
        files = table.column("file").to_pylist()
        tree = LoserTree(
            [[c | {"file": file} for c in run] for file, run in zip(files, table.column("captures").to_pylist())], _order
        )
        rows = list(tree)
        columns = {"slice": pa.array([key[0].as_py()] * len(rows), pa.int32()), "position": pa.array(range(len(rows)), pa.int64())}
        for name in ("file", *(f.split()[0] for f in CAPTURE.split(", "))):
            text = name in ("file", "urlkey", "ts", "payload_digest")
            columns[name] = pa.array([r[name] for r in rows], pa.string() if text else pa.int64())
        return pa.table(columns)

    pieces = per_batch(runs, cut, piece)
    return pieces.groupBy("slice").applyInArrow(merge, f"slice int, position bigint, file string, {CAPTURE}")


def with_record_types(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The index with record_type and refers_to."""
    long_enough = F.col("payload_bytes") >= least_bytes
    first = index.where(long_enough).groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("first_page"))
    joined = index.join(first, ["payload_digest", "payload_bytes"], "left")
    revisit = long_enough & (F.col("page_id") != F.col("first_page"))
    return joined.select(
        *index.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


def archive_and_index(pages: DataFrame, *, least_bytes: int = 0, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and index them."""
    spark = pages.sparkSession
    prepare(spark)
    path = scratch_path(spark, "warc")
    write_archives(pages.select("page_id", "url", "html"), path)
    runs = stored(capture_runs(spark, path), "capture-runs")
    return with_record_types(merged_index(runs, slice_rows), least_bytes)


def digest(index: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
