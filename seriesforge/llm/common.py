"""What the corpus operators share: bounded Arrow batches, row access, intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from seriesforge.session import scratch_path, ship_package

BATCH_ROWS = 2000
BATCH_BYTES = "8m"


def prepare(spark: SparkSession, batch_bytes: str = BATCH_BYTES) -> None:
    """Ship the package to the workers and bound what one Arrow batch may hold.

    A batch ends at ``BATCH_ROWS`` rows or ``batch_bytes``, whichever comes first, so that a worker's
    memory follows the longest text and not the number of rows.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs that run inside, restored afterwards; ``__`` stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release_memory() -> None:
    """Give back what a worker's task no longer holds: workers serve later steps as well."""
    pa.default_memory_pool().release_unused()


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Map each Arrow batch of ``df`` to at most one batch of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if out is not None and out.num_rows:
                    yield out
        release_memory()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The texts of a column as UTF-8 bytes; NULL is empty."""
    for value in column.cast(pa.large_binary()) if column.type != pa.large_binary() else column:
        yield value.as_py() or b""


def stored(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Later steps read files that outlive an executor, and no step is computed twice. ``group_bytes`` bounds what a task
    holds of a table with long values before it writes them.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
