"""A sink whose files follow each other in the order of the rows, with a manifest of what each file holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write_ordered(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` as parquet files of about ``rows_per_file`` rows, ordered inside and among each other.

    Rows are dealt to files by ranges of ``order`` that Spark draws from a sample, and ordered within
    them, so no task orders more than its file.  ``order`` should identify rows: equal
    rows share a file.  The manifest (file, position, first, last, rows) is written beside the files.
    """
    order = list(order)
    files = max(1, -(-df.count() // rows_per_file))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")
    written = df.sparkSession.read.parquet(f"{path}/rows")
    key = F.struct(*order)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    held = written.groupBy(name.alias("file")).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows"))
    # One row per file.
    ranked = held.orderBy("first", "file").coalesce(1).select("*", F.monotonically_increasing_id().alias("position"))
    ranked.select("position", "file", "first", "last", "rows").write.mode("overwrite").parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(position, file, first, last, rows), a row per file."""
    return spark.read.parquet(f"{path}/manifest")


def read_range(spark: SparkSession, path: str, low: Sequence | None = None, high: Sequence | None = None) -> DataFrame:
    """Rows whose leading order columns lie within ``low`` and ``high``, both included; files outside are not opened."""
    manifest = read_manifest(spark, path)
    names = manifest.schema["first"].dataType.names
    keep = F.lit(True)

    def bound(values):
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values)])

    def lead(column: str, values):
        return F.struct(*[F.col(f"{column}.{n}").alias(n) for n in names[: len(values)]])

    if low is not None:
        keep = keep & (lead("last", low) >= bound(low))
    if high is not None:
        keep = keep & (lead("first", high) <= bound(high))
    files = [f"{path}/rows/{r['file']}" for r in manifest.filter(keep).orderBy("position").select("file").collect()]
    if not files:
        return spark.read.parquet(f"{path}/rows").limit(0)
    rows = spark.read.parquet(*files)
    if low is not None:
        rows = rows.filter(F.struct(*names[: len(low)]) >= bound(low))
    if high is not None:
        rows = rows.filter(F.struct(*names[: len(high)]) <= bound(high))
    return rows
