"""Writing feature tables and results; always one file set per write, by the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_features(df: DataFrame, path: str, columns: Sequence[str], form: str = "parquet") -> None:
    """Write a narrow projection of a feature table."""
    narrow = df.select(*dict.fromkeys(columns))
    write_csv(narrow, path) if form == "csv" else write_parquet(narrow, path)


def append_metrics(existing: DataFrame | None, added: DataFrame) -> DataFrame:
    """Rows of both metric tables, with NULL where one lacks a column.

    Write the result to a new path: Spark does not overwrite what it reads.
    """
    return added if existing is None else existing.unionByName(added, allowMissingColumns=True)
