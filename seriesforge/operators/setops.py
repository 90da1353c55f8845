"""Union, merge, overlap and difference of sources with the same columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_rows(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows; a column missing from one table is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merge_sources(tables: Sequence[DataFrame]) -> DataFrame:
    """Union without repeated rows.

    Equal rows collapse map-side, so a row copied any number of times costs
    nothing in the shuffle.  Order the result at the sink, not here.
    """
    return union_rows(tables).dropDuplicates()


def merge_by_priority(tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """One row per ``on``: from the first table that has it.

    Within one table the smallest row wins, which makes the choice repeatable.
    An aggregate instead of a ranking window: copies are reduced before the shuffle.
    """
    tagged = union_rows([t.withColumn("_priority", F.lit(i)) for i, t in enumerate(tables)])
    values = [c for c in tagged.columns if c not in (*on, "_priority")]
    chosen = F.min(F.struct("_priority", *values)).alias("_chosen")
    return tagged.groupBy(*on).agg(chosen).select(*on, *[F.col(f"_chosen.{c}").alias(c) for c in values])


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows have an exact copy, counting every copy."""
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_rows"))


def time_overlap(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct ``on`` values present in both."""
    return first.select(*on).intersect(second.select(*on))


def rows_only_in(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of ``first`` without a counterpart in ``second``, counting copies."""
    return first.exceptAll(second.select(*first.columns))
