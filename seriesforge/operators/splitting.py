"""Chronological splits and folds."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.ordering import row_index
from seriesforge.specs import SeriesSpec


def with_series_length(df: DataFrame, spec: SeriesSpec, name: str = "series_length") -> DataFrame:
    if not spec.keys:
        return df.withColumn(name, df.agg(F.count(F.lit(1))).scalar())
    if spec.regular:
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*spec.keys)))
    lengths = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(lengths, list(spec.keys))


def positioned(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``row_index`` (from 0) and ``series_length``."""
    return with_series_length(row_index(df, spec), spec)


def chronological_split(df: DataFrame, spec: SeriesSpec, test_size: float = 0.2) -> DataFrame:
    """Add ``is_train``: the first ``int(n * (1 - test_size))`` rows of each series."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    cut = F.floor(F.col("series_length") * F.lit(1 - test_size))
    return positioned(df, spec).withColumn("is_train", F.col("row_index") < cut).drop("row_index", "series_length")


def validation_split(df: DataFrame, spec: SeriesSpec, test_size: float = 0.2, validation_size: float = 0.2) -> DataFrame:
    """Add ``part``: the last rows of each series are ``test``, the last of those before them ``validation``.

    Both cuts round as ``chronological_split`` does, so ``test`` is the same part there and here.
    """
    if not 0 < test_size < 1 or not 0 < validation_size < 1:
        raise ValueError("test_size and validation_size must lie between 0 and 1")
    rest = F.floor(F.col("series_length") * F.lit(1 - test_size))
    train = F.floor(rest * F.lit(1 - validation_size))
    part = F.when(F.col("row_index") < train, "train").when(F.col("row_index") < rest, "validation").otherwise("test")
    return positioned(df, spec).withColumn("part", part).drop("row_index", "series_length")


def split_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("is_train")).alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows")
    )


def require_both_parts(df: DataFrame) -> None:
    """Raise where a split left nothing to train on or nothing to test."""
    counts = split_counts(df).first()
    if not counts["train_rows"] or not counts["test_rows"]:
        raise ValueError(
            f"not enough rows to split: {counts['train_rows']} for training, {counts['test_rows']} for testing"
        )


def yearly_split(df: DataFrame, spec: SeriesSpec, test_size: float = 0.2) -> DataFrame:
    """The chronological split within each calendar year of each series."""
    yearly = replace(spec, keys=(*spec.keys, "_year"))
    return chronological_split(df.withColumn("_year", F.year(spec.time)), yearly, test_size).drop("_year")


def contiguous_folds(df: DataFrame, spec: SeriesSpec, k: int, name: str = "fold") -> DataFrame:
    """Add the fold number 0..k-1: unshuffled blocks, the first n % k one row longer."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    size, longer = F.expr(f"series_length div {k}"), F.col("series_length") % k
    boundary = longer * (size + 1)
    index = F.col("row_index")
    fold = F.when(index < boundary, F.floor(F.try_divide(index, size + 1))).otherwise(
        longer + F.floor(F.try_divide(index - boundary, size))
    )
    return positioned(df, spec).withColumn(name, fold.cast("int")).drop("row_index", "series_length")


def expanding_folds(df: DataFrame, spec: SeriesSpec, k: int, name: str = "test_fold") -> DataFrame:
    """Add the fold whose test block holds the row, -1 for rows only ever trained on.

    Test blocks have n div (k+1) rows and end with the series; fold i trains on
    every row with a fold number below i.
    """
    size = F.expr(f"series_length div {k + 1}")
    start = F.col("series_length") - size * k
    fold = F.when(F.col("row_index") < start, F.lit(-1)).otherwise(
        F.floor(F.try_divide(F.col("row_index") - start, size))
    )
    return positioned(df, spec).withColumn(name, fold.cast("int")).drop("row_index", "series_length")


def expanding_pairs(folded: DataFrame, k: int, name: str = "test_fold"):
    """The (train, test) frames of each expanding fold."""
    for i in range(k):
        yield folded.filter(F.col(name) < i).drop(name), folded.filter(F.col(name) == i).drop(name)


def last_rows(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """The last ``n`` rows of each series."""
    tail = positioned(df, spec).filter(F.col("row_index") >= F.col("series_length") - n)
    return tail.drop("row_index", "series_length")


def train_rows(n: int, test_size: float) -> int:
    return math.floor(n * (1 - test_size))
