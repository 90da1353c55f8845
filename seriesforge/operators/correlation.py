"""Pearson correlations from summed moments, and ranking of features by them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.operators.quality import numeric_columns
from seriesforge.specs import ESSENTIAL_FEATURES, TARGET


def pearson(x: str, y: str) -> Column:
    """Aggregate over the rows where both columns are present; NULL for a constant column."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    both = cx.isNotNull() & cy.isNotNull()
    spread = F.stddev_pop(F.when(both, cx)) * F.stddev_pop(F.when(both, cy))
    return F.try_divide(F.covar_pop(cx, cy), spread)


def target_correlations(df: DataFrame, target: str = TARGET, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, correlation, strength) of every numeric column with the target; one aggregate."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    found = _pearsons(df, [(c, target) for c in columns])
    return found.select(F.col("first").alias("feature"), "correlation", F.abs("correlation").alias("strength"))


def _pearsons(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(first, second, correlation) of each pair of columns.

    A row becomes one row per pair, so that the aggregate's code stays the same small loop
    for any number of pairs; partial sums leave a task with one row per pair.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for i, (a, b) in enumerate(pairs)])
    sums = df.select(F.inline(cells)).groupBy("pair").agg(pearson("x", "y").alias("correlation"))
    names = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("first"), F.lit(b).alias("second")) for i, (a, b) in enumerate(pairs)])
    listed = df.sparkSession.range(1).select(F.inline(names))
    return listed.join(sums, "pair", "left").select("first", "second", "correlation")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle in long form: (first, second, correlation) per pair of columns."""
    return _pearsons(df, list(combinations(columns, 2)))


def lag_effectiveness(df: DataFrame, base: str = TARGET, target: str = TARGET) -> DataFrame:
    """Correlation of the lags of one column with the target."""
    return target_correlations(df, target, [c for c in df.columns if c.startswith(f"{base}_lag_")])


def top_features(df: DataFrame, target: str = TARGET, top_n: int = 15, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``top_n`` most correlated features, strongest first; a report of a few rows."""
    ranked = target_correlations(df, target, columns)
    return ranked.orderBy(F.col("strength").desc_nulls_last(), "feature").limit(top_n)


def select_features(
    df: DataFrame,
    target: str = TARGET,
    top_n: int = 15,
    essentials: Sequence[str] = ESSENTIAL_FEATURES,
    columns: Sequence[str] | None = None,
) -> list[str]:
    """Names of the chosen features, with the essential ones always among them.

    The one action here returns ``top_n`` names.
    """
    chosen = [row["feature"] for row in top_features(df, target, top_n, columns).collect()]
    return chosen + [c for c in essentials if c in df.columns and c not in chosen and c != target]
