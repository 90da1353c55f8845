"""Row-based window features of a series; every function adds columns to its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.ordering import with_scalar, with_series_windows
from seriesforge.specs import Derived, FeatureSpec, SeriesSpec


def _frame(window, size: int, exclude_current: bool):
    return window.rowsBetween(-size, -1) if exclude_current else window.rowsBetween(1 - size, 0)


def lag_column(window, d: Derived) -> Column:
    return F.lag(d.source, d.size).over(window)


def average_column(window, d: Derived, partial: bool = False, exclude_current: bool = False) -> Column:
    """Moving average; unless ``partial``, NULL until ``size`` non-NULL values are in the frame."""
    frame = _frame(window, d.size, exclude_current)
    average = F.avg(d.source).over(frame)
    if not partial:
        average = F.when(F.count(d.source).over(frame) == d.size, average)
    return average


def deviation_column(window, d: Derived, exclude_current: bool = False) -> Column:
    """Rolling sample standard deviation over full windows."""
    frame = _frame(window, d.size, exclude_current)
    return F.when(F.count(d.source).over(frame) == d.size, F.stddev_samp(d.source).over(frame))


def window_features(
    df: DataFrame,
    spec: SeriesSpec,
    lags: Sequence[Derived] = (),
    averages: Sequence[Derived] = (),
    deviations: Sequence[Derived] = (),
    partial: bool = False,
    exclude_current: bool = False,
) -> DataFrame:
    """Lags, moving averages and rolling deviations in one pass over the series.

    ``exclude_current=True`` shifts the frames back by one row, so that a feature
    of the target does not contain the value to be predicted.
    """
    wanted = FeatureSpec(tuple(lags), tuple(averages), tuple(deviations))

    def build(window) -> dict[str, Column]:
        columns = {d.name: lag_column(window, d) for d in lags}
        columns |= {d.name: average_column(window, d, partial, exclude_current) for d in averages}
        return columns | {d.name: deviation_column(window, d, exclude_current) for d in deviations}

    return with_series_windows(df, spec, wanted.horizon + int(exclude_current), build)


def difference(df: DataFrame, spec: SeriesSpec, column: str, order: int = 1) -> DataFrame:
    """Add ``<column>_diff_<order>``: the ``order``-th difference of consecutive rows.

    Expanded binomially over lags, so any order needs one window.
    """
    name = f"{column}_diff_{order}"

    def build(window) -> dict[str, Column]:
        terms, weight = [], 1
        for k in range(order + 1):
            terms.append(F.lit(float(weight)) * (F.lag(column, k).over(window) if k else F.col(column)))
            weight = -weight * (order - k) // (k + 1)
        return {name: sum(terms[1:], terms[0])}

    return with_series_windows(df, spec, order, build)


def with_series_mean(df: DataFrame, spec: SeriesSpec, column: str, name: str) -> DataFrame:
    """Add the mean of a column over its series, or over all rows where there are no keys.

    Bounded series share the shuffle of their windows; unbounded ones are
    averaged with partial aggregation and joined back.
    """
    if not spec.keys:
        return with_scalar(df, df.agg(F.avg(column)), name)
    if spec.regular:
        return df.withColumn(name, F.avg(column).over(Window.partitionBy(*spec.keys)))
    return df.join(df.groupBy(*spec.keys).agg(F.avg(column).alias(name)), list(spec.keys))


def autocorrelation(df: DataFrame, spec: SeriesSpec, column: str, max_lag: int) -> DataFrame:
    """ACF per series: one row per (keys, lag) with ``acf``; the usual biased estimator.

    Means are per series; the lagged products are summed in one aggregate.
    """
    keys = list(spec.keys)
    base = df.select(*keys, *spec.order, column)
    centred = with_series_mean(base, spec, column, "_mean").withColumn("_c", F.col(column) - F.col("_mean"))
    lagged = with_series_windows(
        centred, spec, max_lag, lambda w: {f"_c{k}": F.lag("_c", k).over(w) for k in range(1, max_lag + 1)}
    )
    products = [F.sum(F.col("_c") * F.col(f"_c{k}")).alias(f"_g{k}") for k in range(1, max_lag + 1)]
    sums = lagged.groupBy(*keys).agg(F.sum(F.col("_c") * F.col("_c")).alias("_g0"), *products)
    entries = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.try_divide(f"_g{k}", "_g0").alias("acf")) for k in range(1, max_lag + 1)]
    )
    return sums.select(*keys, F.inline(entries))


def partial_autocorrelation(df: DataFrame, spec: SeriesSpec, column: str, max_lag: int) -> DataFrame:
    """PACF per series by the Durbin-Levinson recursion over the ACF of each series.

    The recursion is unrolled into column arithmetic: ``max_lag`` is small.
    """
    keys = list(spec.keys)
    acf = autocorrelation(df, spec, column, max_lag)
    wide = acf.groupBy(*keys).agg(
        *[F.max(F.when(F.col("lag") == k, F.col("acf"))).alias(f"_r{k}") for k in range(1, max_lag + 1)]
    )
    wide = wide.withColumn("_p1_1", F.col("_r1"))
    for k in range(2, max_lag + 1):
        top = F.col(f"_r{k}") - sum(F.col(f"_p{k-1}_{j}") * F.col(f"_r{k-j}") for j in range(1, k))
        bottom = F.lit(1.0) - sum(F.col(f"_p{k-1}_{j}") * F.col(f"_r{j}") for j in range(1, k))
        wide = wide.withColumn(f"_p{k}_{k}", F.try_divide(top, bottom))
        rest = {
            f"_p{k}_{j}": F.col(f"_p{k-1}_{j}") - F.col(f"_p{k}_{k}") * F.col(f"_p{k-1}_{k-j}") for j in range(1, k)
        }
        wide = wide.withColumns(rest)
    entries = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.col(f"_p{k}_{k}").alias("pacf")) for k in range(1, max_lag + 1)]
    )
    return wide.select(*keys, F.inline(entries))
