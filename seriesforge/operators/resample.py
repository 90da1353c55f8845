"""Calendar resampling and grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.specs import TIME


def week_ending_sunday(time: Column) -> Column:
    """The Sunday that closes the Monday-to-Sunday week of a date."""
    day = time.cast("date")
    return F.date_add(day, 6 - F.weekday(day))


def resample_weekly(df: DataFrame, keys: Sequence[str], time: str, measures: Sequence[Column]) -> DataFrame:
    """One row per series and week; partial sums form before the shuffle."""
    week = week_ending_sunday(F.col(time)).alias(TIME)
    return df.groupBy(*keys, week).agg(*measures)


def resample_period(df: DataFrame, keys: Sequence[str], time: str, unit: str, measures: Sequence[Column]) -> DataFrame:
    """One row per series and calendar unit (``hour``, ``day``, ``month`` ...)."""
    return df.groupBy(*keys, F.date_trunc(unit, F.col(time).cast("timestamp")).alias("period")).agg(*measures)


def weather_measures(temperature: Column, humidity: Column, wind: Column, rain: Column) -> list[Column]:
    """Weekly form of the four measures: means, and the total of the rain."""
    return [
        F.avg(temperature).alias("Temp_avg"),
        F.avg(humidity).alias("Relative_Humidity"),
        F.avg(wind).alias("Wind_kmh"),
        F.sum(rain).alias("Precipitation_mm"),
    ]


def month_means(df: DataFrame, column: str, time: str = TIME, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, F.month(time).alias("Month")).agg(F.avg(column).alias(f"mean_{column}"))


def flag_means(df: DataFrame, flag: Column, name: str, column: str) -> DataFrame:
    return df.groupBy(flag.alias(name)).agg(F.avg(column).alias(f"mean_{column}"))


def yearly_totals(df: DataFrame, column: str, keys: Sequence[str] = (), time: str = TIME) -> DataFrame:
    return df.groupBy(*keys, F.year(time).alias("Year")).agg(
        F.sum(column).alias(f"total_{column}"), F.avg(column).alias(f"mean_{column}")
    )


def yearly_monthly_rollup(df: DataFrame, column: str, time: str = TIME) -> DataFrame:
    """Totals per month, per year and overall."""
    base = df.select(F.year(time).alias("Year"), F.month(time).alias("Month"), column)
    return base.rollup("Year", "Month").agg(F.sum(column).alias(f"total_{column}"))


def calendar(df: DataFrame, keys: Sequence[str], time: str = TIME, step: str = "7 days") -> DataFrame:
    """Every period between the first and last date of each series, present or not."""
    spans = df.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    return spans.select(*keys, F.explode(F.sequence("_first", "_last", F.expr(f"interval {step}"))).alias(time))
