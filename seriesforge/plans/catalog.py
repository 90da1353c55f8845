"""Registry of the runnable queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.session import ship_package

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, digits: int = 6):
    """Register a function under its name; doubles are rounded so that both sides compare equal."""

    def register(fn: Run) -> Run:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return rounded(fn(spark, folder), digits)

        REGISTRY[fn.__name__] = Query(fn.__name__, run, sql)
        return fn

    return register


def nudge(digits: int) -> float:
    """Added before rounding: a mean that ends in an exact 5 after the last kept digit then
    rounds the same way whatever the order its terms were summed in."""
    return 10.0 ** -(digits + 4)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name) + F.lit(nudge(digits)), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dbl(expression: str, alias: str, digits: int = 6) -> str:
    """SQL for a rounded double column; adding zero turns -0.0 into 0.0."""
    return f'round(CAST({expression} AS DOUBLE) + 1e-{digits + 4}, {digits}) + 0.0 AS "{alias}"'


def dbls(*columns: str, digits: int = 6) -> str:
    return ", ".join(dbl(f'"{c}"', c, digits) for c in columns)
