"""Reading raw tables and saved results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.functions.scalar import nan_to_null
from seriesforge.operators.quality import SchemaReport, check_schema, completeness_report, range_report
from seriesforge.operators.setops import merge_sources
from seriesforge.specs import TIME, VALID_RANGES, WEATHER_SCHEMA


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with NaN as NULL; a missing path raises Spark's own PATH_NOT_FOUND."""
    return normalise_nan(spark.read.parquet(f"{folder}/{name}.parquet"))


def normalise_nan(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floating})


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = WEATHER_SCHEMA,
    strict_dates: bool = True,
) -> DataFrame:
    """Read CSV with a header by column name, parsing to the declared types.

    Columns are read as text and cast, so that a file may order its columns
    freely and carry extra ones.  ``strict_dates=False`` turns malformed dates
    into NULL instead of failing.
    """
    raw = spark.read.option("header", True).csv(path)
    types = {f.name: f.dataType for f in schema.fields}

    def parsed(name: str):
        kind = types.get(name)
        if kind is None:
            return F.col(name)
        if isinstance(kind, T.DateType) and not strict_dates:
            return F.col(name).try_cast(kind).alias(name)
        return F.col(name).cast(kind).alias(name)

    return normalise_nan(raw.select(*[parsed(c) for c in raw.columns]))


def with_year(df: DataFrame, time: str = TIME) -> DataFrame:
    """Derive ``Year`` where the source has none."""
    return df if "Year" in df.columns else df.withColumn("Year", F.year(time))


@dataclass
class LoadedTable:
    """A lazy table with its schema check (metadata) and range report (lazy aggregate)."""

    rows: DataFrame
    schema_report: SchemaReport
    ranges: DataFrame


def load_with_checks(spark: SparkSession, path: str, strict: bool = True) -> LoadedTable:
    """Read one CSV, check its columns, derive the year and report out-of-range values.

    Missing required columns raise when ``strict``; range problems never do.
    """
    rows = read_csv(spark, path)
    report = check_schema(rows)
    if strict and report.missing:
        raise ValueError(f"missing required columns: {report.missing}")
    rows = with_year(rows)
    return LoadedTable(rows, report, range_report(rows, VALID_RANGES))


@dataclass
class LoadedSeries:
    rows: DataFrame
    completeness: DataFrame


def load_and_merge(spark: SparkSession, paths: Sequence[str], keys: Sequence[str] = ()) -> LoadedSeries:
    """Load several files with checks, merge them without duplicate rows, and report on the result."""
    tables = [load_with_checks(spark, p).rows for p in paths]
    merged = merge_sources(tables)
    return LoadedSeries(merged, completeness_report(merged, keys))


def read_results(spark: SparkSession, path: str, schema: str, form: str = "csv") -> DataFrame:
    """Read a saved metric table (``csv``, ``parquet``) or test list (``json``) back with its types."""
    reader = spark.read.schema(schema)
    if form == "csv":
        return reader.option("header", True).csv(path)
    if form == "json":
        return reader.json(path)
    return normalise_nan(spark.read.parquet(path))
