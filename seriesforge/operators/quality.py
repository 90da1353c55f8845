"""Schema, range and completeness checks, and clipping to ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.functions.scalar import clip, out_of_range
from seriesforge.specs import OPTIONAL_COLUMNS, REQUIRED_COLUMNS, TIME


@dataclass(frozen=True)
class SchemaReport:
    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @property
    def valid(self) -> bool:
        return not self.missing


def check_schema(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    optional: Sequence[str] = OPTIONAL_COLUMNS,
) -> SchemaReport:
    """Required columns that are absent, and columns nobody asked for; metadata only."""
    present = set(df.columns)
    return SchemaReport(
        tuple(c for c in required if c not in present),
        tuple(c for c in df.columns if c not in {*required, *optional}),
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def unpivot_row(df: DataFrame, columns: Sequence[str], fields: dict[str, str], label: str = "column") -> DataFrame:
    """Turn one wide aggregate row into one row per column.

    ``fields`` maps an output name to a template of the wide name, e.g. ``{"n": "{}_n"}``.
    """
    entries = F.array(
        *[
            F.struct(F.lit(c).alias(label), *[F.col(t.format(c)).alias(name) for name, t in fields.items()])
            for c in columns
        ]
    )
    kept = [c for c in df.columns if c not in {t.format(x) for t in fields.values() for x in columns}]
    return df.select(*kept, F.inline(entries))


def range_report(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Per column: values outside its range, as a count and a percentage of all rows."""
    columns = [c for c in ranges if c in df.columns]
    counts = [F.count_if(out_of_range(F.col(c), *ranges[c])).alias(f"{c}_n") for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    report = unpivot_row(wide, columns, {"out_of_range": "{}_n"})
    return report.withColumn("percentage", F.try_divide("out_of_range", "total_rows") * 100)


def range_violations(df: DataFrame, ranges: dict[str, tuple[float, float]], keep: Sequence[str] = (TIME,)) -> DataFrame:
    """The offending values: one row per value outside its range, in one scan."""
    columns = [c for c in ranges if c in df.columns]
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    out_of_range(F.col(c), *ranges[c]),
                    F.struct(F.lit(c).alias("column"), F.col(c).alias("value")),
                )
                for c in columns
            ]
        )
    )
    return df.select(*keep, F.inline(found))


def clip_to_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Cap values at their bounds; ranges of absent columns are ignored."""
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in ranges.items() if c in df.columns})


def drop_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Keep rows whose values are in range or missing."""
    for c, (lo, hi) in ranges.items():
        if c in df.columns:
            df = df.filter(F.col(c).between(lo, hi) | F.col(c).isNull())
    return df


def null_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace values outside their range by NULL, for imputation."""
    return df.withColumns(
        {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in ranges.items() if c in df.columns}
    )


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_n") for c in columns])
    return unpivot_row(wide, columns, {"null_count": "{}_n"})


def completeness_report(df: DataFrame, keys: Sequence[str] = (), time: str = TIME, period_days: int = 7) -> DataFrame:
    """Rows, first and last date and completeness per series.

    The expected number of rows is the number of whole periods between the first
    and the last date, so a gapless series of n rows reaches n/(n-1) of it.
    """
    span = F.datediff(F.max(time), F.min(time))
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(time).alias("first_date"),
            F.max(time).alias("last_date"),
            F.floor(span / period_days).alias("expected_rows"),
        )
        .withColumn("completeness", F.try_divide("row_count", "expected_rows") * 100)
    )


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep complete rows.

    One condition per column: the single many-column condition of ``dropna``
    makes the optimizer's constraint sets explode over derived columns.
    """
    complete = F.lit(True)
    for c in columns or df.columns:
        complete = complete & F.col(f"`{c}`").isNotNull()
    return df.filter(complete)
