"""Outliers by the interquartile rule."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.operators.ordering import count_groups, join_group_table, with_scalar
from seriesforge.operators.quality import unpivot_row
from seriesforge.operators.statistics import percentiles
from seriesforge.session import store

MILD_REACH = 1.5
EXTREME_REACH = 3.0


def _fences(quartiles: Column) -> dict[str, Column]:
    """Bounds from the array [q1, q3]: mild outliers lie beyond low and high, extreme ones beyond the far bounds."""
    q1, q3 = quartiles[0], quartiles[1]
    out = {}
    for prefix, reach in (("", MILD_REACH), ("far_", EXTREME_REACH)):
        out[f"{prefix}low"], out[f"{prefix}high"] = q1 - (q3 - q1) * reach, q3 + (q3 - q1) * reach
    return out


def _with_fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``_fences``: a struct with the bounds of each column.  ``df`` is evaluated once."""
    df = store(df, "outliers")
    quartiles = percentiles(df, [], columns, (0.25, 0.75), stored=True)
    row = F.struct(*[f.alias(name) for name, f in _fences(F.col("q")).items()])
    fields = [F.max(F.when(F.col("column") == c, row)).alias(c) for c in columns]
    return with_scalar(df, quartiles.agg(F.struct(*fields)), "_fences")


def _flag(value: Column, fence: Callable[[str], Column]) -> Column:
    beyond = lambda far: (value < fence(f"{far}low")) | (value > fence(f"{far}high"))
    return F.when(beyond("far_"), "extreme").when(beyond(""), "mild").when(value.isNotNull(), "ok")


def flag_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_flag``: ok, mild (beyond 1.5 IQR) or extreme (beyond 3 IQR)."""
    flags = {f"{c}_flag": _flag(F.col(c), lambda name, c=c: F.col("_fences")[c][name]) for c in columns}
    return _with_fences(df, columns).withColumns(flags).drop("_fences")


def flag_outliers_by_group(df: DataFrame, keys: Sequence[str], column: str, bounded: bool = True) -> DataFrame:
    """The same with quartiles per group; ``bounded`` groups fit a task each."""
    df = df if bounded else store(df, "outliers")
    groups = count_groups(df, keys)
    quartiles = percentiles(df, keys, [column], (0.25, 0.75), bounded, groups=groups, stored=True).select(
        *keys, *[f.alias(f"_{name}") for name, f in _fences(F.col("q")).items()]
    )
    flagged = join_group_table(df, quartiles, keys, groups)
    flag = _flag(F.col(column), lambda name: F.col(f"_{name}"))
    return flagged.withColumn(f"{column}_flag", flag).select(*df.columns, f"{column}_flag")


def outlier_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mild and extreme outliers per column, with their share of the present values."""
    flagged = flag_outliers(df, columns)
    counts = []
    for c in columns:
        counts.append(F.count(c).alias(f"{c}_all"))
        counts.append(F.count_if(F.col(f"{c}_flag") == "mild").alias(f"{c}_mild"))
        counts.append(F.count_if(F.col(f"{c}_flag") == "extreme").alias(f"{c}_extreme"))
    wide = flagged.agg(*counts)
    report = unpivot_row(wide, columns, {"n": "{}_all", "mild": "{}_mild", "extreme": "{}_extreme"})
    return report.withColumn("percentage", F.try_divide(F.col("mild") + F.col("extreme"), "n") * 100)


def treat_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cap mild outliers at the 1.5 IQR bounds and drop rows with an extreme one."""
    keep = F.lit(True)
    capped = {}
    for c in columns:
        value, fence = F.col(c), F.col("_fences")[c]
        keep = keep & F.coalesce((value >= fence["far_low"]) & (value <= fence["far_high"]), F.lit(True))
        capped[c] = F.when(value < fence["low"], fence["low"]).when(value > fence["high"], fence["high"]).otherwise(value)
    return _with_fences(df, columns).filter(keep).withColumns(capped).drop("_fences")
