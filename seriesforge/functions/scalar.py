"""Column expressions used by the feature operators; all stay inside code generation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesforge.specs import DRY_MONTHS, MONSOON_MONTHS, RAIN_THRESHOLD


def nan_to_null(column: str) -> Column:
    """Missing floating-point values enter as NaN; everything here works on NULL."""
    return F.nanvl(F.col(column), F.lit(None).cast("double")).alias(column)


def lenient_date(column: str) -> Column:
    """A date, or NULL where the text is not one."""
    return F.col(column).try_cast("date")


def day_of_week(column: str) -> Column:
    """Monday is 0."""
    return F.weekday(column)


def iso_week(column: str) -> Column:
    return F.weekofyear(column)


def in_months(column: str, months: Sequence[int]) -> Column:
    return F.month(column).isin(*months)


def is_monsoon(column: str) -> Column:
    return in_months(column, MONSOON_MONTHS)


def is_dry(column: str) -> Column:
    return in_months(column, DRY_MONTHS)


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of ``period`` steps."""
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def safe_ratio(top: Column, bottom: Column, offset: float = 1.0) -> Column:
    return F.try_divide(top, bottom + F.lit(offset))


def clip(column: Column, low: float, high: float) -> Column:
    """Values moved to the nearest bound; NULL stays NULL (``greatest``/``least`` would not keep it)."""
    return F.when(column < low, F.lit(low)).when(column > high, F.lit(high)).otherwise(column)


def out_of_range(column: Column, low: float, high: float) -> Column:
    return (column < low) | (column > high)


def binned(column: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "left") -> Column:
    """Label of the interval holding the value; NULL outside all of them."""
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be left or right, not {closed}")
    result = F
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (column >= low) & (column < high) if closed == "left" else (column > low) & (column <= high)
        result = result.when(inside, F.lit(label))
    return result


def one_hot(category: Column, label: str) -> Column:
    """False, not NULL, where the category is missing."""
    return F.coalesce(category == F.lit(label), F.lit(False))


def event_label(column: Column, threshold: float = RAIN_THRESHOLD) -> Column:
    return (column > F.lit(threshold)).cast("int")


def clip_at_zero(column: Column) -> Column:
    return F.when(column < 0, F.lit(0.0)).otherwise(column)


def percentage_error(actual: Column, predicted: Column) -> Column:
    """Absolute relative error with the small constant that keeps a zero actual finite."""
    return F.abs((actual - predicted) / (actual + F.lit(1e-8)))


def improvement(baseline: Column, value: Column) -> Column:
    """Percentage by which ``value`` is below ``baseline``."""
    return F.try_divide(baseline - value, baseline) * 100


def display_name(column: Column) -> Column:
    """``random_forest`` -> ``Random Forest``."""
    return F.initcap(F.replace(column, F.lit("_"), F.lit(" ")))


def format_number(column: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f", column)
