"""Declarative specs: which columns form a series, and what to derive from them."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

import yaml
from pyspark.sql import types as T

# Column names, ranges, months and bins of the weekly weather contract.
TIME = "Date"
TEMPERATURE = "Temp_avg"
HUMIDITY = "Relative_Humidity"
WIND = "Wind_kmh"
TARGET = "Precipitation_mm"
MEASURES = (TEMPERATURE, HUMIDITY, WIND, TARGET)
REQUIRED_COLUMNS = (TIME, *MEASURES)
OPTIONAL_COLUMNS = ("Week_Number", "Year")
VALID_RANGES = {
    TEMPERATURE: (20.0, 35.0),
    HUMIDITY: (0.0, 100.0),
    WIND: (0.0, 15.0),
    TARGET: (0.0, 400.0),
}
RANGE_KEY_TO_COLUMN = {
    "temperature": TEMPERATURE,
    "humidity": HUMIDITY,
    "wind": WIND,
    "precipitation": TARGET,
}
SHORT_NAMES = {"precipitation": TARGET, "temp": TEMPERATURE, "humidity": HUMIDITY}
MONSOON_MONTHS = (4, 10, 11, 12)
DRY_MONTHS = (6, 7, 8)
HUMIDITY_LABELS = ("Low", "Medium", "High")
HUMIDITY_EDGES_LEFT_CLOSED = (0.0, 60.0, 80.0, 101.0)
HUMIDITY_EDGES_RIGHT_CLOSED = (0.0, 60.0, 80.0, 100.0)
RAIN_THRESHOLD = 0.1
ESSENTIAL_FEATURES = (TEMPERATURE, HUMIDITY, WIND)
# End of fixed values.

#: Rows that one task may order.
CELL_ROWS = 200_000

WEATHER_SCHEMA = T.StructType(
    [T.StructField(TIME, T.DateType())] + [T.StructField(c, T.DoubleType()) for c in MEASURES]
)


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form ordered series.

    ``regular=True`` states that a series holds at most one row per calendar
    period (the output of a resample), so its length is bounded by the calendar
    and one task may order it.  Series without keys, or with ``regular=False``,
    can hold any number of rows; they are cut into blocks (see
    ``operators.ordering``) and never ordered in one task.

    ``cell_rows`` is how many rows of such a series one task may order, and
    ``block_rows`` how many rows a block of its windows holds.
    """

    keys: tuple[str, ...] = ()
    time: str = TIME
    tie: tuple[str, ...] = ()
    regular: bool = True
    cell_rows: int = CELL_ROWS
    block_rows: int = 1_000_000

    def __post_init__(self) -> None:
        for name in ("keys", "tie"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if self.cell_rows < 1 or self.block_rows < 1:
            raise ValueError("cell_rows and block_rows must be positive")

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tie]

    @property
    def one_task_per_series(self) -> bool:
        return bool(self.keys) and self.regular


@dataclass(frozen=True)
class PreprocessSpec:
    """Ranges, imputation and scaling; ``ranges`` maps a column to (low, high)."""

    ranges: dict[str, tuple[float, float]]
    imputation: str = "mean"
    scaling: str = "standard"

    def __post_init__(self) -> None:
        if not self.ranges:
            raise ValueError("valid_ranges is required")
        for column, bounds in self.ranges.items():
            if len(bounds) != 2 or bounds[0] > bounds[1]:
                raise ValueError(f"range of {column} must be (low, high)")
        if self.imputation not in ("mean", "median", "drop", "knn"):
            raise ValueError(f"unknown imputation method: {self.imputation}")
        if self.scaling not in ("standard", "minmax"):
            raise ValueError(f"unknown scaling method: {self.scaling}")

    @classmethod
    def from_config(cls, section: dict[str, Any]) -> "PreprocessSpec":
        """Build from a ``preprocessing`` config section; both keys are required."""
        for key in ("valid_ranges", "imputation_method"):
            if not section.get(key):
                raise ValueError(f"preprocessing config lacks {key}")
        ranges = {
            RANGE_KEY_TO_COLUMN.get(name, name): (float(low), float(high))
            for name, (low, high) in section["valid_ranges"].items()
        }
        return cls(ranges, section["imputation_method"], section.get("scaling_method", "standard"))


@dataclass(frozen=True)
class Derived:
    """One derived column: ``source`` shifted or averaged over ``size`` rows."""

    name: str
    source: str
    size: int


@dataclass(frozen=True)
class FeatureSpec:
    lags: tuple[Derived, ...] = ()
    averages: tuple[Derived, ...] = ()
    deviations: tuple[Derived, ...] = ()
    monsoon_months: tuple[int, ...] = ()
    dry_months: tuple[int, ...] = ()
    products: tuple[tuple[str, str], ...] = ()

    @property
    def any_asked(self) -> bool:
        """Whether any feature is asked for, also one that looks back on no rows."""
        return any(getattr(self, f.name) for f in fields(self))

    @property
    def horizon(self) -> int:
        """Rows of history the widest feature looks back."""
        spans = [d.size for d in self.lags]
        spans += [d.size - 1 for d in (*self.averages, *self.deviations)]
        return max(spans, default=0)

    @classmethod
    def from_config(cls, section: dict[str, Any]) -> "FeatureSpec":
        """Read the accepted config forms.

        Lags come as ``"temp_lag_2"`` (short base names are resolved) or as
        ``{column, lags}`` (used as written); averages as ``{base: [windows]}``, as
        ``{"temp_ma_3": 3}`` (used as written), or as a list of ``{column, windows}``, named after the full column.
        """
        lags: list[Derived] = []
        for entry in section.get("lag_features", []):
            if isinstance(entry, str):
                base, _, size = entry.rpartition("_lag_")
                lags.append(Derived(entry, SHORT_NAMES.get(base, base), int(size)))
            else:
                column = entry["column"]
                lags += [Derived(f"{column}_lag_{n}", column, int(n)) for n in entry["lags"]]

        forms = section.get("moving_averages", {})
        pairs = forms.items() if isinstance(forms, dict) else [(f["column"], f["windows"]) for f in forms]
        averages: list[Derived] = []
        for base, windows in pairs:
            if isinstance(windows, int):
                source = base.rpartition("_ma_")[0] or base
                averages.append(Derived(base, SHORT_NAMES.get(source, source), windows))
                continue
            column = SHORT_NAMES.get(base, base)
            averages += [Derived(f"{column}_ma_{w}", column, int(w)) for w in windows]

        rolling = section.get("rolling_std", {})
        deviations = tuple(
            Derived(f"{c}_rolling_std", c, int(rolling.get("window", 3))) for c in rolling.get("columns", [])
        )
        seasons = section.get("seasonal_features", {})
        return cls(
            tuple(lags),
            tuple(averages),
            deviations,
            tuple(seasons.get("monsoon_months", ())),
            tuple(seasons.get("dry_months", ())),
            tuple((a, b) for a, b in section.get("interaction_features", [])),
        )


def lag_columns(columns, sizes) -> list[Derived]:
    return [Derived(f"{c}_lag_{n}", c, n) for c in columns for n in sizes]


def average_columns(columns, sizes) -> list[Derived]:
    return [Derived(f"{c}_ma_{n}", c, n) for c in columns for n in sizes]


def std_columns(columns, size: int = 3) -> list[Derived]:
    return [Derived(f"{c}_rolling_std", c, size) for c in columns]


# Features derived while cleaning, all three lags and both windows per column.
PREPROCESS_LAGS = tuple(
    Derived(f"{short}_lag_{n}", column, n) for n in (1, 2, 3) for short, column in SHORT_NAMES.items()
)
PREPROCESS_AVERAGES = tuple(
    Derived(f"{short}_ma_{n}", column, n) for n in (3, 4) for short, column in SHORT_NAMES.items()
)
# End of fixed values.


@dataclass(frozen=True)
class ForecastSpec:
    """Settings of an end-to-end run."""

    preprocess: PreprocessSpec = field(default_factory=lambda: PreprocessSpec(dict(VALID_RANGES)))
    features: FeatureSpec = field(default_factory=FeatureSpec)
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5

    @classmethod
    def from_yaml(cls, path: str) -> "ForecastSpec":
        with open(path, encoding="utf-8") as handle:
            config = yaml.safe_load(handle) or {}
        models = config.get("models", {})
        return cls(
            PreprocessSpec.from_config(config.get("preprocessing", {})),
            FeatureSpec.from_config(config.get("feature_engineering", {})),
            models.get("test_size", 0.2),
            models.get("random_state", 42),
            models.get("cv_folds", 5),
        )
