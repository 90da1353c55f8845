"""Forecast features, models and evaluation over many keyed time series, on Spark."""

from seriesforge.specs import FeatureSpec, PreprocessSpec, SeriesSpec

__all__ = ["FeatureSpec", "PreprocessSpec", "SeriesSpec"]
