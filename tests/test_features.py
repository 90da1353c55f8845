import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from seriesforge.functions import scalar
from seriesforge.operators import resample, windows
from seriesforge.plans.features import build_features, engineered_features, feature_table, interaction_features, preprocess, seasonal_features
from seriesforge.specs import (
    HUMIDITY_EDGES_LEFT_CLOSED,
    HUMIDITY_EDGES_RIGHT_CLOSED,
    HUMIDITY_LABELS,
    Derived,
    FeatureSpec,
    ForecastSpec,
    SeriesSpec,
)

CONFIG = {
    "lag_features": ["temp_lag_1", {"column": "humidity", "lags": [2]}],
    "moving_averages": [{"column": "temp2", "windows": [3]}, {"column": "rain", "windows": [2]}],
    "seasonal_features": {"monsoon_months": [4, 10, 11, 12], "dry_months": [6, 7, 8]},
}


@pytest.fixture(scope="module")
def builder(spark, sunday):
    rows = [(1, d, 21.5 + i % 4, 90.0 - 3 * i, float(i * i % 17)) for i, d in enumerate(sunday[:10])]
    return spark.createDataFrame(rows, "station int, Date date, temp double, humidity double, rain double")


def test_null_counts_before_dropping(builder, by_station):
    spec = FeatureSpec(
        lags=(Derived("temp_lag_1", "temp", 1), Derived("humidity_lag_2", "humidity", 2)),
        averages=(Derived("temp_ma_3", "temp", 3), Derived("rain_ma_2", "rain", 2)),
        monsoon_months=(4, 10, 11, 12),
        dry_months=(6, 7, 8),
    )
    df = build_features(builder, by_station, spec, drop=False)
    nulls = {c: df.filter(F.col(c).isNull()).count() for c in ("temp_lag_1", "humidity_lag_2", "temp_ma_3", "rain_ma_2")}
    assert list(nulls.values()) == [1, 2, 2, 1]
    types = dict(df.dtypes)
    assert types["is_monsoon"] == types["is_dry"] == "boolean"


def test_config_forms():
    spec = FeatureSpec.from_config(CONFIG)
    assert [(d.name, d.source, d.size) for d in spec.lags] == [
        ("temp_lag_1", "Temp_avg", 1),
        ("humidity_lag_2", "humidity", 2),
    ]
    assert [d.name for d in spec.averages] == ["temp2_ma_3", "rain_ma_2"]
    named = FeatureSpec.from_config({"moving_averages": {"temp_ma_3": 3, "humidity": [2]}})
    assert [(d.name, d.source, d.size) for d in named.averages][0] == ("temp_ma_3", "Temp_avg", 3)
    table = FeatureSpec.from_config({"moving_averages": {"precipitation": [3, 4]}})
    assert [d.name for d in table.averages] == ["Precipitation_mm_ma_3", "Precipitation_mm_ma_4"]
    assert spec.horizon == 2


def test_yaml_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(
        "preprocessing: {valid_ranges: {temperature: [20, 35]}, imputation_method: mean, scaling_method: minmax}\n"
        "feature_engineering: {lag_features: [temp_lag_1]}\nmodels: {test_size: 0.25}\n"
    )
    spec = ForecastSpec.from_yaml(str(path))
    assert spec.test_size == 0.25 and spec.preprocess.scaling == "minmax" and spec.features.lags[0].source == "Temp_avg"


def test_unknown_column_raises(builder, by_station):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        build_features(builder, by_station, FeatureSpec(lags=(Derived("x_lag_1", "x", 1),)))


def test_two_passes_lose_three_rows_each(weather, by_station):
    first = preprocess(weather, by_station)
    assert first.count() == 7
    assert build_features(first, by_station).count() == 4


def test_engineered_rows_and_columns(weather, by_station):
    df = engineered_features(weather, by_station)
    assert df.count() == 8
    for name in ("Temp_avg_lag_2", "Precipitation_mm_ma_4", "month_sin", "week_cos", "wind_precip_ratio", "humidity_High"):
        assert name in df.columns
    assert "humidity_category" not in df.columns


def test_feature_table_keeps_essentials_and_target(weather, by_station):
    chosen = feature_table(weather, by_station, top_n=3)
    assert {"Temp_avg", "Relative_Humidity", "Wind_kmh"} <= set(chosen.features)
    assert chosen.rows.columns[-1] == "Precipitation_mm" and len(chosen.rows.columns) == len(set(chosen.rows.columns))


def test_partial_and_past_windows(builder, by_station):
    d = [Derived("m", "temp", 3)]
    partial = windows.window_features(builder, by_station, averages=d, partial=True).orderBy("Date").first()
    assert partial["m"] == 21.5
    past = windows.window_features(builder, by_station, averages=d, exclude_current=True).orderBy("Date").collect()
    assert [r["m"] for r in past[:4]] == [None, None, None, 22.5]


def test_rolling_std_is_the_sample_one(builder, by_station):
    df = windows.window_features(builder, by_station, deviations=[Derived("s", "temp", 3)]).orderBy("Date").collect()
    assert df[1]["s"] is None and df[2]["s"] == pytest.approx(1.0)


def test_short_series_has_no_features(spark, by_station):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 5), 1.0)], "station int, Date date, x double")
    row = windows.window_features(df, by_station, [Derived("l", "x", 3)], [Derived("m", "x", 4)]).first()
    assert row["l"] is None and row["m"] is None


def test_tied_times_follow_the_tie_column(spark):
    rows = [(1, dt.date(2020, 1, 5), i, float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "station int, Date date, id int, x double").repartition(3)
    spec = SeriesSpec(keys=("station",), tie=("id",))
    got = windows.window_features(df, spec, [Derived("l", "x", 1)]).orderBy("id").collect()
    assert [r["l"] for r in got] == [None, 0.0, 1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize("value,left,right", [
    (0.0, "Low", None), (60.0, "Medium", "Low"), (80.0, "High", "Medium"), (100.0, "High", "High"),
    (101.0, None, None), (None, None, None),
])
def test_bin_edges(spark, value, left, right):
    df = spark.createDataFrame([(value,)], "x double")
    a = scalar.binned(F.col("x"), HUMIDITY_EDGES_LEFT_CLOSED, HUMIDITY_LABELS, "left")
    b = scalar.binned(F.col("x"), HUMIDITY_EDGES_RIGHT_CLOSED, HUMIDITY_LABELS, "right")
    row = df.select(a.alias("a"), b.alias("b"), scalar.one_hot(a, "Low").alias("low")).first()
    assert (row["a"], row["b"]) == (left, right)
    assert row["low"] is (left == "Low")


def test_category_can_stay(weather):
    df = interaction_features(weather, closed="right", keep_category=True)
    assert {r[0] for r in df.select("humidity_category").distinct().collect()} == {"Medium", "High"}


def test_seasons_and_circle(spark):
    df = seasonal_features(spark.createDataFrame([(dt.date(2020, 4, 5),), (dt.date(2020, 7, 5),)], "Date date"))
    april, july = df.orderBy("Date").collect()
    assert (april["is_monsoon"], april["is_dry_season"]) == (1, 0) and (july["is_monsoon"], july["is_dry_season"]) == (0, 1)
    assert april["month_sin"] == pytest.approx(math.sin(2 * math.pi * 4 / 12))
    assert april["Week_Number"] == 14
    with pytest.raises(ValueError):
        seasonal_features(spark.createDataFrame([(1,)], "x int"))


def test_given_week_number_is_used(spark):
    df = spark.createDataFrame([(dt.date(2020, 4, 5), 26)], "Date date, Week_Number int")
    assert seasonal_features(df).first()["week_cos"] == pytest.approx(-1.0)


def test_scalar_helpers(spark):
    row = spark.range(1).select(
        scalar.clip_at_zero(F.lit(-1.0)).alias("zero"),
        scalar.percentage_error(F.lit(0.0), F.lit(1.0)).alias("pe"),
        scalar.improvement(F.lit(32.45), F.lit(25.13)).alias("gain"),
        scalar.display_name(F.lit("random_forest")).alias("name"),
        scalar.format_number(F.lit(1.005), 1).alias("text"),
        scalar.event_label(F.lit(0.1)).alias("dry"),
        scalar.safe_ratio(F.lit(1.0), F.lit(-1.0)).alias("none"),
    ).first()
    assert row["zero"] == 0 and row["pe"] == pytest.approx(1e8) and row["gain"] == pytest.approx(22.56, abs=0.01)
    assert row["name"] == "Random Forest" and row["text"] == "1.0" and row["dry"] == 0 and row["none"] is None


def test_week_label_is_the_closing_sunday(spark):
    days = [(dt.date(2020, 1, 6),), (dt.date(2020, 1, 12),), (dt.date(2020, 1, 13),)]
    df = spark.createDataFrame(days, "d date").select(resample.week_ending_sunday(F.col("d")).alias("w"))
    assert [r["w"] for r in df.collect()] == [dt.date(2020, 1, 12), dt.date(2020, 1, 12), dt.date(2020, 1, 19)]


def test_differences(builder, by_station):
    df = windows.difference(builder, by_station, "temp", 2).orderBy("Date").collect()
    assert df[1]["temp_diff_2"] is None and df[4]["temp_diff_2"] == -4.0


def test_calendar_fills_missing_weeks(weather):
    gapped = weather.filter("Date <> date'2020-02-02'").select("station", "Date")
    full = resample.calendar(gapped, ["station"])
    assert [r["Date"] for r in full.join(gapped, ["station", "Date"], "left_anti").collect()] == [dt.date(2020, 2, 2)]


def test_result_does_not_depend_on_partitioning(weather, by_station):
    a = engineered_features(weather.repartition(1), by_station).orderBy("Date").collect()
    b = engineered_features(weather.repartition(16), by_station).orderBy("Date").collect()
    assert [[round(v, 9) if isinstance(v, float) else v for v in r] for r in a] == [
        [round(v, 9) if isinstance(v, float) else v for v in r] for r in b
    ]
