"""Registered queries: loading, windows, scalar features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators import windows
from seriesforge.plans.catalog import dbl, dbls, query
from seriesforge.plans.features import (
    build_features,
    engineered_features,
    interaction_features,
    preprocess,
    seasonal_features,
)
from seriesforge.plans.inputs import EVENTS, ORDER_DAYS, ORDERS_SQL, WEEKLY, WEEKLY_SQL, events, orders, weekly_weather
from seriesforge.functions import scalar
from seriesforge.operators.ordering import row_index
from seriesforge.specs import (
    HUMIDITY,
    HUMIDITY_EDGES_LEFT_CLOSED,
    HUMIDITY_EDGES_RIGHT_CLOSED,
    HUMIDITY_LABELS,
    MEASURES,
    TARGET,
    TEMPERATURE,
    average_columns,
    lag_columns,
    std_columns,
)

KEY = 'station, "Date"'
SERIES = 'OVER (PARTITION BY station ORDER BY "Date")'


def frame_sql(rows: int) -> str:
    return f'OVER (PARTITION BY station ORDER BY "Date" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)'


def full_average_sql(column: str, rows: int) -> str:
    over = frame_sql(rows)
    return f'CASE WHEN count("{column}") {over} = {rows} THEN avg("{column}") {over} END'


def std_sql(column: str, rows: int = 3) -> str:
    over = frame_sql(rows)
    return f'CASE WHEN count("{column}") {over} = {rows} THEN stddev_samp("{column}") {over} END'


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbls(*MEASURES)} FROM weekly")
def weekly_resample(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_weather(spark, folder)


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + ", ".join(dbl(f'lag("{c}", {n}) {SERIES}', f"{c}_lag_{n}") for c in MEASURES for n in (1, 2))
    + " FROM weekly"
)
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    lags = lag_columns(MEASURES, (1, 2))
    return windows.window_features(weekly_weather(spark, folder), WEEKLY, lags=lags).drop(*MEASURES)


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + ", ".join(dbl(full_average_sql(c, n), f"{c}_ma_{n}") for c in MEASURES[:2] + (TARGET,) for n in (3, 4))
    + " FROM weekly"
)
def moving_avg_full(spark: SparkSession, folder: str) -> DataFrame:
    averages = average_columns(MEASURES[:2] + (TARGET,), (3, 4))
    return windows.window_features(weekly_weather(spark, folder), WEEKLY, averages=averages).drop(*MEASURES)


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + ", ".join(dbl(f'avg("{c}") {frame_sql(n)}', f"{c}_ma_{n}") for c in MEASURES for n in (3, 4))
    + " FROM weekly"
)
def moving_avg_partial(spark: SparkSession, folder: str) -> DataFrame:
    averages = average_columns(MEASURES, (3, 4))
    return windows.window_features(weekly_weather(spark, folder), WEEKLY, averages=averages, partial=True).drop(
        *MEASURES
    )


_PAST = 'OVER (PARTITION BY station ORDER BY "Date" ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)'


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + dbl(f'CASE WHEN count("{TARGET}") {_PAST} = 3 THEN avg("{TARGET}") {_PAST} END', f"{TARGET}_ma_3")
    + " FROM weekly"
)
def moving_avg_past_only(spark: SparkSession, folder: str) -> DataFrame:
    averages = average_columns([TARGET], (3,))
    frame = weekly_weather(spark, folder).select("station", "Date", TARGET)
    return windows.window_features(frame, WEEKLY, averages=averages, exclude_current=True).drop(TARGET)


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + ", ".join(dbl(std_sql(c), f"{c}_rolling_std") for c in MEASURES)
    + " FROM weekly"
)
def rolling_std(spark: SparkSession, folder: str) -> DataFrame:
    return windows.window_features(weekly_weather(spark, folder), WEEKLY, deviations=std_columns(MEASURES)).drop(
        *MEASURES
    )


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + dbl(f'"{TARGET}" - lag("{TARGET}", 1) {SERIES}', f"{TARGET}_diff_1")
    + ", "
    + dbl(
        f'"{TARGET}" - 2 * lag("{TARGET}", 1) {SERIES} + lag("{TARGET}", 2) {SERIES}',
        f"{TARGET}_diff_2",
    )
    + " FROM weekly"
)
def differencing(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).select("station", "Date", TARGET)
    once = windows.difference(frame, WEEKLY, TARGET, 1)
    return windows.difference(once, WEEKLY, TARGET, 2).drop(TARGET)


_CENTRED = f"""c AS (SELECT station, "Date", "{TARGET}" - avg("{TARGET}") OVER (PARTITION BY station) AS x FROM weekly),
l AS (SELECT station, x, lag(x, 1) {SERIES} AS x1, lag(x, 2) {SERIES} AS x2, lag(x, 3) {SERIES} AS x3 FROM c),
r AS (SELECT station, sum(x * x1) / sum(x * x) AS r1, sum(x * x2) / sum(x * x) AS r2, sum(x * x3) / sum(x * x) AS r3
      FROM l GROUP BY station)"""


@query(
    f"""WITH {WEEKLY_SQL}, {_CENTRED}
SELECT station, CAST(1 AS INTEGER) AS lag, {dbl('r1', 'acf')} FROM r
UNION ALL SELECT station, 2, {dbl('r2', 'acf')} FROM r
UNION ALL SELECT station, 3, {dbl('r3', 'acf')} FROM r"""
)
def acf(spark: SparkSession, folder: str) -> DataFrame:
    return windows.autocorrelation(weekly_weather(spark, folder), WEEKLY, TARGET, 3)


@query(
    f"""WITH {WEEKLY_SQL}, {_CENTRED},
p AS (SELECT station, r1 AS p1, (r2 - r1 * r1) / (1 - r1 * r1) AS p2,
             (r3 - 2 * r1 * r2 + r1 * r1 * r1 + r1 * r2 * r2 - r1 * r1 * r3)
             / (1 + 2 * r1 * r1 * r2 - r2 * r2 - 2 * r1 * r1) AS p3 FROM r)
SELECT station, CAST(1 AS INTEGER) AS lag, {dbl('p1', 'pacf')} FROM p
UNION ALL SELECT station, 2, {dbl('p2', 'pacf')} FROM p
UNION ALL SELECT station, 3, {dbl('p3', 'pacf')} FROM p"""
)
def pacf(spark: SparkSession, folder: str) -> DataFrame:
    return windows.partial_autocorrelation(weekly_weather(spark, folder), WEEKLY, TARGET, 3)


@query(
    f"""WITH {ORDERS_SQL} SELECT o_orderkey,
  CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS row_index FROM o"""
)
def keyless_row_index(spark: SparkSession, folder: str) -> DataFrame:
    return row_index(orders(spark, folder), ORDER_DAYS).select("o_orderkey", "row_index")


@query(
    f"""WITH {ORDERS_SQL} SELECT o_orderkey,
  {dbl('lag(o_totalprice, 1) OVER w', 'o_totalprice_lag_1')},
  {dbl('lag(o_totalprice, 2) OVER w', 'o_totalprice_lag_2')},
  {dbl('CASE WHEN count(o_totalprice) OVER f = 4 THEN avg(o_totalprice) OVER f END', 'o_totalprice_ma_4', 4)}
FROM o WINDOW w AS (ORDER BY o_orderdate, o_orderkey),
              f AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    digits=4,
)
def keyless_window_features(spark: SparkSession, folder: str) -> DataFrame:
    """One long series without a key: ordered in blocks with halo rows."""
    blocked = windows.window_features(
        orders(spark, folder),
        ORDER_DAYS,
        lags=lag_columns(["o_totalprice"], (1, 2)),
        averages=average_columns(["o_totalprice"], (4,)),
    )
    return blocked.drop("o_orderdate", "o_totalprice")


@query(
    f"""SELECT event_id, {dbl('lag(value, 1) OVER w', 'value_lag_1')},
  {dbl('CASE WHEN count(value) OVER f = 3 THEN avg(value) OVER f END', 'value_ma_3')},
  {dbl('CASE WHEN count(value) OVER f = 3 THEN stddev_samp(value) OVER f END', 'value_rolling_std')}
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
  f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
)
def unbounded_series_features(spark: SparkSession, folder: str) -> DataFrame:
    """Series per user that may hold any share of all rows: every series is cut into blocks."""
    blocked = windows.window_features(
        events(spark, folder),
        EVENTS,
        lags=lag_columns(["value"], (1,)),
        averages=average_columns(["value"], (3,)),
        deviations=std_columns(["value"]),
    )
    return blocked.select("event_id", "value_lag_1", "value_ma_3", "value_rolling_std")


@query(
    f"""WITH {WEEKLY_SQL} SELECT {KEY}, CAST(month("Date") AS INTEGER) AS "Month",
  CAST(isodow("Date") - 1 AS INTEGER) AS "DayOfWeek", CAST(year("Date") AS INTEGER) AS "Year",
  month("Date") IN (4, 10, 11, 12) AS is_monsoon, month("Date") IN (6, 7, 8) AS is_dry FROM weekly"""
)
def seasonal_flags(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_weather(spark, folder).select(
        "station",
        "Date",
        F.month("Date").alias("Month"),
        scalar.day_of_week("Date").alias("DayOfWeek"),
        F.year("Date").alias("Year"),
        scalar.is_monsoon("Date").alias("is_monsoon"),
        scalar.is_dry("Date").alias("is_dry"),
    )


_SEASONAL_SQL = f"""CAST(month("Date") AS INTEGER) AS "Month",
  CAST(month("Date") IN (4, 10, 11, 12) AS INTEGER) AS is_monsoon,
  CAST(month("Date") IN (6, 7, 8) AS INTEGER) AS is_dry_season,
  {dbl('sin(2 * pi() * month("Date") / 12)', 'month_sin')}, {dbl('cos(2 * pi() * month("Date") / 12)', 'month_cos')},
  CAST(weekofyear("Date") AS INTEGER) AS "Week_Number",
  {dbl('sin(2 * pi() * weekofyear("Date") / 52)', 'week_sin')},
  {dbl('cos(2 * pi() * weekofyear("Date") / 52)', 'week_cos')}"""


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {_SEASONAL_SQL} FROM weekly")
def seasonal_bundle(spark: SparkSession, folder: str) -> DataFrame:
    return seasonal_features(weekly_weather(spark, folder).select("station", "Date"))


_INTERACTION_SQL = f"""{dbl('"Temp_avg" * "Relative_Humidity"', 'temp_humidity_interaction')},
  {dbl('"Wind_kmh" / ("Precipitation_mm" + 1)', 'wind_precip_ratio')},
  {dbl('"Temp_avg" - (SELECT avg("Temp_avg") FROM weekly)', 'temp_deviation')},
  coalesce("Relative_Humidity" >= 0 AND "Relative_Humidity" < 60, false) AS "humidity_Low",
  coalesce("Relative_Humidity" >= 60 AND "Relative_Humidity" < 80, false) AS "humidity_Medium",
  coalesce("Relative_Humidity" >= 80 AND "Relative_Humidity" < 101, false) AS "humidity_High\""""


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {_INTERACTION_SQL} FROM weekly")
def interaction_bundle(spark: SparkSession, folder: str) -> DataFrame:
    return interaction_features(weekly_weather(spark, folder)).drop(*MEASURES)


@query(
    f"""WITH {WEEKLY_SQL} SELECT {KEY},
  {dbl(f'"{TEMPERATURE}" - avg("{TEMPERATURE}") OVER (PARTITION BY station)', 'temp_deviation')} FROM weekly"""
)
def mean_deviation_by_series(spark: SparkSession, folder: str) -> DataFrame:
    frame = windows.with_series_mean(weekly_weather(spark, folder), WEEKLY, TEMPERATURE, "_mean")
    return frame.select("station", "Date", (F.col(TEMPERATURE) - F.col("_mean")).alias("temp_deviation"))


@query(
    f"""WITH {WEEKLY_SQL} SELECT {KEY}, CASE
  WHEN "{HUMIDITY}" >= 0 AND "{HUMIDITY}" < 60 THEN 'Low' WHEN "{HUMIDITY}" >= 60 AND "{HUMIDITY}" < 80 THEN 'Medium'
  WHEN "{HUMIDITY}" >= 80 AND "{HUMIDITY}" < 101 THEN 'High' END AS humidity_category FROM weekly"""
)
def humidity_bins_left(spark: SparkSession, folder: str) -> DataFrame:
    label = scalar.binned(F.col(HUMIDITY), HUMIDITY_EDGES_LEFT_CLOSED, HUMIDITY_LABELS, "left")
    return weekly_weather(spark, folder).select("station", "Date", label.alias("humidity_category"))


@query(
    f"""WITH {WEEKLY_SQL} SELECT {KEY}, CASE
  WHEN "{HUMIDITY}" > 0 AND "{HUMIDITY}" <= 60 THEN 'Low' WHEN "{HUMIDITY}" > 60 AND "{HUMIDITY}" <= 80 THEN 'Medium'
  WHEN "{HUMIDITY}" > 80 AND "{HUMIDITY}" <= 100 THEN 'High' END AS humidity_category FROM weekly"""
)
def humidity_bins_right(spark: SparkSession, folder: str) -> DataFrame:
    label = scalar.binned(F.col(HUMIDITY), HUMIDITY_EDGES_RIGHT_CLOSED, HUMIDITY_LABELS, "right")
    return weekly_weather(spark, folder).select("station", "Date", label.alias("humidity_category"))


@query(
    f"""WITH {WEEKLY_SQL} SELECT {KEY}, "{TARGET}" > 0.1 AS rain,
  {dbl(f'CASE WHEN "{TARGET}" - 40 < 0 THEN 0 ELSE "{TARGET}" - 40 END', 'above_40')} FROM weekly"""
)
def rain_label_and_floor(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_weather(spark, folder).select(
        "station",
        "Date",
        (scalar.event_label(F.col(TARGET)) == 1).alias("rain"),
        scalar.clip_at_zero(F.col(TARGET) - 40).alias("above_40"),
    )


_SHORT = {"precipitation": TARGET, "temp": TEMPERATURE, "humidity": HUMIDITY}
_CLIPPED = """clipped AS (SELECT station, "Date",
  CASE WHEN "Temp_avg" < 20 THEN 20 WHEN "Temp_avg" > 35 THEN 35 ELSE "Temp_avg" END AS "Temp_avg",
  CASE WHEN "Relative_Humidity" < 0 THEN 0 WHEN "Relative_Humidity" > 100 THEN 100
       ELSE "Relative_Humidity" END AS "Relative_Humidity",
  CASE WHEN "Wind_kmh" < 0 THEN 0 WHEN "Wind_kmh" > 15 THEN 15 ELSE "Wind_kmh" END AS "Wind_kmh",
  CASE WHEN "Precipitation_mm" < 0 THEN 0 WHEN "Precipitation_mm" > 400 THEN 400
       ELSE "Precipitation_mm" END AS "Precipitation_mm" FROM weekly)"""
_PREPROCESSED = (
    f"{_CLIPPED}, preprocessed AS (SELECT *, "
    + ", ".join(f'lag("{c}", {n}) {SERIES} AS {s}_lag_{n}' for s, c in _SHORT.items() for n in (1, 2, 3))
    + ", "
    + ", ".join(f"{full_average_sql(c, n)} AS {s}_ma_{n}" for s, c in _SHORT.items() for n in (3, 4))
    + f', row_number() {SERIES} AS rn FROM clipped QUALIFY rn > 3)'
)
_PREPROCESSED_NAMES = [f"{s}_lag_{n}" for s in _SHORT for n in (1, 2, 3)] + [f"{s}_ma_{n}" for s in _SHORT for n in (3, 4)]


@query(f"WITH {WEEKLY_SQL}, {_PREPROCESSED} SELECT {KEY}, {dbls(*MEASURES, *_PREPROCESSED_NAMES)} FROM preprocessed")
def preprocess_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Impute, cap, lag and average, then drop incomplete rows."""
    return preprocess(weekly_weather(spark, folder), WEEKLY)


_BUILT = [f"{c}_ma_{n}" for c in (TARGET, TEMPERATURE, HUMIDITY) for n in (3, 4)] + [f"{c}_rolling_std" for c in MEASURES]


@query(
    f"WITH {WEEKLY_SQL}, built AS (SELECT *, "
    + ", ".join(f'lag("{c}", {n}) {SERIES} AS {s}_lag_{n}' for s, c in _SHORT.items() for n in (1, 2, 3))
    + ", "
    + ", ".join(f'{full_average_sql(c, n)} AS "{c}_ma_{n}"' for c in _SHORT.values() for n in (3, 4))
    + ", "
    + ", ".join(f'{std_sql(c)} AS "{c}_rolling_std"' for c in MEASURES)
    + f', row_number() {SERIES} AS rn FROM weekly QUALIFY rn > 3) SELECT {KEY}, '
    + dbls(*MEASURES, *[f"{s}_lag_{n}" for s in _SHORT for n in (1, 2, 3)], *_BUILT)
    + """, month("Date") IN (4, 10, 11, 12) AS is_monsoon, CAST(month("Date") AS INTEGER) AS "Month",
  CAST(isodow("Date") - 1 AS INTEGER) AS "DayOfWeek", """
    + dbl('"Temp_avg" * "Relative_Humidity"', "Temp_Humidity")
    + " FROM built"
)
def build_features_bundle(spark: SparkSession, folder: str) -> DataFrame:
    return build_features(weekly_weather(spark, folder), WEEKLY)


ENGINEERED_DOUBLES = [
    *[f"{c}_lag_{n}" for c in MEASURES for n in (1, 2)],
    *[f"{c}_ma_{n}" for c in MEASURES for n in (3, 4)],
]
ENGINEERED_SQL = (
    "engineered AS (SELECT *, "
    + ", ".join(f'lag("{c}", {n}) {SERIES} AS "{c}_lag_{n}"' for c in MEASURES for n in (1, 2))
    + ", "
    + ", ".join(f'avg("{c}") {frame_sql(n)} AS "{c}_ma_{n}"' for c in MEASURES for n in (3, 4))
    + f', row_number() {SERIES} AS rn FROM weekly QUALIFY rn > 2)'
)


@query(
    f"WITH {WEEKLY_SQL}, {ENGINEERED_SQL} SELECT {KEY}, {dbls(*MEASURES, *ENGINEERED_DOUBLES)}, {_SEASONAL_SQL}, {_INTERACTION_SQL} FROM engineered"
)
def engineered_features_table(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: weekly series to the complete feature table."""
    return engineered_features(weekly_weather(spark, folder), WEEKLY)
