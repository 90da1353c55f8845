"""Registered queries: summaries, correlations, splits, scaling and resampling."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.scalar import display_name, format_number, is_monsoon
from seriesforge.operators import correlation, resample, scaling, splitting, statistics
from seriesforge.operators.windows import window_features
from seriesforge.plans.catalog import dbl, dbls, query
from seriesforge.plans.features import engineered_features, feature_table
from seriesforge.plans.inputs import ORDER_DAYS, ORDERS_SQL, WEEKLY, WEEKLY_SQL, orders, weekly_weather
from seriesforge.plans.queries_features import ENGINEERED_DOUBLES, ENGINEERED_SQL
from seriesforge.sources.readers import read_table
from seriesforge.specs import MEASURES, TARGET, TEMPERATURE, lag_columns

KEY = 'station, "Date"'


def _describe_sql(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS "column", CAST(count("{c}") AS BIGINT) AS count, {dbl(f'avg("{c}")', 'mean')},
  {dbl(f'stddev_samp("{c}")', 'std')}, {dbl(f'min("{c}")', 'min')}, {dbl(f'quantile_cont("{c}", 0.25)', 'p25')},
  {dbl(f'quantile_cont("{c}", 0.5)', 'p50')}, {dbl(f'quantile_cont("{c}", 0.75)', 'p75')}, {dbl(f'max("{c}")', 'max')}
  FROM {source}{tail}"""
        for c in MEASURES
    )


@query(f"WITH {WEEKLY_SQL} {_describe_sql('weekly')}")
def describe(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.describe(weekly_weather(spark, folder), MEASURES)


@query(f"WITH {WEEKLY_SQL} {_describe_sql('weekly', 'station')}")
def describe_by_series(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.describe(weekly_weather(spark, folder), MEASURES, ["station"], bounded=True)


@query(f"WITH {WEEKLY_SQL} SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(6 AS INTEGER) AS column_count FROM weekly")
def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.shape(weekly_weather(spark, folder))


@query(
    f"""WITH {WEEKLY_SQL} SELECT min("Date") AS first_date, max("Date") AS last_date,
  {dbl(f'avg("{TEMPERATURE}")', 'mean_temperature')} FROM weekly"""
)
def date_span_and_mean(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_weather(spark, folder).agg(
        F.min("Date").alias("first_date"), F.max("Date").alias("last_date"), F.avg(TEMPERATURE).alias("mean_temperature")
    )


@query(
    f"""WITH {WEEKLY_SQL} SELECT CAST(month("Date") AS INTEGER) AS "Month", {dbl(f'avg("{TARGET}")', f'mean_{TARGET}')}
FROM weekly GROUP BY 1"""
)
def month_means(spark: SparkSession, folder: str) -> DataFrame:
    return resample.month_means(weekly_weather(spark, folder), TARGET)


@query(
    f"""WITH {WEEKLY_SQL} SELECT month("Date") IN (4, 10, 11, 12) AS is_monsoon,
  {dbl(f'avg("{TARGET}")', f'mean_{TARGET}')} FROM weekly GROUP BY 1"""
)
def monsoon_means(spark: SparkSession, folder: str) -> DataFrame:
    return resample.flag_means(weekly_weather(spark, folder), is_monsoon("Date"), "is_monsoon", TARGET)


def _box_sql(by: str, name: str) -> str:
    return f"""b AS (SELECT {by} AS "{name}", "{TARGET}" AS v FROM weekly),
q AS (SELECT "{name}", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM b GROUP BY 1)
SELECT b."{name}", {dbls('q1', 'median', 'q3')},
  {dbl('min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END)', 'whisker_low')},
  {dbl('max(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END)', 'whisker_high')},
  CAST(count(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 END) AS BIGINT) AS outliers
FROM b JOIN q ON b."{name}" = q."{name}" GROUP BY b."{name}", q1, median, q3"""


@query(f"WITH {WEEKLY_SQL}, {_box_sql('CAST(month(\"Date\") AS INTEGER)', 'Month')}")
def boxplot_by_month(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).withColumn("Month", F.month("Date"))
    return statistics.box_plot(frame, ["Month"], TARGET)


@query(f"WITH {WEEKLY_SQL}, {_box_sql('month(\"Date\") IN (4, 10, 11, 12)', 'is_monsoon')}")
def boxplot_by_season(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).withColumn("is_monsoon", is_monsoon("Date"))
    return statistics.box_plot(frame, ["is_monsoon"], TARGET)


@query(
    f"""WITH {WEEKLY_SQL} SELECT station, CAST(year("Date") AS INTEGER) AS "Year", {dbl(f'sum("{TARGET}")', f'total_{TARGET}')},
  {dbl(f'avg("{TARGET}")', f'mean_{TARGET}')} FROM weekly GROUP BY 1, 2"""
)
def yearly_totals(spark: SparkSession, folder: str) -> DataFrame:
    return resample.yearly_totals(weekly_weather(spark, folder), TARGET, ["station"])


@query(
    f"""WITH {WEEKLY_SQL}, m AS (SELECT CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
  "{TARGET}" FROM weekly) SELECT "Year", "Month", {dbl(f'sum("{TARGET}")', f'total_{TARGET}')}
FROM m GROUP BY ROLLUP ("Year", "Month")"""
)
def yearly_monthly_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return resample.yearly_monthly_rollup(weekly_weather(spark, folder), TARGET)


@query(
    f"""SELECT c_mktsegment, n_name, CAST(year(o_orderdate) AS INTEGER) AS "Year", {dbl('sum(o_totalprice)', 'total_price', 2)},
  CAST(count(*) AS BIGINT) AS n FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
    digits=2,
)
def keyed_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly totals by attributes of the key; Spark sizes the joins."""
    sales = read_table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    yearly = sales.groupBy("o_custkey", F.year("o_orderdate").alias("Year")).agg(
        F.sum("o_totalprice").alias("_total"), F.count(F.lit(1)).alias("_n")
    )
    joined = yearly.join(customers, yearly.o_custkey == customers.c_custkey).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy("c_mktsegment", "n_name", "Year").agg(
        F.sum("_total").alias("total_price"), F.sum("_n").alias("n")
    )


@query(
    f"""SELECT user_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS period, {dbl('avg(value)', 'mean_value')},
  {dbl('sum(value)', 'total_value')}, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id, date_trunc('hour', ts)"""
)
def hourly_resample(spark: SparkSession, folder: str) -> DataFrame:
    hourly = resample.resample_period(
        read_table(spark, folder, "events"),
        ["user_id"],
        "ts",
        "hour",
        [F.avg("value").alias("mean_value"), F.sum("value").alias("total_value"), F.count(F.lit(1)).alias("n")],
    )
    return hourly.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


@query(
    f"""WITH {WEEKLY_SQL}, s AS (SELECT station, min("Date") AS a, max("Date") AS b FROM weekly GROUP BY 1),
c AS (SELECT station, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS "Date" FROM s)
SELECT c.station, c."Date" FROM c ANTI JOIN weekly w ON c.station = w.station AND c."Date" = w."Date\""""
)
def missing_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks of the calendar of each series that hold no row."""
    weekly = weekly_weather(spark, folder).select("station", "Date")
    return resample.calendar(weekly, ["station"]).join(weekly, ["station", "Date"], "left_anti")


_WIDE = [*[c for c in MEASURES if c != TARGET], *ENGINEERED_DOUBLES]


@query(
    f"WITH {WEEKLY_SQL}, {ENGINEERED_SQL}, c AS ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS feature, corr("{c}", "{TARGET}") AS r FROM engineered""" for c in _WIDE)
    + f") SELECT feature, {dbl('r', 'correlation')}, {dbl('abs(r)', 'strength')} FROM c"
)
def target_corr(spark: SparkSession, folder: str) -> DataFrame:
    wide = engineered_features(weekly_weather(spark, folder), WEEKLY)
    return correlation.target_correlations(wide, TARGET, _WIDE)


@query(
    f"WITH {WEEKLY_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS first, '{b}' AS second, {dbl(f'corr("{a}", "{b}")', 'correlation')} FROM weekly"""
        for a, b in combinations(MEASURES, 2)
    )
)
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return correlation.correlation_matrix(weekly_weather(spark, folder), MEASURES)


@query(
    f"WITH {WEEKLY_SQL}, l AS (SELECT *, "
    + ", ".join(
        f'lag("{TARGET}", {n}) OVER (PARTITION BY station ORDER BY "Date") AS l{n}' for n in (1, 2, 3)
    )
    + " FROM weekly), c AS ("
    + " UNION ALL ".join(f"""SELECT '{TARGET}_lag_{n}' AS feature, corr(l{n}, "{TARGET}") AS r FROM l""" for n in (1, 2, 3))
    + f") SELECT feature, {dbl('r', 'correlation')}, {dbl('abs(r)', 'strength')} FROM c"
)
def lag_effectiveness(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).select("station", "Date", TARGET)
    return correlation.lag_effectiveness(window_features(frame, WEEKLY, lags=lag_columns([TARGET], (1, 2, 3))))


@query(
    f"WITH {WEEKLY_SQL}, {ENGINEERED_SQL}, c AS ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS feature, corr("{c}", "{TARGET}") AS r FROM engineered""" for c in _WIDE)
    + f") SELECT feature, {dbl('r', 'correlation')}, {dbl('abs(r)', 'strength')} FROM c ORDER BY abs(r) DESC, feature LIMIT 8"
)
def top_k_features(spark: SparkSession, folder: str) -> DataFrame:
    wide = engineered_features(weekly_weather(spark, folder), WEEKLY)
    return correlation.top_features(wide, TARGET, 8, _WIDE)


@query()
def selected_feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """Engineer, select by correlation, project, drop incomplete rows."""
    return feature_table(weekly_weather(spark, folder), WEEKLY).rows


@query(
    f"""WITH {WEEKLY_SQL}, r AS (SELECT "{TARGET}" - lag("{TARGET}", 1) OVER (PARTITION BY station ORDER BY "Date") AS e
  FROM weekly), b AS (SELECT min(e) AS lo, max(e) AS hi FROM r)
SELECT CAST(least(floor((e - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n
FROM r, b WHERE e IS NOT NULL GROUP BY 1"""
)
def residual_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of the residuals of the persistence forecast."""
    lagged = window_features(
        weekly_weather(spark, folder).select("station", "Date", TARGET), WEEKLY, lags=lag_columns([TARGET], (1,))
    )
    return statistics.histogram(lagged.select((F.col(TARGET) - F.col(f"{TARGET}_lag_1")).alias("residual")), "residual")


_RN = f"""p AS (SELECT {KEY}, row_number() OVER (PARTITION BY station ORDER BY "Date") - 1 AS i,
  count(*) OVER (PARTITION BY station) AS n FROM weekly)"""


@query(f"WITH {WEEKLY_SQL}, {_RN} SELECT {KEY}, i < floor(n * CAST(0.8 AS DOUBLE)) AS is_train FROM p")
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).select("station", "Date")
    return splitting.chronological_split(frame, WEEKLY)


@query(
    f"""WITH {WEEKLY_SQL}, {_RN} SELECT {KEY}, CASE WHEN i < floor(floor(n * CAST(0.8 AS DOUBLE)) * CAST(0.8 AS DOUBLE))
  THEN 'train' WHEN i < floor(n * CAST(0.8 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS part FROM p"""
)
def validation_split(spark: SparkSession, folder: str) -> DataFrame:
    """Training, validation and test part of every series."""
    frame = weekly_weather(spark, folder).select("station", "Date")
    return splitting.validation_split(frame, WEEKLY)


@query(
    f"""WITH {ORDERS_SQL}, p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i,
  count(*) OVER () AS n FROM o) SELECT o_orderkey, i < floor(n * CAST(0.8 AS DOUBLE)) AS is_train FROM p"""
)
def keyless_temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.chronological_split(orders(spark, folder), ORDER_DAYS).select("o_orderkey", "is_train")


@query(
    f"""WITH {WEEKLY_SQL}, p AS (SELECT {KEY}, row_number() OVER (PARTITION BY station, year("Date") ORDER BY "Date") - 1 AS i,
  count(*) OVER (PARTITION BY station, year("Date")) AS n FROM weekly)
SELECT {KEY}, i < floor(n * CAST(0.8 AS DOUBLE)) AS is_train FROM p"""
)
def yearly_split(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.yearly_split(weekly_weather(spark, folder).select("station", "Date"), WEEKLY)


@query(
    f"""WITH {WEEKLY_SQL}, {_RN} SELECT {KEY}, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
  ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold FROM p"""
)
def kfold_ids(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.contiguous_folds(weekly_weather(spark, folder).select("station", "Date"), WEEKLY, 5)


@query(
    f"""WITH {ORDERS_SQL}, p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i,
  count(*) OVER () AS n FROM o) SELECT o_orderkey, CAST(CASE WHEN i < (n % 7) * (n // 7 + 1) THEN i // (n // 7 + 1)
  ELSE n % 7 + (i - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold FROM p"""
)
def keyless_kfold_ids(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.contiguous_folds(orders(spark, folder), ORDER_DAYS, 7).select("o_orderkey", "fold")


@query(
    f"""WITH {WEEKLY_SQL}, {_RN} SELECT {KEY}, CAST(CASE WHEN i < n - (n // 4) * 3 THEN -1
  ELSE (i - (n - (n // 4) * 3)) // (n // 4) END AS INTEGER) AS test_fold FROM p"""
)
def ts_fold_ids(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.expanding_folds(weekly_weather(spark, folder).select("station", "Date"), WEEKLY, 3)


@query(f"WITH {WEEKLY_SQL}, {_RN} SELECT {KEY} FROM p WHERE i >= n - 10")
def last_rows(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.last_rows(weekly_weather(spark, folder).select("station", "Date"), WEEKLY, 10)


def _scaled(c: str, method: str) -> str:
    if method == "standard":
        return f'("{c}" - (SELECT avg("{c}") FROM weekly)) / (SELECT stddev_pop("{c}") FROM weekly)'
    return f'("{c}" - (SELECT min("{c}") FROM weekly)) / (SELECT max("{c}") - min("{c}") FROM weekly)'


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, " + ", ".join(dbl(_scaled(c, "standard"), c) for c in MEASURES) + " FROM weekly")
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder)
    return scaling.apply_scaler(frame, scaling.scaler_table(frame, MEASURES), MEASURES)


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, " + ", ".join(dbl(_scaled(c, "minmax"), c) for c in MEASURES) + " FROM weekly")
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder)
    return scaling.apply_scaler(frame, scaling.scaler_table(frame, MEASURES, "minmax"), MEASURES)


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbls(*MEASURES)} FROM weekly")
def inverse_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled and brought back to the original units."""
    frame = weekly_weather(spark, folder)
    table = scaling.scaler_table(frame, MEASURES)
    scaled = scaling.apply_scaler(frame, table, MEASURES)
    return scaling.reverse_scaler(scaled, table, {c: c for c in MEASURES})


@query(
    f"""WITH {WEEKLY_SQL}, {_RN}, t AS (SELECT w.* FROM weekly w JOIN p ON w.station = p.station AND w."Date" = p."Date"
  WHERE i < floor(n * CAST(0.8 AS DOUBLE)))
SELECT {KEY}, {dbl(f'("{TARGET}" - (SELECT avg("{TARGET}") FROM t)) / (SELECT stddev_pop("{TARGET}") FROM t)', TARGET)}
FROM weekly"""
)
def scale_fitted_on_train(spark: SparkSession, folder: str) -> DataFrame:
    """Parameters from the training part only, applied everywhere."""
    frame = splitting.chronological_split(weekly_weather(spark, folder).select("station", "Date", TARGET), WEEKLY)
    table = scaling.scaler_table(frame.filter("is_train"), [TARGET])
    return scaling.apply_scaler(frame.drop("is_train"), table, [TARGET])


@query(
    """SELECT c_custkey, replace(c_name, '#', ' ') AS plain, starts_with(c_name, 'Customer#0') AS is_first,
  contains(c_name, '2') AS has_two FROM customer"""
)
def name_strings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("plain"),
        F.col("c_name").startswith("Customer#0").alias("is_first"),
        F.col("c_name").contains("2").alias("has_two"),
    )


@query("""SELECT c_custkey, printf('%.1f', c_acctbal + 0.003) AS balance,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment FROM customer""")
def number_format(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        format_number(F.col("c_acctbal") + F.lit(0.003), 1).alias("balance"),
        display_name(F.col("c_mktsegment")).alias("segment"),
    )
