"""Registered queries: loading, quality, merging, imputation and outliers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.scalar import lenient_date
from seriesforge.operators import outliers, quality, setops
from seriesforge.operators.imputation import impute
from seriesforge.plans.catalog import dbl, dbls, query
from seriesforge.plans.inputs import WEEKLY, WEEKLY_SQL, weekly_weather
from seriesforge.session import scratch_path
from seriesforge.sources.ordered import read_manifest, read_range, write_ordered
from seriesforge.sources.readers import load_and_merge, load_with_checks, read_csv, read_table, with_year
from seriesforge.sources.writers import write_csv, write_features, write_parquet
from seriesforge.specs import MEASURES, TARGET, TEMPERATURE, VALID_RANGES

KEY = 'station, "Date"'
CUTS = ("1998-07-05", "1998-12-27")


def two_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The weekly table as two sources whose periods overlap by half a year.

    Both read one written table: equal rows must be equal to the last bit, which
    two evaluations of a floating-point mean do not promise.
    """
    path = scratch_path(spark, "weekly")
    write_parquet(weekly_weather(spark, folder), path)
    weekly = spark.read.parquet(path)
    return weekly.filter(F.col("Date") <= F.lit(CUTS[1]).cast("date")), weekly.filter(
        F.col("Date") >= F.lit(CUTS[0]).cast("date")
    )


TWO_SQL = f"""{WEEKLY_SQL}, first AS (SELECT * FROM weekly WHERE "Date" <= DATE '{CUTS[1]}'),
second AS (SELECT * FROM weekly WHERE "Date" >= DATE '{CUTS[0]}')"""


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbls(*MEASURES)}, CAST(year(\"Date\") AS INTEGER) AS \"Year\" FROM weekly")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly table to CSV files and back, with types and the derived year."""
    path = scratch_path(spark, "weekly-csv")
    write_csv(weekly_weather(spark, folder), path)
    return with_year(read_csv(spark, path).withColumn("station", F.col("station").cast("long")))


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbls(*MEASURES)}, CAST(year(\"Date\") AS INTEGER) AS \"Year\" FROM weekly")
def partitioned_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly table to parquet with a folder per year, and back."""
    path = scratch_path(spark, "weekly-parquet")
    write_parquet(with_year(weekly_weather(spark, folder)), path, ["Year"])
    return spark.read.parquet(path)


@query(f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbl(f'\"{TARGET}\"', TARGET)} FROM weekly")
def narrow_feature_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "narrow")
    write_features(weekly_weather(spark, folder), path, ["station", "Date", TARGET, "Date"])
    return spark.read.parquet(path)


@query(
    """SELECT CAST(count(*) AS BIGINT) AS row_count,
  CAST(count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS BIGINT) AS dates,
  min(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END) AS first_date FROM orders"""
)
def lenient_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Text dates, some of which are not dates, become NULL instead of failing."""
    text = F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(
        F.col("o_orderdate").cast("date").cast("string")
    )
    parsed = read_table(spark, folder, "orders").select(text.alias("d")).select(lenient_date("d").alias("d"))
    return parsed.agg(F.count(F.lit(1)).alias("row_count"), F.count("d").alias("dates"), F.min("d").alias("first_date"))


def _range_sql(kind: str) -> str:
    parts = []
    for c, (lo, hi) in VALID_RANGES.items():
        outside = f'count(CASE WHEN "{c}" < {lo} OR "{c}" > {hi} THEN 1 END)'
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(count(*) AS BIGINT) AS total_rows,
  CAST({outside} AS BIGINT) AS out_of_range, {dbl(f'{outside} * 100.0 / count(*)', 'percentage')} FROM {kind}"""
        )
    return " UNION ALL ".join(parts)


@query(f"WITH {WEEKLY_SQL} {_range_sql('weekly')}")
def range_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.range_report(weekly_weather(spark, folder), VALID_RANGES)


@query(f"WITH {WEEKLY_SQL} {_range_sql('weekly')}")
def load_and_check(spark: SparkSession, folder: str) -> DataFrame:
    """CSV load with schema and range checks; the report is the result."""
    path = scratch_path(spark, "checked-csv")
    write_csv(weekly_weather(spark, folder), path)
    return load_with_checks(spark, path).ranges


@query(
    f"WITH {WEEKLY_SQL} "
    + " UNION ALL ".join(
        f"""SELECT {KEY}, '{c}' AS "column", {dbl(f'"{c}"', 'value')} FROM weekly WHERE "{c}" < {lo} OR "{c}" > {hi}"""
        for c, (lo, hi) in VALID_RANGES.items()
    )
)
def range_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.range_violations(weekly_weather(spark, folder), VALID_RANGES, ["station", "Date"])


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, "
    + ", ".join(
        dbl(f'CASE WHEN "{c}" < {lo} THEN {lo} WHEN "{c}" > {hi} THEN {hi} ELSE "{c}" END', c)
        for c, (lo, hi) in VALID_RANGES.items()
    )
    + " FROM weekly"
)
def clip(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clip_to_ranges(weekly_weather(spark, folder), VALID_RANGES)


@query(
    f"WITH {WEEKLY_SQL} SELECT {KEY}, {dbls(*MEASURES)} FROM weekly WHERE "
    + " AND ".join(f'"{c}" BETWEEN {lo} AND {hi}' for c, (lo, hi) in VALID_RANGES.items())
)
def drop_out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    return quality.drop_out_of_range(weekly_weather(spark, folder), VALID_RANGES)


_GAPS = f"""{WEEKLY_SQL}, gaps AS (SELECT {KEY}, """ + ", ".join(
    f'CASE WHEN "{c}" BETWEEN {lo} AND {hi} THEN "{c}" END AS "{c}"' for c, (lo, hi) in VALID_RANGES.items()
) + " FROM weekly)"


def with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_out_of_range(weekly_weather(spark, folder), VALID_RANGES)


@query(
    f"WITH {_GAPS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) - count("{c}") AS BIGINT) AS null_count FROM gaps""" for c in MEASURES
    )
)
def null_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_report(with_gaps(spark, folder), MEASURES)


@query(f"WITH {_GAPS} SELECT {KEY}, {dbls(*MEASURES)} FROM gaps WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in MEASURES))
def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return quality.drop_missing(with_gaps(spark, folder))


@query(
    f"""WITH {WEEKLY_SQL} SELECT station, CAST(count(*) AS BIGINT) AS row_count, min("Date") AS first_date,
  max("Date") AS last_date, CAST((max("Date") - min("Date")) // 7 AS BIGINT) AS expected_rows,
  {dbl('count(*) * 100.0 / nullif((max("Date") - min("Date")) // 7, 0)', 'completeness')} FROM weekly GROUP BY station"""
)
def completeness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.completeness_report(weekly_weather(spark, folder), ["station"])


def _fill_sql(aggregate: str) -> str:
    return f"WITH {_GAPS} SELECT {KEY}, " + ", ".join(
        dbl(f'coalesce("{c}", (SELECT {aggregate.format(c)} FROM gaps))', c) for c in MEASURES
    ) + " FROM gaps"


@query(_fill_sql('avg("{}")'))
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    return impute(with_gaps(spark, folder), MEASURES, "mean")


@query(_fill_sql('quantile_cont("{}", 0.5)'))
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    return impute(with_gaps(spark, folder), MEASURES, "median")


_TRAIN = """train AS (SELECT * FROM gaps WHERE "Date" < DATE '2000-01-02')"""


@query(
    f"WITH {_GAPS}, {_TRAIN} SELECT {KEY}, "
    + ", ".join(dbl(f'coalesce("{c}", (SELECT avg("{c}") FROM train))', c) for c in MEASURES)
    + " FROM gaps"
)
def impute_mean_from_train(spark: SparkSession, folder: str) -> DataFrame:
    """Means of the training period fill gaps everywhere."""
    frame = with_gaps(spark, folder)
    train = frame.filter(F.col("Date") < F.lit("2000-01-02").cast("date"))
    return impute(frame, MEASURES, "mean", fit_on=train)


@query(
    f"""WITH {_GAPS}, d AS (
  SELECT q.station, q."Date", b."Temp_avg" AS donor,
         row_number() OVER (PARTITION BY q.station, q."Date" ORDER BY
           round(sqrt(4.0 / 3.0 * (pow(q."Relative_Humidity" - b."Relative_Humidity", 2) + pow(q."Wind_kmh" - b."Wind_kmh", 2)
           + pow(q."Precipitation_mm" - b."Precipitation_mm", 2))), 9), b."Date") AS rk
  FROM gaps q JOIN gaps b ON q.station = b.station AND b."Temp_avg" IS NOT NULL WHERE q."Temp_avg" IS NULL),
f AS (SELECT station, "Date", avg(donor) AS filled FROM d WHERE rk <= 5 GROUP BY 1, 2)
SELECT g.station, g."Date", {dbl('coalesce(g."Temp_avg", f.filled)', 'Temp_avg')}, {dbls('Relative_Humidity', 'Wind_kmh', TARGET)}
FROM gaps g LEFT JOIN f ON g.station = f.station AND g."Date" = f."Date\""""
)
def impute_knn(spark: SparkSession, folder: str) -> DataFrame:
    """Five nearest rows of the same series fill a missing value."""
    return impute(with_gaps(spark, folder), MEASURES, "knn", spec=WEEKLY)


@query(
    f"""WITH {_GAPS}, {_TRAIN}, m AS (SELECT avg("Temp_avg") AS mean FROM train), d AS (
  SELECT q.station, q."Date", b."Temp_avg" AS donor,
         row_number() OVER (PARTITION BY q.station, q."Date" ORDER BY
           round(sqrt(4.0 / 3.0 * (pow(q."Relative_Humidity" - b."Relative_Humidity", 2) + pow(q."Wind_kmh" - b."Wind_kmh", 2)
           + pow(q."Precipitation_mm" - b."Precipitation_mm", 2))), 9), b."Date") AS rk
  FROM gaps q JOIN train b ON q.station = b.station AND b."Temp_avg" IS NOT NULL WHERE q."Temp_avg" IS NULL),
f AS (SELECT station, "Date", avg(donor) AS filled FROM d WHERE rk <= 5 GROUP BY 1, 2)
SELECT g.station, g."Date", {dbl('coalesce(g."Temp_avg", f.filled, mean)', 'Temp_avg')}, {dbls('Relative_Humidity', 'Wind_kmh', TARGET)}
FROM m, gaps g LEFT JOIN f ON g.station = f.station AND g."Date" = f."Date\""""
)
def impute_knn_from_train(spark: SparkSession, folder: str) -> DataFrame:
    """Only rows of the training period fill missing values, in every period."""
    frame = with_gaps(spark, folder)
    train = frame.filter(F.col("Date") < F.lit("2000-01-02").cast("date"))
    return impute(frame, MEASURES, "knn", spec=WEEKLY, fit_on=train)


def _quartiles_sql() -> str:
    return "q AS (SELECT " + ", ".join(
        f'quantile_cont("{c}", 0.25) AS "{c}_1", quantile_cont("{c}", 0.75) AS "{c}_3"' for c in MEASURES
    ) + " FROM weekly)"


def _flag_sql(c: str) -> str:
    def beyond(reach):
        return f'("{c}" < "{c}_1" - ("{c}_3" - "{c}_1") * {reach} OR "{c}" > "{c}_3" + ("{c}_3" - "{c}_1") * {reach})'

    return f"CASE WHEN {beyond(3.0)} THEN 'extreme' WHEN {beyond(1.5)} THEN 'mild' WHEN \"{c}\" IS NOT NULL THEN 'ok' END"


_FLAGS = f"{WEEKLY_SQL}, {_quartiles_sql()}, flags AS (SELECT weekly.*, " + ", ".join(
    f'{_flag_sql(c)} AS "{c}_flag"' for c in MEASURES
) + " FROM weekly, q)"


@query(f"WITH {_FLAGS} SELECT {KEY}, " + ", ".join(f'"{c}_flag"' for c in MEASURES) + " FROM flags")
def iqr_flags(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.flag_outliers(weekly_weather(spark, folder), MEASURES).drop(*MEASURES)


@query(
    f"""WITH {WEEKLY_SQL}, q AS (SELECT station, quantile_cont("{TARGET}", 0.25) AS "{TARGET}_1",
  quantile_cont("{TARGET}", 0.75) AS "{TARGET}_3" FROM weekly GROUP BY station)
SELECT weekly.station, "Date", {_flag_sql(TARGET)} AS "{TARGET}_flag" FROM weekly JOIN q ON weekly.station = q.station"""
)
def iqr_flags_by_series(spark: SparkSession, folder: str) -> DataFrame:
    frame = weekly_weather(spark, folder).select("station", "Date", TARGET)
    return outliers.flag_outliers_by_group(frame, ["station"], TARGET).drop(TARGET)


@query(
    f"WITH {_FLAGS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count("{c}") AS BIGINT) AS n,
  CAST(count(CASE WHEN "{c}_flag" = 'mild' THEN 1 END) AS BIGINT) AS mild,
  CAST(count(CASE WHEN "{c}_flag" = 'extreme' THEN 1 END) AS BIGINT) AS extreme,
  {dbl(f"count(CASE WHEN \"{c}_flag\" <> 'ok' THEN 1 END) * 100.0 / count(\"{c}\")", 'percentage')} FROM flags"""
        for c in MEASURES
    )
)
def iqr_counts(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.outlier_counts(weekly_weather(spark, folder), MEASURES)


@query(
    f"WITH {_FLAGS} SELECT {KEY}, "
    + ", ".join(
        dbl(
            f'CASE WHEN "{c}" < "{c}_1" - ("{c}_3" - "{c}_1") * 1.5 THEN "{c}_1" - ("{c}_3" - "{c}_1") * 1.5 '
            f'WHEN "{c}" > "{c}_3" + ("{c}_3" - "{c}_1") * 1.5 THEN "{c}_3" + ("{c}_3" - "{c}_1") * 1.5 ELSE "{c}" END',
            c,
        )
        for c in MEASURES
    )
    + " FROM flags, q WHERE "
    + " AND ".join(f"\"{c}_flag\" <> 'extreme'" for c in MEASURES)
)
def iqr_treatment(spark: SparkSession, folder: str) -> DataFrame:
    """Mild outliers capped, rows with an extreme one dropped."""
    return outliers.treat_outliers(weekly_weather(spark, folder), MEASURES)


@query(f"WITH {TWO_SQL} SELECT {KEY}, {dbls(*MEASURES)} FROM (SELECT * FROM first UNION SELECT * FROM second)")
def merge_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return setops.merge_sources(two_sources(spark, folder))


@query(
    f"""WITH {TWO_SQL}, m AS (SELECT * FROM first UNION SELECT * FROM second)
SELECT station, CAST(count(*) AS BIGINT) AS row_count, min("Date") AS first_date, max("Date") AS last_date,
  CAST((max("Date") - min("Date")) // 7 AS BIGINT) AS expected_rows,
  {dbl('count(*) * 100.0 / nullif((max("Date") - min("Date")) // 7, 0)', 'completeness')} FROM m GROUP BY station"""
)
def load_merge_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV files to one validated series: the completeness report of the merge."""
    paths = []
    for name, part in zip(("one", "two"), two_sources(spark, folder)):
        paths.append(scratch_path(spark, name))
        write_csv(part, paths[-1])
    report = load_and_merge(spark, paths, ["station"]).completeness
    return report.withColumn("station", F.col("station").cast("long"))


@query(
    f"""WITH {TWO_SQL}, n AS (SELECT count(*) AS n FROM (SELECT * FROM first UNION ALL SELECT * FROM second)
  GROUP BY {KEY}, {", ".join(f'"{c}"' for c in MEASURES)})
SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows FROM n"""
)
def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    return setops.duplicate_count(setops.union_rows(two_sources(spark, folder)))


@query(f'WITH {TWO_SQL} SELECT "Date" FROM first INTERSECT SELECT "Date" FROM second')
def date_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return setops.time_overlap(*two_sources(spark, folder), on=["Date"])


@query(f"WITH {TWO_SQL} SELECT {KEY}, {dbls(*MEASURES)} FROM (SELECT * FROM second EXCEPT ALL SELECT * FROM first)")
def rows_only_in_second(spark: SparkSession, folder: str) -> DataFrame:
    first, second = two_sources(spark, folder)
    return setops.rows_only_in(second, first)


@query(
    """WITH u AS (SELECT l_orderkey, l_linenumber, l_quantity, 0 AS p FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1000, 1 FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY p, l_quantity) AS rn FROM u)
SELECT l_orderkey, l_linenumber, round(l_quantity + 1e-10, 6) + 0.0 AS l_quantity FROM r WHERE rn = 1"""
)
def merge_by_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources with conflicting values per key: the first source wins where it has the key."""
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    first = items.filter("l_returnflag = 'R'").drop("l_returnflag")
    second = items.drop("l_returnflag").withColumn("l_quantity", F.col("l_quantity") + 1000)
    return setops.merge_by_priority([first, second], ["l_orderkey", "l_linenumber"])


@query(
    f"""WITH {WEEKLY_SQL} SELECT DISTINCT 'numeric' AS kind, unnest(['station', 'Temp_avg', 'Relative_Humidity',
  'Wind_kmh', 'Precipitation_mm']) AS "column" FROM weekly"""
)
def numeric_column_list(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric columns that hold data, as the model input selection sees them; flags are not numeric."""
    frame = weekly_weather(spark, folder).withColumn("flag", F.col(TEMPERATURE) > 30)
    names = quality.numeric_columns(frame)
    report = quality.unpivot_row(frame.agg(*[F.count(c).alias(f"{c}_n") for c in names]), names, {"n": "{}_n"})
    return report.filter("n > 0").select(F.lit("numeric").alias("kind"), "column")


@query(
    """WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders)
SELECT CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS n, round(sum(o_totalprice) + 1e-6, 2) + 0.0 AS total,
  CAST(0 AS BIGINT) AS files_out_of_order, (SELECT count(*) FROM b) AS manifest_rows FROM b WHERE d BETWEEN DATE '1995-03-01' AND DATE '1996-10-31'
GROUP BY 1""",
    digits=2,
)
def ordered_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written in order, and a range of days read back by the manifest, with a count of files that overlap."""
    path = scratch_path(spark, "ordered")
    rows = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    write_ordered(rows, path, ["day", "o_orderkey"], rows_per_file=4000)
    files = read_manifest(spark, path)
    after = files.select((F.col("position") - 1).alias("position"), F.col("first").alias("next"))
    wrong = files.join(after, "position").filter("last >= next").agg(F.count(F.lit(1))).scalar()
    found = read_range(spark, path, [date(1995, 3, 1)], [date(1996, 10, 31)])
    months = found.groupBy(F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return months.withColumns({"files_out_of_order": wrong, "manifest_rows": files.agg(F.sum("rows")).scalar()})


@query(
    f"""SELECT l_returnflag, count(*) AS all_rows, count(q) AS with_value, {dbl('avg(q)', 'mean')}
FROM (SELECT l_returnflag, CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity END AS q FROM lineitem) GROUP BY 1"""
)
def nan_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """NaN in a parquet table is NULL once it is read."""
    path = scratch_path(spark, "nan")
    quantity = F.when(F.col("l_quantity") > 40, float("nan")).otherwise(F.col("l_quantity")).alias("q")
    read_table(spark, folder, "lineitem").select("l_returnflag", quantity).write.parquet(f"{path}/items.parquet")
    return read_table(spark, path, "items").groupBy("l_returnflag").agg(
        F.count("*").alias("all_rows"), F.count("q").alias("with_value"), F.avg("q").alias("mean")
    )
