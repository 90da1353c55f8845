"""The series the registered queries work on, and the SQL that defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators.resample import resample_weekly, weather_measures
from seriesforge.sources.readers import read_table
from seriesforge.specs import SeriesSpec

WEEKLY = SeriesSpec(keys=("station",))
# Small cells and blocks let small data meet their borders.
ORDER_DAYS = SeriesSpec(time="o_orderdate", tie=("o_orderkey",), cell_rows=20_000, block_rows=4096)
EVENTS = SeriesSpec(keys=("user_id",), time="ts", tie=("event_id",), regular=False, cell_rows=20_000, block_rows=64)


def weekly_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly weather-shaped measures per supplier ("station"), derived from line items."""
    items = read_table(spark, folder, "lineitem").withColumnRenamed("l_suppkey", "station")
    weekly = resample_weekly(
        items,
        ["station"],
        "l_shipdate",
        weather_measures(
            F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")
        ),
    )
    return weekly.select(
        "station",
        "Date",
        (F.lit(15) + F.col("Temp_avg") / 4000).alias("Temp_avg"),
        F.round(F.col("Relative_Humidity") * 1000, 6).alias("Relative_Humidity"),
        (F.col("Wind_kmh") * 100).alias("Wind_kmh"),
        "Precipitation_mm",
    )


WEEKLY_SQL = """weekly AS (
  SELECT l_suppkey AS station,
         CAST(CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS DATE) AS "Date",
         15 + avg(l_extendedprice) / 4000 AS "Temp_avg",
         round(avg(l_discount) * 1000, 6) AS "Relative_Humidity",
         avg(l_tax) * 100 AS "Wind_kmh",
         sum(l_quantity) AS "Precipitation_mm"
  FROM lineitem GROUP BY 1, 2)"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as one series without a key, any number of rows per day."""
    table = read_table(spark, folder, "orders")
    return table.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")


ORDERS_SQL = "o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders)"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as series of unbounded length per user."""
    return read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
