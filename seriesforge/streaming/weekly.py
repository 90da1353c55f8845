"""Streaming forms: weekly resampling with late data, and stateless cleaning and scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators.quality import clip_to_ranges
from seriesforge.session import scratch_path
from seriesforge.sources.readers import normalise_nan
from seriesforge.specs import TIME

MONDAY_OFFSET = "4 days"  # windows count from a Thursday


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream, with the schema of the files already there and NaN as NULL.

    A stream reads folders only: a single file is the one of its name in its folder.
    """
    there = spark.read.parquet(path)
    reader = spark.readStream.schema(there.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    single = there.select("_metadata.file_path").limit(1).collect()
    if single and single[0][0].rpartition("/")[2] == name:
        literal = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in name)
        return normalise_nan(reader.option("pathGlobFilter", literal).parquet(folder or "/"))
    return normalise_nan(reader.parquet(path))


def weekly_stream(
    stream: DataFrame, keys: Sequence[str], time: str, measures: Sequence[Column], delay: str = "1 day"
) -> DataFrame:
    """One row per series and Monday-to-Sunday week, emitted once no row within ``delay`` can change it.

    State is one partial aggregate per open (series, week).
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    week = F.window(time, "7 days", startTime=MONDAY_OFFSET)
    weekly = timed.groupBy(week, *keys).agg(*measures)
    label = F.date_sub(F.col("window.end").cast("date"), 1).alias(TIME)
    return weekly.select(*keys, label, *[c for c in weekly.columns if c not in ("window", *keys)])


@dataclass(frozen=True)
class CorrectedWeeks:
    """Every week with its sums and its late rows, the late rows of each trigger, and how many rows arrived."""

    weeks: DataFrame
    late: DataFrame
    arrived: int


def correcting_weeks(
    stream: DataFrame, keys: Sequence[str], time: str, sums: dict[str, Column], path: str, delay: str = "1 day"
) -> CorrectedWeeks:
    """Weekly sums of a stream that lose no row, however late it comes.

    Each trigger writes the sums of its rows per series and week, under its own number, so a trigger
    that runs again overwrites what it wrote.  A row is late if its week had ended ``delay`` before the latest
    time that earlier triggers have seen; late rows are counted per trigger and week and correct their
    week.  The closing pass adds up the parts of every week, open ones included: one partial sum per
    trigger, series and week.
    """
    keys = list(keys)
    spark = stream.sparkSession
    week = F.window(time, "7 days", startTime=MONDAY_OFFSET)
    label = F.date_sub(F.col("window.end").cast("date"), 1).alias(TIME)

    def seen_before(batch: int):
        parts = [f"{path}/seen/trigger={i}" for i in range(batch)]
        known = [r for r in (spark.read.parquet(p).first() for p in parts[-1:]) if r]
        return known[0]["latest"] if known else None

    def take(rows: DataFrame, batch: int) -> None:
        timed = rows.withColumn(time, F.col(time).cast("timestamp"))
        latest = seen_before(batch)
        closed = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.count_if(F.coalesce(F.col("window.end") <= closed, F.lit(False)))
        named = timed.select(*keys, week.alias("window"), *[c.alias(n) for n, c in sums.items()])
        added = named.groupBy("window", *keys).agg(*[F.sum(n).alias(n) for n in sums], F.count(F.lit(1)).alias("_rows"), late.alias("late_rows"))
        added.select(*keys, label, *sums, "_rows", "late_rows").write.mode("overwrite").parquet(f"{path}/parts/trigger={batch}")
        newest = F.greatest(F.max(time), F.lit(latest).cast("timestamp")).alias("latest")
        timed.agg(newest).write.mode("overwrite").parquet(f"{path}/seen/trigger={batch}")

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    parts = spark.read.parquet(f"{path}/parts")
    weeks = parts.groupBy(*keys, TIME).agg(*[F.sum(n).alias(n) for n in sums], F.sum("late_rows").alias("late_rows"))
    late = parts.groupBy("trigger").agg(F.sum("late_rows").alias("late_rows"), F.sum("_rows").alias("rows"))
    return CorrectedWeeks(weeks, late, parts.agg(F.sum("_rows")).first()[0] or 0)


def clip_stream(stream: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return clip_to_ranges(stream, ranges)


def score_stream(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions of a saved model, row by row as they arrive."""
    return model.transform(stream)


def drain(result: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available now into parquet files, exactly once across restarts."""
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_table(spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stream ``source`` through ``transform`` into the shared folder and return the written table."""
    path = scratch_path(spark, "stream")
    drain(transform(read_stream(spark, source)), f"{path}/rows", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows")
