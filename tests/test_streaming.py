import datetime as dt

from pyspark.sql import functions as F

from seriesforge.models import linear, training
from seriesforge.sources.readers import read_table
from seriesforge.streaming import weekly

from tests.conftest import SF


def test_weekly_stream_emits_closed_weeks_once(spark, tmp_path):
    source = str(tmp_path / "in")
    monday = dt.datetime(2024, 1, 1)
    first = [(1, monday + dt.timedelta(days=d), 1.0) for d in (0, 3, 6, 9)]
    spark.createDataFrame(first, "k int, ts timestamp, value double").write.parquet(source)
    measures = [F.sum("value").alias("total")]

    def run():
        stream = weekly.read_stream(spark, source)
        weekly.drain(weekly.weekly_stream(stream, ["k"], "ts", measures), str(tmp_path / "out"), str(tmp_path / "cp"))
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))

    assert run() == [(1, dt.date(2024, 1, 7), 3.0)]
    later = [(1, monday + dt.timedelta(days=d), 1.0) for d in (10, 20)] + [(1, monday, 100.0)]
    spark.createDataFrame(later, "k int, ts timestamp, value double").write.mode("append").parquet(source)
    # The week already emitted does not change; the late row is beyond the watermark.
    assert run() == [(1, dt.date(2024, 1, 7), 3.0), (1, dt.date(2024, 1, 14), 2.0)]


def test_stream_clip_and_score(spark):
    table = read_table(spark, SF, "events").select("event_id", "value", (F.col("value") * 2 + 1).alias("y"))
    models = training.train_all(table, ["value"], "y", {"lr": linear.linear_estimator("y")})
    scored = weekly.run_to_table(
        spark,
        f"{SF}/events.parquet",
        lambda s: weekly.score_stream(weekly.clip_stream(s.select("event_id", "value"), {"value": (5.0, 50.0)}), models.models["lr"]),
    )
    assert scored.count() == table.count()
    low, high = scored.agg(F.min("value"), F.max("value")).first()
    assert low >= 5 and high <= 50
    assert scored.filter(F.abs(F.col("y_pred") - F.col("value") * 2 - 1) > 1e-6).count() == 0


def test_stream_reads_one_table_only(spark, tmp_path):
    """Neither siblings whose names begin alike nor other files of the folder; NaN becomes NULL."""
    import shutil

    for name, n in (("events", 3), ("other", 5)):
        spark.range(n).selectExpr("id", "double('NaN') AS x").coalesce(1).write.parquet(str(tmp_path / f"w-{name}"))
        (part,) = (tmp_path / f"w-{name}").glob("part-*.parquet")
        shutil.copy(part, tmp_path / ("events.parquet" if name == "events" else "events.parquet_old"))
    spark.range(7).write.parquet(str(tmp_path / "folder.parquet"))
    spark.range(9).write.parquet(str(tmp_path / "folder.parquet_old"))
    rows = weekly.run_to_table(spark, str(tmp_path / "events.parquet"), lambda s: s).collect()
    assert len(rows) == 3 and all(r["x"] is None for r in rows)
    assert weekly.run_to_table(spark, str(tmp_path / "folder.parquet"), lambda s: s).count() == 7


def test_late_rows_correct_their_weeks(spark, tmp_path):
    """Rows out of order over several triggers; a restart takes up new files only; a repeated trigger changes nothing."""
    source, path = str(tmp_path / "in"), str(tmp_path / "weeks")
    monday = dt.datetime(2024, 1, 1)
    sums = {"total": F.col("value"), "n": F.lit(1).cast("long")}

    def add(days, k=1):
        rows = [(k, monday + dt.timedelta(days=d), 1.0 + d) for d in days]
        spark.createDataFrame(rows, "k int, ts timestamp, value double").coalesce(1).write.mode("append").parquet(source)

    def run():
        return weekly.correcting_weeks(weekly.read_stream(spark, source, files_per_trigger=1), ["k"], "ts", sums, path, "1 day")

    add([0, 9, 20])
    first = run()
    assert first.arrived == 3 and first.weeks.agg(F.sum("late_rows")).first()[0] == 0
    add([1, 2, 30], k=1)
    add([3, 31], k=2)
    second = run()
    got = {(r["k"], r["Date"]): (r["total"], r["n"], r["late_rows"]) for r in second.weeks.collect()}
    sundays = [dt.date(2024, 1, 7) + dt.timedelta(weeks=w) for w in range(5)]
    # Days 1, 2 and 3 lie in the first week, which had ended a day before the latest time seen.
    assert got[(1, sundays[0])] == (1 + 2 + 3, 3, 2) and got[(2, sundays[0])] == (4, 1, 1)
    assert got[(1, sundays[1])] == (10, 1, 0) and got[(1, sundays[4])] == (31, 1, 0) and got[(2, sundays[4])] == (32, 1, 0)
    assert second.arrived == 8 and sum(n for _, n, _ in got.values()) == 8
    assert {r["trigger"]: r["rows"] for r in second.late.collect()} == {0: 3, 1: 3, 2: 2}
    assert {tuple(r) for r in run().weeks.collect()} == {tuple(r) for r in second.weeks.collect()}
