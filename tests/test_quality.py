import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from seriesforge.operators import imputation, outliers, quality, setops
from seriesforge.sources import readers, writers
from seriesforge.sources.ordered import read_manifest, read_range, write_ordered
from seriesforge.specs import MEASURES, VALID_RANGES, PreprocessSpec, SeriesSpec

RANGES = {"temp": (20.0, 50.0), "humidity": (0.0, 100.0), "precipitation": (0.0, 50.0)}


def frame(spark, temp0=25.0, humidity1=55.0, rain0=0.0):
    rows = [
        (temp0, 50.0, rain0),
        (30.0, humidity1, 5.0),
        (35.0, 60.0, 10.0),
        (40.0, 65.0, 15.0),
        (45.0, 70.0, 20.0),
    ]
    return spark.createDataFrame(rows, "temp double, humidity double, precipitation double")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_clip_to_bounds(spark):
    clipped = quality.clip_to_ranges(frame(spark, temp0=10.0, humidity1=110.0), RANGES)
    assert 20.0 in column(clipped, "temp") and 10.0 not in column(clipped, "temp")
    assert 100.0 in column(clipped, "humidity")


def test_null_survives_clipping_and_is_not_out_of_range(spark):
    df = frame(spark, rain0=None)
    assert column(quality.clip_to_ranges(df, RANGES), "precipitation").count(None) == 1
    assert {r["column"]: r["out_of_range"] for r in quality.range_report(df, RANGES).collect()}["precipitation"] == 0


def test_mean_imputation_uses_the_present_values(spark):
    assert 12.5 in column(imputation.impute(frame(spark, rain0=None), ["precipitation"]), "precipitation")


def test_median_drop_and_unknown_imputation(spark):
    df = frame(spark, rain0=None)
    assert 12.5 in column(imputation.impute(df, ["precipitation"], "median"), "precipitation")
    assert imputation.impute(df, ["precipitation"], "drop").count() == 4
    with pytest.raises(ValueError):
        imputation.impute(df, ["precipitation"], "guess")


def test_config_requires_ranges_and_method():
    with pytest.raises(ValueError):
        PreprocessSpec.from_config({"imputation_method": "mean"})
    with pytest.raises(ValueError):
        PreprocessSpec.from_config({"valid_ranges": {"temperature": [20, 35]}})
    spec = PreprocessSpec.from_config({"valid_ranges": {"temperature": [20, 35]}, "imputation_method": "mean"})
    assert spec.ranges == {"Temp_avg": (20.0, 35.0)}


def test_violations_report_and_drop(spark):
    df = frame(spark, temp0=10.0).withColumn("Date", F.lit("2020-01-05").cast("date"))
    found = quality.range_violations(df, RANGES).collect()
    assert [(r["column"], r["value"]) for r in found] == [("temp", 10.0)]
    assert quality.drop_out_of_range(df, RANGES).count() == 4


def test_schema_check(weather):
    assert quality.check_schema(weather).extra == ("station",)
    report = quality.check_schema(weather.drop("Wind_kmh"))
    assert report.missing == ("Wind_kmh",) and not report.valid


def test_numeric_columns_exclude_booleans(weather):
    df = weather.withColumn("flag", F.col("Temp_avg") > 29)
    assert "flag" not in quality.numeric_columns(df) and "Temp_avg" in quality.numeric_columns(df)


def test_completeness_keeps_the_fencepost(weather):
    row = quality.completeness_report(weather).first()
    assert row["row_count"] == 10 and row["expected_rows"] == 9
    assert row["completeness"] == pytest.approx(1000 / 9)


def test_completeness_of_a_single_row(weather):
    assert quality.completeness_report(weather.limit(1)).first()["completeness"] is None


def test_merge_with_itself(weather):
    assert setops.duplicate_count(setops.union_rows([weather, weather])).first()[0] == 20
    assert setops.time_overlap(weather, weather, ["Date"]).count() == 10
    assert setops.merge_sources([weather, weather]).count() == 10
    assert setops.rows_only_in(weather, weather).count() == 0


def test_merge_treats_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b double")
    assert setops.merge_sources([df, df]).count() == 1


def test_priority_merge_prefers_the_first_source(spark):
    a = spark.createDataFrame([(1, 10.0)], "k int, v double")
    b = spark.createDataFrame([(1, 99.0), (2, 20.0)], "k int, v double")
    assert sorted(tuple(r) for r in setops.merge_by_priority([a, b], ["k"]).collect()) == [(1, 10.0), (2, 20.0)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert readers.normalise_nan(df).filter("x IS NULL").count() == 1


def test_csv_round_trip_and_year(spark, weather, tmp_path):
    path = str(tmp_path / "w")
    writers.write_csv(weather.drop("station"), path)
    loaded = readers.load_with_checks(spark, path)
    assert loaded.schema_report.valid and loaded.rows.count() == 10
    assert {r["Year"] for r in loaded.rows.select("Year").distinct().collect()} == {2020}
    assert sorted(column(loaded.rows, "Precipitation_mm")) == sorted(column(weather, "Precipitation_mm"))


def test_missing_file_and_missing_column(spark, weather, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, str(tmp_path / "nothing")).count()
    path = str(tmp_path / "short")
    writers.write_csv(weather.drop("station", "Wind_kmh"), path)
    with pytest.raises(ValueError):
        readers.load_with_checks(spark, path)


def test_malformed_dates(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.createDataFrame([("2020-01-05", 1.0), ("soon", 2.0)], "Date string, Temp_avg double").write.option(
        "header", True
    ).csv(path)
    lenient = readers.read_csv(spark, path, strict_dates=False)
    assert lenient.filter("Date IS NULL").count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_csv(spark, path).collect()


def test_load_and_merge(spark, weather, tmp_path):
    paths = [str(tmp_path / n) for n in ("a", "b")]
    for p in paths:
        writers.write_csv(weather.drop("station"), p)
    merged = readers.load_and_merge(spark, paths)
    assert merged.rows.count() == 10 and merged.completeness.first()["row_count"] == 10


def test_result_tables_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("knn", 1.5)], "model string, MAE double")
    writers.write_csv(table, str(tmp_path / "m"))
    table.write.json(str(tmp_path / "j"))
    for name, form in (("m", "csv"), ("j", "json")):
        assert readers.read_results(spark, str(tmp_path / name), "model string, MAE double", form).first()["MAE"] == 1.5
    extra = spark.createDataFrame([("arima", 0.4)], "model string, AUC_ROC double")
    combined = writers.append_metrics(table, extra)
    assert combined.columns == ["model", "MAE", "AUC_ROC"] and combined.count() == 2
    assert writers.append_metrics(None, extra) is extra


def test_outlier_flags_and_treatment(spark):
    values = [float(v) for v in range(1, 21)] + [36.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    flags = {r["x"]: r["x_flag"] for r in outliers.flag_outliers(df, ["x"]).collect()}
    assert flags[36.0] == "mild" and flags[100.0] == "extreme" and flags[10.0] == "ok"
    counts = outliers.outlier_counts(df, ["x"]).first()
    assert (counts["mild"], counts["extreme"]) == (1, 1)
    treated = column(outliers.treat_outliers(df, ["x"]), "x")
    assert len(treated) == 21 and max(treated) < 36


def test_outlier_flags_per_group(spark):
    rows = [("a", float(v)) for v in range(10)] + [("a", 50.0), ("b", 50.0), ("b", 51.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    flags = {(r["k"], r["x"]): r["x_flag"] for r in outliers.flag_outliers_by_group(df, ["k"], "x").collect()}
    assert flags[("a", 50.0)] == "extreme" and flags[("b", 50.0)] == "ok"


def test_null_report(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None), (None, None)], "a double, b double")
    assert {r["column"]: r["null_count"] for r in quality.null_report(df).collect()} == {"a": 2, "b": 2}


def test_knn_imputation_against_brute_force(spark, sunday):
    import numpy as np

    source = np.random.default_rng(5)
    data = source.uniform(0, 10, (60, 4)).round(3)
    holes = source.random((60, 4)) < 0.15
    data[holes] = np.nan
    data[7] = np.nan
    rows = [
        (i % 2, sunday[i // 2], *[None if np.isnan(v) else float(v) for v in data[i]]) for i in range(60)
    ]
    schema = "station int, Date date, " + ", ".join(f"{c} double" for c in MEASURES)
    df = spark.createDataFrame(rows, schema)
    means = np.nanmean(data, axis=0)
    expected = {}
    for i in range(60):
        own = [j for j in range(i % 2, 60, 2)]
        for c in range(4):
            value = data[i, c]
            if np.isnan(value):
                scored = []
                for j in own:
                    both = ~np.isnan(data[i]) & ~np.isnan(data[j])
                    if np.isnan(data[j, c]) or not both.any():
                        continue
                    d = np.sqrt(4 / both.sum() * ((data[i] - data[j])[both] ** 2).sum())
                    scored.append((round(d, 9), j, data[j, c]))
                value = np.mean([v for _, _, v in sorted(scored)[:5]]) if scored else means[c]
            expected[(i % 2, sunday[i // 2], c)] = value
    regular = SeriesSpec(keys=("station",))
    sliced = SeriesSpec(keys=("station",), regular=False)
    from seriesforge.models.neighbors import impute_from_neighbours

    for filled in (
        imputation.impute(df, MEASURES, "knn", spec=regular),
        impute_from_neighbours(df, sliced, MEASURES, chunk_rows=7),
    ):
        got = filled.collect()
        assert len(got) == 60
        for r in got:
            for c, name in enumerate(MEASURES):
                assert r[name] == pytest.approx(expected[(r["station"], r["Date"], c)])


def test_valid_ranges_cover_the_measures():
    assert set(VALID_RANGES) == set(MEASURES)


def test_partitioned_sink_prunes_years(spark, weather, tmp_path):
    import io
    from contextlib import redirect_stdout

    path = str(tmp_path / "years")
    writers.write_parquet(readers.with_year(weather), path, ["Year"])
    back = spark.read.parquet(path).filter("Year = 2020")
    text = io.StringIO()
    with redirect_stdout(text):
        back.explain("formatted")
    assert back.count() == 10 and "PartitionFilters: [isnotnull(Year" in text.getvalue()


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from seriesforge.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
    cluster.conf = SimpleNamespace(get=lambda key, default=None: "hdfs:///shared")
    assert shared_dir(cluster) == "hdfs:///shared"


def test_ordered_sink(spark, tmp_path):
    """Files disjoint and ordered, rows ordered inside; a hot day spreads over files; ranges open only their files."""
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=0 if i % 3 else i % 50), i, float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "day date, id int, x double").repartition(5)
    path = str(tmp_path / "o")
    write_ordered(df, path, ["day", "id"], rows_per_file=60)
    files = sorted(read_manifest(spark, path).collect(), key=lambda r: r["position"])
    assert len(files) > 5 and sum(r["rows"] for r in files) == 600
    assert all(a["last"] < b["first"] for a, b in zip(files, files[1:]))
    everything = []
    for r in files:
        own = [(x["day"], x["id"]) for x in spark.read.parquet(f"{path}/rows/{r['file']}").coalesce(1).collect()]
        assert own == sorted(own) and len(own) == r["rows"]
        everything += own
    assert everything == sorted((d, i) for d, i, _ in rows)
    low, high = dt.date(2020, 1, 10), dt.date(2020, 1, 20)
    got = sorted(x["id"] for x in read_range(spark, path, [low], [high]).collect())
    assert got == sorted(i for d, i, _ in rows if low <= d <= high)
    assert read_range(spark, path, [dt.date(2030, 1, 1)]).count() == 0
    assert read_range(spark, path).count() == 600
