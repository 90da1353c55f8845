import datetime as dt
import math

import pytest

from seriesforge.session import local_session
from seriesforge.specs import SeriesSpec

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sunday():
    return [dt.date(2020, 1, 5) + dt.timedelta(weeks=i) for i in range(200)]


@pytest.fixture(scope="session")
def weather(spark, sunday):
    """Ten weekly rows of one station: slow waves of different phase around a mean."""

    def wave(mean, height, phase):
        return [round(mean + height * math.sin(0.55 * week + phase), 2) for week in range(10)]

    columns = (wave(29, 1.7, 0.2), wave(78, 6, 1.0), wave(11, 4, 2.1), wave(4.6, 4, 0.7))
    rows = [(1, d, *values) for d, *values in zip(sunday, *columns)]
    return spark.createDataFrame(
        rows,
        "station int, Date date, Temp_avg double, Relative_Humidity double, Wind_kmh double, Precipitation_mm double",
    )


@pytest.fixture(scope="session")
def by_station():
    return SeriesSpec(keys=("station",))
