"""Time text, file formats, the month shift, and the bronze split."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationflow.functions import timetext as tt
from stationflow.operators import stations, trips
from tests.conftest import rows

RAW = [
    ("2021-01-02 03:04:05.678", "2021-01-02 03:10:00.100", "A", 40.1, -73.1, "B", 40.2, -73.2, 1, 2, 1, 0, "/x/202101-t.csv"),
    ("2021-01-20 08:00:00.000", "2021-01-20 08:10:00.000", None, None, None, "B", 40.2, -73.2, None, 2, 0, 1, "/x/202101-t.csv"),
    ("1/1/2015 0:01", "1/1/2015 0:07", "A", 40.1, -73.1, "C", 40.3, -73.3, 1, 3, 1, 2, "/x/201501-t.csv"),
    ("1/1/2015 0:02", "1/1/2015 0:09", "A", 40.0, -73.0, "C", 40.3, -73.3, 1, 3, 1, 3, "/x/201501-t.csv"),
    ("9/1/2014 00:00:25", "9/1/2014 00:05:00", "D", 40.4, -73.4, "A", 40.1, -73.1, 4, 1, 1, 4, "/x/201409-t.csv"),
    ("9/1/2014 00:01:00", "9/1/2014 00:06:00", "D", 40.4, -73.4, None, None, None, 4, None, 1, 5, "/x/201409-t.csv"),
]
RAW_SCHEMA = """start_time string, end_time string, start_station_name string, start_station_latitude float,
    start_station_longitude float, end_station_name string, end_station_latitude float,
    end_station_longitude float, start_station_id int, end_station_id int, member int,
    row_number long, file_path string"""


@pytest.fixture
def raw(spark):
    return trips.with_file_name(spark.createDataFrame(RAW, RAW_SCHEMA))


@pytest.mark.parametrize(
    "path, name",
    [("s3://b/x/201501-t.csv", "201501-t.csv"), ("201501-t.csv", "201501-t.csv"), ("/a/b/", ""), (None, None)],
)
def test_file_name(spark, path, name):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(tt.file_name_of(F.col("p"))).first()[0] == name


@pytest.mark.parametrize("fmt", tt.TIME_FORMATS, ids=lambda f: f.name)
def test_two_rows_of_each_format(raw, fmt):
    assert trips.rows_of_format(raw, fmt).count() == 2


@pytest.mark.parametrize(
    "fmt, parsed", [(tt.ISO_SECONDS, 2), (tt.US_MINUTES, 4), (tt.US_SECONDS, 2)], ids=lambda v: str(v)[:12]
)
def test_whole_frame_with_one_format(raw, fmt, parsed):
    df = trips.parse_all_as(raw, fmt)
    assert dict(df.dtypes)["start_time"] == dict(df.dtypes)["end_time"] == "timestamp"
    assert df.dropna(subset=["start_time", "end_time"]).count() == parsed


def test_every_month_has_exactly_one_format(spark):
    months = [f"{y}{m:02d}-t.csv" for y in range(2013, 2030) for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "file_name string")
    flags = [tt.has_prefix(F.col("file_name"), f.file_prefixes).cast("int") for f in tt.TIME_FORMATS]
    assert {r[0] for r in df.select(sum(flags[1:], flags[0])).collect()} == {1}


def test_parse_by_file(raw):
    got = {r.row_number: (r.start_time, r.end_time) for r in trips.parse_trip_times(raw).collect()}
    assert got[0] == (datetime(2021, 1, 2, 3, 4, 5), datetime(2021, 1, 2, 3, 10))
    assert got[2] == (datetime(2015, 1, 1, 0, 1), datetime(2015, 1, 1, 0, 7))
    assert got[4] == (datetime(2014, 9, 1, 0, 0, 25), datetime(2014, 9, 1, 0, 5))
    assert len(got) == 6


@pytest.mark.parametrize(
    "text, fmt, expected",
    [
        ("2021-1-5 1:2:3", tt.ISO_SECONDS, datetime(2021, 1, 5, 1, 2, 3)),
        (" 2021-01-05 01:02:03 trailing", tt.ISO_SECONDS, datetime(2021, 1, 5, 1, 2, 3)),
        ("2021-01-05 01:02:03.123456789", tt.ISO_SECONDS, datetime(2021, 1, 5, 1, 2, 3)),
        ("2021-01-05 01:02:034", tt.ISO_SECONDS, None),
        ("2021-13-05 01:02:03", tt.ISO_SECONDS, None),
        ("2021-02-30 01:02:03", tt.ISO_SECONDS, None),
        ("2021-01-05 24:00:00", tt.ISO_SECONDS, None),
        ("2021-01-05", tt.ISO_SECONDS, None),
        ("           12:34:56", tt.ISO_SECONDS, None),
        ("1/5/2021 1:02", tt.ISO_SECONDS, None),
        ("", tt.ISO_SECONDS, None),
        (None, tt.ISO_SECONDS, None),
        ("12/31/2015 23:59", tt.US_MINUTES, datetime(2015, 12, 31, 23, 59)),
        ("1/1/2015 0:01:59", tt.US_MINUTES, datetime(2015, 1, 1, 0, 1)),
        ("2021-01-05 01:02:03", tt.US_MINUTES, None),
        ("13/1/2015 0:01", tt.US_MINUTES, None),
        ("9/1/2014 00:00", tt.US_SECONDS, None),
        ("9/1/2014 00:00:25.7", tt.US_SECONDS, datetime(2014, 9, 1, 0, 0, 25)),
        ("unknown\n9/1/2014 00:00:25", tt.US_SECONDS, None),
    ],
)
def test_time_text(spark, text, fmt, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tt.parse_time(F.col("t"), fmt)).first()[0] == expected


def test_unmatched_files_are_dropped_and_counted(spark, raw):
    odd = raw.withColumn("file_name", F.lit("JC-202101-t.csv"))
    both = raw.unionByName(odd)
    assert trips.parse_trip_times(both).count() == 6
    assert rows(trips.unmatched_files(both)) == [("JC-202101-t.csv", 6)]


@pytest.mark.parametrize(
    "time, file_name, default, kept",
    [
        ("2021-07-31 17:05:06", "202108-t.csv", "2021-08-31 00:00:00", "2021-08-31 17:05:06"),
        ("2021-07-31 17:05:06", "202107-t.csv", "2021-07-31 17:05:06", "2021-07-31 17:05:06"),
        ("2021-08-01 17:05:06", "202108-t.csv", "2021-08-01 17:05:06", "2021-08-01 17:05:06"),
        ("2020-07-31 17:05:06", "202108-t.csv", "2020-07-31 17:05:06", "2020-07-31 17:05:06"),
        (None, "202108-t.csv", None, None),
    ],
)
def test_month_shift(spark, time, file_name, default, kept):
    df = spark.createDataFrame([(time, time, file_name)], "start_time string, end_time string, file_name string")
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in ("start_time", "end_time")})
    for preserve, expected in ((False, default), (True, kept)):
        got = trips.repair_shifted_months(df, preserve).first()
        expected = expected and datetime.fromisoformat(expected)
        assert (got.start_time, got.end_time) == (expected, expected)


def test_one_pass_equals_three_slices(spark, sf_dir):
    from stationflow.sources import testbed

    raw = trips.with_file_name(testbed.raw(spark, sf_dir))
    slices = [
        trips.repair_shifted_months(trips.parse_all_as(trips.rows_of_format(raw, f), f)) for f in tt.TIME_FORMATS
    ]
    three = slices[0].unionByName(slices[1]).unionByName(slices[2])
    one = trips.parse_trip_times(raw)
    assert one.exceptAll(three.select(one.columns)).isEmpty()
    assert three.select(one.columns).exceptAll(one).isEmpty()


def test_bronze_and_stations(raw):
    kept = trips.drop_without_station(trips.parse_trip_times(raw))
    fact = trips.trip_fact(kept)
    assert set(fact.columns) == {"start_time", "end_time", "row_number", "start_station_id", "end_station_id"}
    assert sorted(r.row_number for r in fact.collect()) == [0, 2, 3, 4]
    dim = stations.station_dimension(stations.station_observations(kept))
    assert dim.columns == ["id", "name", "latitude", "longitude"]
    got = {r.id: (r.name, round(r.latitude, 3), round(r.longitude, 3)) for r in dim.collect()}
    assert got == {1: ("A", 40.0, -73.1), 2: ("B", 40.2, -73.2), 3: ("C", 40.3, -73.3), 4: ("D", 40.4, -73.4)}


def test_station_representatives(spark):
    seen = spark.createDataFrame(
        [(1, "B", 1.0, 9.0), (1, "A", 5.0, 2.0), (1, "A", 5.0, 1.0), (1, None, 0.0, 0.0), (2, None, None, None)],
        "id int, name string, latitude float, longitude float",
    )
    assert rows(stations.station_dimension(seen)) == [(1, "A", 0.0, 0.0), (2, None, None, None)]
    assert rows(stations.station_dimension(seen, "row")) == [(1, "A", 5.0, 1.0), (2, None, None, None)]
    with pytest.raises(ValueError):
        stations.station_dimension(seen, "other")


def test_station_lookup_takes_the_lowest_id_of_a_name(spark):
    table = spark.createDataFrame(
        [(7, "A", 1.0, 1.0), (3, "A", 2.0, 2.0), (5, "B", 3.0, 3.0)],
        "id int, name string, latitude float, longitude float",
    )
    asked = spark.createDataFrame([(1, "A"), (2, "B"), (3, "nowhere")], "req int, station_name string")
    got = stations.lookup_by_name(asked, stations.station_points(table))
    assert rows(got, "req", "station_id", "latitude") == [(1, 3, 2.0), (2, 5, 3.0)]
