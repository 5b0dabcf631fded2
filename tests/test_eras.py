"""CSV scans and the harmonised trip table."""

import math

from pyspark.sql import functions as F

from stationflow.functions.numeric import round_half_even, truncate_to_int
from stationflow.operators.harmonize import combine_eras, harmonize
from stationflow.sources.eras import ERA_1, ERA_2, TRIP_COLUMNS, scan_both_eras, scan_csv
from stationflow.sources.tables import read_table, write_table

ERA_1_TEXT = """a,b,c,d,e,f,g,h,i,j,k,l,m,n,o
615,2019-02-01 06:30:00.1234,2019-02-01 06:40:15.5678,3494.0,Harbour,40.25,-73.5,3501.0,Market,40.5,-73.25,77,Subscriber,1971,1
300,2019-02-01 00:10:00,2019-02-01 00:15:00,SYS033,Depot,40.1,-73.1,3501.0,Market,40.5,-73.25,1,Customer,1990,2
300,2019-02-01 00:20:00,2019-02-01 00:25:00,3494.0,Harbour,40.25,-73.5,,,,,2,,1990,0
"""
ERA_2_TEXT = """ride_id,rideable_type,started_at,ended_at,ssn,ssi,esn,esi,a,b,c,d,member_casual
X1,electric_bike,2023-09-16 14:00:00.500,2023-09-16 14:20:00.250,A,4810.8799,B,5177.06,40.7,-73.9,40.8,-73.8,casual
X2,classic_bike,2023-09-16 15:00:00.000,2023-09-16 15:10:00.000,A,4810.88,B,5177.6,40.7,-73.9,40.8,-73.8,member
X3,classic_bike,2023-09-16 16:00:00.000,2023-09-16 16:10:00.000,A,4810.88,B,5177.6,40.7,-73.9,40.8,-73.8,
"""


def write(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_era_1_schema_is_positional_and_lenient(spark, tmp_path):
    df = scan_csv(spark, write(tmp_path, "201902-trips", ERA_1_TEXT), ERA_1)
    assert df.columns[3] == "start station id" and len(df.columns) == 15
    assert [r[0] for r in df.select("`start station id`").collect()] == [3494.0, None, 3494.0]


def test_harmonize_era_1(spark, tmp_path):
    df = harmonize(scan_csv(spark, write(tmp_path, "201902-trips", ERA_1_TEXT), ERA_1), ERA_1)
    assert tuple(df.columns) == TRIP_COLUMNS
    assert df.schema["start_station_id"].dataType.simpleString() == "int"
    got = [(r.start_station_id, r.end_station_id, r.member) for r in df.collect()]
    assert got == [(3494, 3501, 1), (None, 3501, 0), (3494, None, 0)]


def test_harmonize_era_2(spark, tmp_path):
    df = harmonize(scan_csv(spark, write(tmp_path, "202309-trips", ERA_2_TEXT), ERA_2), ERA_2)
    assert tuple(df.columns) == TRIP_COLUMNS
    got = [(r.start_station_id, r.end_station_id, r.member) for r in df.collect()]
    assert got == [(4810, 5177, 0), (4810, 5177, 1), (4810, 5177, 1)]


def test_combine_eras_keeps_lineage_and_unique_ids(spark, tmp_path):
    paths = write(tmp_path, "201902-trips", ERA_1_TEXT), write(tmp_path, "202309-trips", ERA_2_TEXT)
    df = combine_eras(*scan_both_eras(spark, *paths))
    assert tuple(df.columns) == (*TRIP_COLUMNS, "row_number", "file_path")
    got = df.collect()
    assert len(got) == 6 and len({r.row_number for r in got}) == 6
    assert {r.file_path.rsplit("/", 1)[1] for r in got} == {"201902-trips.csv", "202309-trips.csv"}


def test_combining_moves_no_rows(spark, tmp_path):
    paths = write(tmp_path, "201902-trips", ERA_1_TEXT), write(tmp_path, "202309-trips", ERA_2_TEXT)
    plan = combine_eras(*scan_both_eras(spark, *paths))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_truncate_to_int_never_raises(spark):
    values = [5177.06, -1.9, math.nan, 1e20, -1e20, math.inf, None]
    df = spark.createDataFrame([(v,) for v in values], "v float")
    got = [r[0] for r in df.select(truncate_to_int(F.col("v"))).collect()]
    assert got == [5177, -1, 0, 2147483647, -2147483648, 2147483647, None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (3.5,), (-0.5,), (2.4,)], "v double")
    assert [r[0] for r in df.select(round_half_even(F.col("v"))).collect()] == [0, 2, 2, 4, 0, 2]


def test_table_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2
    write_table(spark.range(3), path, mode="append")
    assert read_table(spark, path).count() == 5
