"""Calendar parts, holiday rules over the synthetic grid and over every day of 18 years, cyclic columns."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationflow.functions import calendar as cal
from stationflow.functions.cyclic import CYCLIC_COLUMNS, encode_cycles

GRID = [(m, wd, d) for m in range(1, 13) for wd in range(7) for d in range(1, 32)]


def marked(spark, rule):
    df = spark.createDataFrame(GRID, "month int, weekday int, dayofmonth int")
    df = cal.mark_holiday(df.withColumn("is_holiday", F.lit(False)), rule)
    return {(r.month, r.weekday, r.dayofmonth) for r in df.collect() if r.is_holiday}


@pytest.mark.parametrize(
    "rule, expected",
    [
        (cal.is_weekend, lambda m, wd, d: wd > 4),
        (lambda: cal.is_floating_holiday("mlk_presidents"), lambda m, wd, d: m < 3 and wd == 0 and 15 <= d <= 21),
        (lambda: cal.is_floating_holiday("labor"), lambda m, wd, d: m == 9 and wd == 0 and d <= 7),
        (lambda: cal.is_floating_holiday("columbus"), lambda m, wd, d: m == 10 and wd == 0 and 7 < d <= 14),
        (lambda: cal.is_floating_holiday("thanksgiving"), lambda m, wd, d: m == 11 and wd == 3 and d >= 22),
        (
            lambda: cal.is_fixed_holiday(7, 4),
            lambda m, wd, d: m == 7 and ((d == 4 and wd <= 4) or (d == 3 and wd == 5)),
        ),
    ],
    ids=["weekend", "mlk_presidents", "labor", "columbus", "thanksgiving", "fixed"],
)
def test_rule_on_grid(spark, rule, expected):
    assert marked(spark, rule()) == {cell for cell in GRID if expected(*cell)}


def days():
    first = date(2013, 1, 1)
    return [first + timedelta(days=i) for i in range((date(2031, 1, 1) - first).days)]


def by_hand(day):
    m, d, wd = day.month, day.day, day.weekday()
    return (
        wd > 4
        or (m in (1, 2) and wd == 0 and 15 <= d <= 21)
        or (m == 9 and wd == 0 and d <= 7)
        or (m == 10 and wd == 0 and 8 <= d <= 14)
        or (m == 11 and wd == 3 and d >= 22)
        or (m, d) in {(1, 1), (6, 19), (7, 4), (11, 11), (12, 25)}
    )


@pytest.fixture(scope="module")
def calendar(spark):
    df = spark.createDataFrame([(datetime(d.year, d.month, d.day),) for d in days()] + [(None,)], "time timestamp")
    return cal.with_calendar_parts(df, keep_time=True)


def test_every_day(calendar):
    got = {r.time and r.time.date() for r in calendar.filter(cal.is_holiday()).collect()}
    assert got == {d for d in days() if by_hand(d)}
    assert len(got) == 2041


def test_no_time_is_no_holiday(calendar):
    assert calendar.filter("time IS NULL").select(cal.is_holiday()).first()[0] is False


def test_observed_days(calendar):
    extra = calendar.filter(cal.is_holiday(observed=True) & ~cal.is_holiday())
    got = {r.time.date() for r in extra.collect()}
    assert date(2021, 12, 31) in got  # Friday before Saturday, 1 January 2022
    assert date(2020, 7, 3) in got  # Friday before Saturday
    assert date(2021, 7, 5) in got  # Monday after Sunday
    for day in got:
        weekend = day + timedelta(days=1) if day.weekday() == 4 else day - timedelta(days=1)
        assert day.weekday() in (0, 4) and (weekend.month, weekend.day) in cal.FIXED_HOLIDAYS


def test_calendar_parts(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 3, 8, 17, 5, 40),), (datetime(2024, 12, 31),), (datetime(2021, 1, 3, 23),)], "time timestamp"
    )
    out = cal.with_calendar_parts(df)
    assert out.columns == ["year", "month", "dayofmonth", "weekday", "weekofyear", "dayofyear", "hour"]
    assert [tuple(r) for r in out.collect()] == [
        (2023, 3, 8, 2, 10, 67, 17),
        (2024, 12, 31, 1, 1, 366, 0),
        (2021, 1, 3, 6, 53, 3, 23),
    ]


def test_cycles(spark):
    df = spark.createDataFrame([(1, 31, 53, 366, 6)], "keep int, dayofmonth int, weekofyear int, dayofyear int, hour int")
    out = encode_cycles(df)
    assert out.columns == ["keep", *CYCLIC_COLUMNS]
    got = out.first()
    assert got.dayofmonth_cos == pytest.approx(1) and got.hour_sin == pytest.approx(1)
    assert got.weekofyear_sin == pytest.approx(math.sin(2 * math.pi * 53 / 52))
    assert got.dayofyear_sin == pytest.approx(math.sin(2 * math.pi * 366 / 365))
