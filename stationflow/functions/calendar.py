"""Calendar parts of a time and the holiday rules built on them, as plain column expressions."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONDAY, THURSDAY, FRIDAY, SATURDAY = 0, 3, 4, 5

CALENDAR_PARTS = {
    "year": F.year,
    "month": F.month,
    "dayofmonth": F.dayofmonth,
    "weekday": F.weekday,  # Monday 0 ... Sunday 6
    "weekofyear": F.weekofyear,  # ISO week
    "dayofyear": F.dayofyear,
    "hour": F.hour,
}

# Holidays that fall on a weekday within a span of days, as
# (months, weekday, first day, last day). Thanksgiving has no upper bound, so a fifth Thursday counts.
FLOATING_HOLIDAYS = {
    "mlk_presidents": ((1, 2), MONDAY, 15, 21),
    "labor": ((9,), MONDAY, 1, 7),
    "columbus": ((10,), MONDAY, 8, 14),
    "thanksgiving": ((11,), THURSDAY, 22, 31),
}

# Holidays on a fixed (month, day).
FIXED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))


def with_calendar_parts(df: DataFrame, time: str = "time", keep_time: bool = False) -> DataFrame:
    """Append year ... hour of ``time``; the time itself goes unless asked for."""
    kept = [c for c in df.columns if keep_time or c != time]
    return df.select(*kept, *[part(F.col(time)).alias(name) for name, part in CALENDAR_PARTS.items()])


def is_weekend() -> Column:
    return F.col("weekday") >= SATURDAY


def is_floating_holiday(name: str) -> Column:
    months, weekday, first, last = FLOATING_HOLIDAYS[name]
    return (
        F.col("month").isin(*months)
        & (F.col("weekday") == weekday)
        & F.col("dayofmonth").between(first, last)
    )


def _on(day: date) -> Column:
    return (F.col("month") == day.month) & (F.col("dayofmonth") == day.day)


def is_fixed_holiday(month: int, day: int, observed: bool = False) -> Column:
    """The date itself on Monday to Friday, or the Saturday right before it.

    That Saturday is only ever a weekend day, so by default nothing is observed on another weekday;
    ``observed`` adds the Friday before a Saturday holiday and the Monday after a Sunday one.
    """
    holiday = date(2023, month, day)  # any common year: only the neighbours' month and day are used
    before, after = holiday - timedelta(days=1), holiday + timedelta(days=1)
    weekday = F.col("weekday")
    saturday_before = (
        (F.col("month") == month) & (F.col("dayofmonth") == day - 1) & (weekday == SATURDAY)
    )
    rule = (_on(holiday) & (weekday < SATURDAY)) | saturday_before
    if observed:
        rule = rule | (_on(before) & (weekday == FRIDAY)) | (_on(after) & (weekday == MONDAY))
    return rule


def is_any_fixed_holiday(observed: bool = False) -> Column:
    return reduce(Column.__or__, [is_fixed_holiday(m, d, observed) for m, d in FIXED_HOLIDAYS])


def is_holiday(observed: bool = False) -> Column:
    """Every rule in one expression. A row without a time is no holiday, rather than unknown."""
    rules = [is_weekend(), is_any_fixed_holiday(observed)]
    rules += [is_floating_holiday(name) for name in FLOATING_HOLIDAYS]
    return F.coalesce(reduce(Column.__or__, rules), F.lit(False))


def mark_holiday(df: DataFrame, rule: Column) -> DataFrame:
    """Set ``is_holiday`` where the rule holds and leave it as it was elsewhere."""
    return df.withColumn("is_holiday", F.when(rule, F.lit(True)).otherwise(F.col("is_holiday")))
