"""Trip times arrive as text whose format depends on the month the file was published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TimeFormat:
    """``shape`` matches the leading part of the text that counts (what follows is ignored, as a lenient
    parser does); ``iso`` puts its groups in the order the built-in string-to-timestamp cast reads.
    Without ``iso`` the first group is in that order already."""

    name: str
    file_prefixes: tuple[str, ...]
    shape: str
    iso: str | None = None


# Which file-name prefixes carry which time format.
ISO_SECONDS = TimeFormat(
    name="yyyy-MM-dd HH:mm:ss",
    file_prefixes=(
        "202", "2013", "2017", "2018", "2019",
        "201401", "201402", "201403", "201404", "201405", "201406", "201407", "201408",
        "201610", "201611", "201612",
    ),
    shape=r"^[ \t]*(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})(?!\d)",
)
US_MINUTES = TimeFormat(
    name="M/d/yyyy H:mm",
    file_prefixes=("201501", "201502", "201503", "201506"),
    shape=r"^[ \t]*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2})(?!\d)",
    iso="$3-$1-$2 $4:$5",
)
US_SECONDS = TimeFormat(
    name="M/d/yyyy HH:mm:ss",
    file_prefixes=(
        "201409", "201410", "201411", "201412",
        "201504", "201505", "201507", "201508", "201509", "201510", "201511", "201512",
        "201601", "201602", "201603", "201604", "201605", "201606", "201607", "201608", "201609",
    ),
    shape=r"^[ \t]*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})(?!\d)",
    iso="$3-$1-$2 $4:$5:$6",
)
TIME_FORMATS = (ISO_SECONDS, US_MINUTES, US_SECONDS)


def file_name_of(path: Column) -> Column:
    """Text after the last slash; '' when the path ends in one."""
    return F.substring_index(path, "/", -1)


def has_prefix(value: Column, prefixes: Sequence[str]) -> Column:
    """True where ``value`` starts with any prefix: one set lookup per prefix length."""
    by_length = groupby(sorted(prefixes, key=len), key=len)
    return reduce(
        Column.__or__, [F.substring(value, 1, n).isin(list(group)) for n, group in by_length]
    )


def time_format_of(file_name: Column) -> Column:
    """Name of the file's time format, NULL for a file that belongs to none."""
    return F.coalesce(
        *[F.when(has_prefix(file_name, fmt.file_prefixes), F.lit(fmt.name)) for fmt in TIME_FORMATS]
    )


def parse_time(text: Column, fmt: TimeFormat) -> Column:
    """Timestamp at the format's own precision; NULL for text that does not fit it."""
    if fmt.iso is None:
        return F.coalesce(_padded_iso(text), F.regexp_extract(text, fmt.shape, 1).try_cast("timestamp"))
    # The second alternative takes any other text whole with every group empty, which casts to NULL.
    return F.regexp_replace(text, rf"(?s)(?:{fmt.shape}.*$)|(?:^.*$)", fmt.iso).try_cast("timestamp")


def _padded_iso(text: Column) -> Column:
    """Fast path for two-digit fields: with the separators in place the first 19 characters cast as they
    are, at half the cost of the pattern. NULL for all else, which is left to the pattern."""
    in_place = (
        (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 11, 1) == " ")
        & (F.substring(text, 17, 1) == ":")
        & ~F.substring(text, 20, 1).between("0", "9")
    )
    return F.when(in_place, F.substring(text, 1, 19).try_cast("timestamp"))


def parse_time_by_format(text: Column, format_name: Column) -> Column:
    """Per row, the parser its file's format asks for. Only that branch is evaluated."""
    return F.coalesce(
        *[F.when(format_name == fmt.name, parse_time(text, fmt)) for fmt in TIME_FORMATS]
    )


# The one file whose first rows carry last month's date.
SHIFTED_FILE_PREFIX, SHIFTED_YEAR, SHIFTED_MONTH = "202108", 2021, 7


def repair_shifted_month(time: Column, file_name: Column, preserve_time: bool = False) -> Column:
    """Move July 2021 times of the August 2021 file one month on.

    By default a moved value keeps only its date (midnight); ``preserve_time`` keeps the time of day.
    """
    moved = time + F.expr("INTERVAL 1 MONTH") if preserve_time else F.add_months(time, 1).cast("timestamp")
    wrong = (
        F.startswith(file_name, F.lit(SHIFTED_FILE_PREFIX))
        & (F.year(time) == SHIFTED_YEAR)
        & (F.month(time) == SHIFTED_MONTH)
    )
    return F.when(wrong, moved).otherwise(time)
