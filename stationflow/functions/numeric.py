"""Numeric column helpers whose results must not depend on the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647


def truncate_to_int(value: Column) -> Column:
    """Float to 32-bit integer: cut the fraction, clamp out-of-range values, NaN to 0, NULL stays NULL.

    A plain cast raises on the out-of-range cases in ANSI mode, so a single bad id would end a job.
    """
    return (
        F.when(F.isnan(value), F.lit(0))
        .when(value >= float(INT_MAX), F.lit(INT_MAX))
        .when(value <= float(INT_MIN), F.lit(INT_MIN))
        .otherwise(value.cast("int"))
    )


def round_half_even(value: Column) -> Column:
    """Nearest whole number as long, ties to the even neighbour (2.5 -> 2, 3.5 -> 4)."""
    return F.rint(value).cast("long")
