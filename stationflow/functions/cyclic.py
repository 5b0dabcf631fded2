"""Sine and cosine encoding of calendar parts, so that the end of a cycle meets its start."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Encoded parts and the length of their cycle.
CYCLES = {"dayofmonth": 31, "weekofyear": 52, "dayofyear": 365, "hour": 24}

CYCLIC_COLUMNS = tuple(f"{part}_{fn}" for part in CYCLES for fn in ("sin", "cos"))


def encode_cycles(df: DataFrame) -> DataFrame:
    """Replace each cyclic part by its ``_sin`` and ``_cos`` columns."""
    kept = [c for c in df.columns if c not in CYCLES]
    encoded = []
    for part, length in CYCLES.items():
        angle = 2 * F.pi() * F.col(part) / length
        encoded += [F.sin(angle).alias(f"{part}_sin"), F.cos(angle).alias(f"{part}_cos")]
    return df.select(*kept, *encoded)
