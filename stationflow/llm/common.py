"""Tables stored between jobs, bounded Arrow batches and words of UTF-8 buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.session import fresh_path

#: Bytes of one Arrow batch that a Python worker holds, unless the session names another bound.
BATCH_BYTES = 4 << 20
#: Text that is worked on at a time: arrays beside it take some hundred bytes for each of its characters.
PIECE_BYTES = 1 << 20

_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNBOUNDED = {None, "-1", str(2**31 - 1), f"{2**31 - 1}b"}


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs reread it, also after a lost executor."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as documents may be very long."""
    if spark.conf.get(_BATCH_KEY, None) in _UNBOUNDED:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_prefix(docs: DataFrame) -> str:
    """A prefix that no column of docs has."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("string").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about `most` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more entry: the end)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salts(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


@dataclass(frozen=True)
class Words:
    """Words of a run of texts: 64-bit hash, byte range and row of each; first has one more entry than rows."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


_POWER = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = salts(256, 7)


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Runs of bytes for which `inside` holds (256 flags, by byte value), cut at the texts' ends; `fold` maps bytes
    before hashing."""
    return runs_of(data, offsets, inside[data], fold)


def runs_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Runs of bytes at the places that `inside` flags, cut at the texts' ends."""
    n = len(data)
    is_word = np.zeros(n + 2, np.int8)
    is_word[1:-1] = inside
    begins = is_word[1:-1] > is_word[:-2]
    ends = is_word[1:-1] > is_word[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = is_word[1:-1][cuts] > 0
    ends[cuts - 1] = is_word[1:-1][cuts - 1] > 0
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, row, first)
    length = end - start
    powers = np.ones(int(length.max()), np.uint64)
    powers[1:] = np.cumprod(np.full(len(powers) - 1, _POWER))
    chars = np.flatnonzero(is_word[1:-1])
    place = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
    values = (_BYTE if fold is None else _BYTE[fold])[data[chars]] * powers[place]
    sums = np.add.reduceat(values, np.cumsum(length) - length)
    return Words(mix(sums + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end, row, first)


def grams(hashes: np.ndarray, first: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words, and where each text's begin; a text of fewer words has one gram of them all."""
    counts = np.diff(first)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    where = np.concatenate([[0], np.cumsum(made)])
    # positions of the grams that begin at each word
    begin = np.repeat(first[:-1] - where[:-1], made) + np.arange(where[-1])
    size = np.repeat(np.minimum(counts, k), made)
    out = size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for j, salt in enumerate(salts(k, seed)):
        if j == 0:
            out += hashes[begin] * salt
        else:
            out += np.where(size > j, hashes[np.minimum(begin + j, max(len(hashes) - 1, 0))], np.uint64(0)) * salt
    return mix(out), where
