"""Benchmark decontamination by suffix arrays of the training text.

Each task is a shard: it turns its documents' words into ranks of the test vocabulary, sorts the suffixes that
could begin a test window, and looks every test suffix up by binary search. Hits that follow each other on
one diagonal join into the longest verbatim matches, with their places on both sides.

The test set is the stated query set. It reaches the tasks in blocks of about `BLOCK_BYTES`, one pass over the
documents for each; a pass holds one block, however large the test set is.

A suffix can only begin a hit if it and the words after it, up to the shortest window, all occur in the
test set. Leaving the others out of the array loses nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, lower_ascii, pieces, stored, utf8, words_of

#: Word bytes of the contract (digits, a-z, every byte of a character beyond ASCII).
INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True
INSIDE[0x41:0x5B] = True  # A-Z, lower-cased before they are compared

#: Text of the test set in one block. Its windows take some twelve times as much, on the driver and in every task.
BLOCK_BYTES = 8 << 20

HITS = "doc_id long, n_words long, hits array<struct<start:long,end:long>>, items array<long>, matches array<struct<item_id:long,item_start:long,doc_start:long,n_words:long>>"


@dataclass(frozen=True)
class TestSet:
    """Windows of a block of the test set: sorted vocabulary, suffix keys by window length, and the places (item, word) of each
    key, in the order of keys, with where each key's begin."""

    __test__ = False

    vocabulary: np.ndarray
    shortest: int
    window: int
    keys: dict[int, np.ndarray]
    places: dict[int, np.ndarray]
    first: dict[int, np.ndarray]

    def owners(self, size: int, key: int) -> list[list[int]]:
        a, b = self.first[size][key : key + 2].tolist()
        return self.places[size][a:b].tolist()


def _words(texts: list[str]):
    return words_of(*utf8(pa.array(texts, pa.large_string())), INSIDE, lower_ascii())


def _packed(ranks: np.ndarray, starts: np.ndarray, size: int, ends: np.ndarray) -> np.ndarray:
    """The `size` ranks from each start on as big-endian bytes, which sort as the ranks do; past a text's end: 0."""
    at = starts[:, None] + np.arange(size)
    cells = np.where(at < ends[:, None], ranks[np.minimum(at, len(ranks) - 1)] + 1, 0).astype(">u4")
    return np.ascontiguousarray(cells).view(f"S{4 * size}").ravel()


def test_set(items: list[tuple[int | None, str]], window: int) -> TestSet | None:
    """Windows of `window` words of the items; an item of fewer words, but not none, is one window."""
    words = _words([text or "" for _, text in items])
    counts = np.diff(words.first)
    if not len(words.hash):
        return None
    vocabulary, ranks = np.unique(words.hash, return_inverse=True)
    ids = np.array([-1 if i is None else i for i, _ in items], np.int64)
    made: dict[int, list] = {}
    for row in np.flatnonzero(counts):
        n, first = int(counts[row]), int(words.first[row])
        size = min(n, window)
        starts = np.arange(first, first + n - size + 1)
        keys = _packed(ranks, starts, size, np.full(len(starts), first + n))
        made.setdefault(size, []).append((keys, np.full(len(starts), ids[row]), starts - first))
    keys, ordered, first_of = {}, {}, {}
    for size, parts in made.items():
        every = np.concatenate([p[0] for p in parts])
        places = np.stack([np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])], axis=1)
        keys[size], back = np.unique(every, return_inverse=True)
        ordered[size] = places[np.argsort(back, kind="stable")]
        first_of[size] = np.append(0, np.cumsum(np.bincount(back)))
    return TestSet(vocabulary, min(keys), window, keys, ordered, first_of)


test_set.__test__ = False


def _runs(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Sorted window starts as the ranges of words that they cover."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts) > size) + 1
    return list(zip(starts[np.r_[0, new]].tolist(), (starts[np.r_[new - 1, len(starts) - 1]] + size).tolist(), strict=True))


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def search(batch: pa.RecordBatch, tests: TestSet | None) -> pa.RecordBatch:
    """The hits of one shard's documents."""
    words = words_of(*utf8(batch.column("text")), INSIDE, lower_ascii())
    n = batch.num_rows
    found: dict[int, dict[int, list]] = {}
    if tests is not None and len(words.hash):
        rank = np.minimum(np.searchsorted(tests.vocabulary, words.hash), len(tests.vocabulary) - 1)
        rank[tests.vocabulary[rank] != words.hash] = -1
        # words left in the run of known words of this text that each word begins
        stop = np.zeros(len(rank) + 1, bool)
        stop[:-1] = rank < 0
        stop[words.first] = True
        ends = np.flatnonzero(stop)
        left = ends[np.searchsorted(ends, np.arange(len(rank)), side="left")] - np.arange(len(rank))
        is_first = np.zeros(len(rank) + 1, bool)
        is_first[words.first] = True
        begins = np.flatnonzero(is_first[:-1] & (rank >= 0))
        left[begins] = ends[np.searchsorted(ends, begins, side="right")] - begins
        suffixes = np.flatnonzero((left >= tests.shortest) & (rank >= 0))
        if len(suffixes):
            array = _packed(rank, suffixes, tests.window, suffixes + left[suffixes])
            order = np.argsort(array, kind="stable")
            array, suffixes = array[order], suffixes[order]
            for size, keys in tests.keys.items():
                low = np.searchsorted(array, keys, side="left")
                if size < tests.window:
                    most = np.array([k.ljust(4 * size, b"\0") + b"\xff" * 4 * (tests.window - size) for k in keys.tolist()], f"S{4 * tests.window}")
                    high = np.searchsorted(array, most, side="right")
                else:
                    high = np.searchsorted(array, keys, side="right")
                for k in np.flatnonzero(high > low):
                    for at in suffixes[low[k] : high[k]].tolist():
                        found.setdefault(int(words.row[at]), {}).setdefault(size, []).append((at, k))
    hits, items, matches = [], [], []
    for row in range(n):
        ranges, ids, places = [], set(), []
        for size, at in found.get(row, {}).items():
            starts = np.unique([a for a, _ in at]) - words.first[row]
            ranges += _runs(starts, size)
            diagonals: dict[tuple[int, int], list[int]] = {}
            for a, k in at:
                for item, place in tests.owners(size, k):
                    ids.add(item)
                    diagonals.setdefault((item, a - int(words.first[row]) - place), []).append(place)
            for (item, shift), there in diagonals.items():
                places += [(item, a, a + shift, b - a) for a, b in _runs(np.unique(there), size)]
        hits.append([{"start": a, "end": b} for a, b in _joined(ranges)])
        items.append(sorted(i for i in ids if i >= 0))
        matches.append([{"item_id": i, "item_start": a, "doc_start": b, "n_words": c} for i, a, b, c in sorted(places)])
    place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    match = pa.struct([(k, pa.int64()) for k in ("item_id", "item_start", "doc_start", "n_words")])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(words.first)), pa.array(hits, pa.list_(place)), pa.array(items, pa.list_(pa.int64())), pa.array(matches, pa.list_(match))],
        ["doc_id", "n_words", "hits", "items", "matches"],
    )


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_words, word ranges that occur in test windows (hits), ids of the items with such
    windows, and the longest verbatim matches with their places. Null texts have no words, and a test row without id
    marks words but is not listed. Rows with a null or repeated doc_id stay rows of their own, also for a test set of
    several blocks."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tests = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    texts, columns = id_and_text(docs), HITS
    if blocks > 1:  # rows meet again by id and text
        texts, columns = texts.withColumn("name", F.sha2("text", 256)), f"{HITS}, name string"
    for k in range(blocks):
        rows = tests.where(block == k).collect()
        held = spark.sparkContext.broadcast(test_set([(r[0], r[1]) for r in rows], window))
        del rows

        def shard(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                found = search(batch, held.value)
                yield found.append_column("name", batch.column("name")) if "name" in batch.schema.names else found

        parts.append(texts.mapInArrow(shard, columns))
    if blocks == 1:
        return parts[0]
    # Each block gives one row for each row; equal rows have equal hits, and there stay as many of them as there were.
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    once = every.groupBy("doc_id", "name").agg(
        F.max("n_words").alias("n_words"),
        joined_hits(F.array_sort(F.flatten(F.collect_set("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("matches")))).alias("matches"),
        (F.count("*") / blocks).cast("int").alias("copies"),
    )
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("name", "copies", "copy")


def joined_hits(hits: F.Column) -> F.Column:
    """Sorted ranges with those that overlap or touch as one, as `_joined` has them."""
    none = F.array().cast("array<struct<start:long,end:long>>")

    def step(out: F.Column, x: F.Column) -> F.Column:
        last = F.get(out, F.size(out) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(out) > 0) & (x["start"] <= last["end"]), F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(hits, none, step)


def n_hit(hits) -> F.Column:
    """Words in at least one of the ranges, which are sorted but may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, x: F.struct(F.greatest(s["end"], x["end"]).alias("end"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).alias("n"))
    return F.aggregate(hits, start, step, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Digest per document of the hits: counts, item ids and whether any word is hit."""
    found = find_overlaps(docs, benchmark, window)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0).cast("long")).alias("longest_match"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of docs whose id has no hit. Rows without an id have no handle and stay."""
    bad = stored(find_overlaps(docs, benchmark, window).where(F.size("hits") > 0).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def digest(ids: list[int]) -> str:
    """The sha256 of item ids as `contamination` gives it."""
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
