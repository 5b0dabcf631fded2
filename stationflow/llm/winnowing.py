"""Document fingerprints by winnowing.

A text's code points give rolling hashes of k characters. Of every `window` consecutive hashes the least is chosen,
the rightmost of equal ones, and its position is kept. Two texts that share a passage of window + k - 1 characters
share a fingerprint.

A text is compared with an edited version of itself that ends with the next document's beginning. For that the texts
are dealt by ranges of doc_id, and each range also gets the first document of the next one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, mix, pieces

K, WINDOW = 10, 24
#: Text in one range, by which the number of ranges is chosen, and their largest number, as their bounds pass the driver.
#: Longer ranges run through a task just as well: it holds one batch at a time.
RANGE_MB, MOST_RANGES = 4, 100_000

#: Base of the rolling hash, and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)

_LAST = np.uint64(2**64 - 1)
_PLACES = (1 << 20) - 1
_LOWEST = -(1 << 63)

FINGERPRINTS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chosen hashes (32 bits) and their positions for each text; a text shorter than k has one hash of all of it."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    made = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    # Room for a whole window behind each text's hashes, so that windows never reach into the next text.
    room = made + window - 1
    begin = np.concatenate([[0], np.cumsum(room)])
    keys = np.full(int(begin[-1]), _LAST)
    place = np.arange(int(made.sum())) - np.repeat(np.cumsum(made) - made, made)
    at, to = np.repeat(first[:-1], made) + place, np.repeat(begin[:-1], made) + place
    size = np.repeat(np.minimum(sizes, k), made)
    # A gram's hash rolls on as the difference of two sums of character * base ** place, shifted to place 0.
    powers, shifts = (np.cumprod(np.append(np.uint64(1), np.full(len(chars), b, np.uint64))) for b in (BASE, BACK))
    sums = np.append(np.uint64(0), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64))
    rolling = (sums[at + size] - sums[at]) * shifts[at] + size.astype(np.uint64)
    # Equal hashes: the one further right has the smaller low part.
    keys[to] = (mix(rolling) & ~np.uint64(_PLACES)) | (np.uint64(_PLACES) - (place % (_PLACES + 1)).astype(np.uint64))
    least, width = keys, 1
    while width < window:
        step = min(width, window - width)
        shifted = np.concatenate([least[step:], np.full(step, _LAST)])
        least, width = np.minimum(least, shifted), width + step
    out = []
    for a, n in zip(begin[:-1].tolist(), made.tolist(), strict=True):
        chosen = least[a : a + max(n - window + 1, min(n, 1))]
        chosen = chosen[np.append(True, chosen[1:] != chosen[:-1])] if n else chosen
        hashes = (chosen >> np.uint64(32)).astype(np.uint32)
        if n <= _PLACES:
            where = _PLACES - (chosen & np.uint64(_PLACES)).astype(np.int64)
        else:
            own = keys[a : a + n]
            order = np.argsort(own, kind="stable")
            where = order[np.searchsorted(own, chosen, sorter=order)]
        out.append((hashes, where))
    return out


def as_text(chosen: tuple[np.ndarray, np.ndarray]) -> str:
    return ",".join([f"{h:08x}:{p}" for h, p in zip(chosen[0].tolist(), chosen[1].tolist(), strict=True)])


def likeness(a: set[int], b: set[int]) -> float:
    """Shared hashes against all; two empty fingerprints are alike."""
    return len(a & b) / len(a | b) if a or b else 1.0


def edited_texts(texts: list[str], following: list[str]) -> list[str]:
    """Each text with its last third replaced by as much of the beginning of the following one."""
    return [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following, strict=True)]


def _compared(ids: list[int | None], texts: list[str], k: int, window: int) -> pa.RecordBatch:
    """Rows of all texts but the last, which only follows."""
    edited = edited_texts(texts[:-1], texts[1:])
    marks = winnow(texts, k, window)
    changed = winnow(edited, k, window)
    sets = [set(m[0].tolist()) for m in marks]
    rows = [
        [None if i == _LOWEST else i for i in ids[:-1]],
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        [as_text(m) for m in marks[:-1]],
        [as_text(m) for m in changed],
        [likeness(s, set(m[0].tolist())) for s, m in zip(sets, changed, strict=False)],
        [likeness(s, t) for s, t in zip(sets, sets[1:], strict=False)],
    ]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], names)


def fingerprint_table(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text: doc_id, n_chars, hashes and positions (arrays). A null text is empty."""
    bounded_batches(docs.sparkSession)
    kind = "doc_id long, n_chars long, hashes array<long>, positions array<long>"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            found = winnow(texts, k, window)
            lists = [pa.array([m[i].tolist() for m in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), *lists], ["doc_id", "n_chars", "hashes", "positions"])

    return id_and_text(docs).mapInArrow(mark, kind)


def edit_fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each text's fingerprint next to that of its edited text and of the next document.

    The next document is that of the next smaller doc_id, after the last the first; a single row follows itself.
    Rows that share a doc_id follow each other in the order of their texts; rows without one come last. A null text is
    empty, and empty texts have empty fingerprints, alike to each other and unlike all others.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_LOWEST)))
    megabytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] / (1 << 20)
    ranges = max(1, min(math.ceil(megabytes / RANGE_MB), MOST_RANGES))
    cuts = rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (8 * ranges)) if ranges > 1 else []
    cuts = np.unique(np.array(cuts, np.int64))

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            part = len(cuts) - np.searchsorted(cuts, ids)
            found, back = np.unique(part, return_inverse=True)
            top = np.full(len(found), _LOWEST)
            np.maximum.at(top, back, ids)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(top)], ["part", "top"])

    # One row for each range: its first document, in falling order.
    tops = dict(rows.select("doc_id").mapInArrow(first_ids, "part int, top long").groupBy("part").agg(F.max("top")).collect())
    parts = sorted(tops)
    before = {tops[p]: q for p, q in zip(parts, [parts[-1], *parts[:-1]], strict=True)} if parts else {}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            own = len(cuts) - np.searchsorted(cuts, ids)
            twice = [(i, before[x]) for i, x in enumerate(ids.tolist()) if x in before]
            take = pa.array([*range(len(ids)), *[i for i, _ in twice]], pa.int64())
            columns = [batch.column(c).take(take) for c in ("doc_id", "text")]
            part = pa.array(np.append(own, [p for _, p in twice]).astype(np.int32))
            tail = pa.array(np.append(np.zeros(len(ids), np.int32), np.ones(len(twice), np.int32)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part, tail, *columns], ["part", "tail", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "part int, tail int, doc_id long, text string").repartition(max(ranges, 1), "part").sortWithinPartitions("part", "tail", F.desc("doc_id"), "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, ended = None, [], [], False
        for batch in pieces(batches):
            values = zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")), strict=True)
            for p, tail, i, text in values:
                if p != part:
                    if len(ids) > 1:
                        yield _compared(ids, texts, k, window)
                    part, ids, texts, ended = p, [], [], False
                if not ended:
                    ids.append(i)
                    texts.append(text)
                    ended = bool(tail)
            if len(ids) > 1:
                yield _compared(ids, texts, k, window)
                ids, texts = ids[-1:], texts[-1:]

    return dealt.mapInArrow(compare, FINGERPRINTS)
