"""Line dedup by winnowing over line hashes.

A gram is the shortest run of lines with `gram_words` words from some line on, a window the shortest with
`min_words` from some line on, or up to some line. Of the grams inside each window the one of least hash is its
fingerprint (ties: the rightmost). Occurrences of a fingerprint are joined to its first one in an equal window, in the
order of doc_id and line, never to each other. From there a match grows both ways, line by line, and the later run goes
if the match has `min_words` words. Every line that goes equals an earlier line that a run shares with it, so the first
copy of a run stays whole.

A gram of less than `min_words` may stand in several passages, so occurrences meet by the hash of the whole window: the
first one then shares a full run. Every line of a repeated run of `min_words` words lies in a window inside the run, the
last ones perhaps only in windows that end with them. So each line goes that an earlier run shares, whoever else holds a
part of it.

A line ends at a line feed or at the end of a sentence (a full stop, exclamation or question mark before a space), as
a passage may begin or end inside a paragraph. Lines are compared byte for byte without that space or line feed; empty
lines take no part, but go with a run around them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, mix, pieces, runs_of, stored, unused_prefix, utf8, words_of

MIN_WORDS, GRAM_WORDS = 40, 20

#: Where a text is split into lines; each keeps its line feed or space.
SPLIT = r"(?:(?<=\n)|(?<=[.!?]\x20))(?!\z)"
#: The same as byte tables: marks that end a sentence, and bytes of a word.
ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[list(b".!?")] = True
IN_WORD = np.ones(256, bool)
IN_WORD[0x09:0x0E] = IN_WORD[0x20] = False

#: Runs of a document from which on a task merges what it has found.
MERGE_AT = 10_000

#: Base of the grams' rolling hash, and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)

LINES = "doc_id long, name long, hashes array<long>, words array<int>, numbers array<int>, marks array<struct<place:int,key:long>>"
RUNS = "doc_id long, name long, runs array<struct<start:int,end:int>>"


def _reach(total: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Line after the shortest run from each line with `least` words in the same text, or -1."""
    end = np.searchsorted(total, total[:-1] + least, side="left")
    last = np.repeat(first[1:], np.diff(first))
    return np.where(end <= last, end, -1)


def _windows(total: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after the last of the shortest runs with `least` words from each line on, and up to each line."""
    end = _reach(total, first, least)
    from_line = np.flatnonzero(end > 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    to_line = np.flatnonzero(start >= np.repeat(first[:-1], np.diff(first)))
    pairs = np.concatenate([np.stack([from_line, end[from_line]]), np.stack([start[to_line], to_line + 1])], axis=1)
    code = np.unique(pairs[0] * len(total) + pairs[1])
    return code // len(total), code % len(total)


def fingerprints(grams: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places that are the least gram of some window of grams [start, stop)."""
    return np.unique(least_grams(grams, start, stop))


def least_grams(grams: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Place of the least gram in each window of grams [start, stop), the rightmost of equal ones (as to 44 bits).

    Minima over runs of 1, 2, 4, ... grams; a window's least is that of the two runs which begin and end it.
    """
    low = (1 << 20) - 1
    place = np.arange(len(grams), dtype=np.uint64)
    least = (grams & ~np.uint64(low)) | (np.uint64(low) - (place & np.uint64(low)))
    level = np.frexp(stop - start)[1] - 1
    chosen, width = np.zeros(len(start), np.int64), 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        two = np.minimum(least[start[at]], least[stop[at] - width])
        chosen[at] = start[at] + ((np.uint64(low) - (two & np.uint64(low))).astype(np.int64) - start[at]) % (low + 1)
        least = np.minimum(least, np.concatenate([least[width:], np.full(min(width, len(least)), ~np.uint64(0))]))
        width *= 2
    return chosen


def line_table(batch: pa.RecordBatch, min_words: int, gram_words: int) -> pa.RecordBatch:
    """Lines, fingerprints and their windows' hashes of each text."""
    data, offsets = utf8(batch.column("text"))
    gap = data == 0x0A
    gap[1:] |= (data[1:] == 0x20) & ENDS_SENTENCE[data[:-1]]
    begins = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
    gap[begins] = data[begins] == 0x0A  # a text's first byte follows no mark of its own
    lines, words = runs_of(data, offsets, ~gap), words_of(data, offsets, IN_WORD)
    # words between the begins of this line and the next all stand in this line
    count = np.diff(np.searchsorted(words.start, np.append(lines.start, len(data))))
    feeds = np.append(0, np.cumsum(gap))
    number = feeds[lines.start] - feeds[offsets[lines.row]]
    n, first = batch.num_rows, lines.first
    total = np.append(0, np.cumsum(count))
    gram_end, (start, stop) = _reach(total, first, gram_words), _windows(total, first, min_words)
    # A run's hash: the difference of two prefix sums of hash * base ** place, shifted to place 0.
    powers, shifts = (np.cumprod(np.full(len(lines.hash) + 1, b, np.uint64)) for b in (BASE, BACK))
    summed = np.append(np.uint64(0), np.cumsum(lines.hash * powers[:-1], dtype=np.uint64))
    begins = np.arange(len(lines.hash))
    ends = np.maximum(gram_end, begins)

    def hashed(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((summed[end] - summed[begin]) * shifts[begin] + (end - begin).astype(np.uint64))

    # Ends of grams in steps of half a line, rising over all texts, with a text's unfinished grams behind its last line.
    rising = np.where(gram_end > 0, 2 * gram_end, 2 * np.repeat(first[1:], np.diff(first)) + 1)
    chosen = least_grams(hashed(begins, ends), start, np.searchsorted(rising, 2 * stop, side="right"))
    row = lines.row[start]
    at = pa.array(first.astype(np.int32))

    def lists(x: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(at, pa.array(x))

    marks = pa.StructArray.from_arrays([pa.array((chosen - first[row]).astype(np.int32)), pa.array(hashed(start, stop).view(np.int64))], ["place", "key"])
    by_row = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("name"), lists(lines.hash.view(np.int64)), lists(count.astype(np.int32)), lists(number.astype(np.int32)), pa.ListArray.from_arrays(by_row, marks)],
        ["doc_id", "name", "hashes", "words", "numbers", "marks"],
    )


def grown(here: np.ndarray, there: np.ndarray, words: np.ndarray, anchors: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Matches through the anchors (place here, place there), grown both ways: first line, line after the last."""
    out = []
    for shift in np.unique(anchors[:, 0] - anchors[:, 1]).tolist():
        low, high = max(0, shift), min(len(here), len(there) + shift)
        at = anchors[anchors[:, 0] - anchors[:, 1] == shift, 0]
        same = np.flatnonzero(here[low:high] != there[low - shift : high - shift]) + low
        breaks = np.concatenate([[low - 1], same, [high]])
        for k in np.unique(np.searchsorted(breaks, at[(at >= low) & (at < high)], side="right")).tolist():
            start, end = int(breaks[k - 1]) + 1, int(breaks[k])
            if end > start and words[start:end].sum() >= least:
                out.append((start, end))
    return out


def _cells(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in one run, and where each row's begin."""
    column = batch.column(name)
    return column.values.to_numpy(zero_copy_only=False), np.asarray(column.offsets)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """Later copies of repeated runs: doc_id, name (of the text), runs (line numbers start and end, exclusive, merged where
    they overlap or touch). A text may have several rows.

    Rows without text or doc_id have none. Rows that repeat both id and text are one document; of rows that share an id
    only, a run counts as later where it stands further behind.
    """
    bounded_batches(docs.sparkSession)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield line_table(batch, min_words, gram_words)

    texts = id_and_text(docs).where("doc_id is not null").withColumn("name", F.xxhash64("text"))
    lined = stored(texts.mapInArrow(lines, LINES), "lines")
    mark = F.col("mark")
    marks = lined.select("doc_id", F.explode("marks").alias("mark")).select("doc_id", mark["place"].alias("place"), mark["key"].alias("key"))
    own = F.struct("doc_id", "place")
    firsts = stored(marks.groupBy("key").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first <> last").select("key", "first"), "firsts")
    pairs = stored(
        marks.join(firsts, "key")
        .where(own > F.col("first"))
        .select("doc_id", F.col("first.doc_id").alias("first_id"), "place", F.col("first.place").alias("there"))
        .groupBy("doc_id", "first_id")
        .agg(F.flatten(F.collect_set(F.array("place", "there"))).alias("anchors")),
        "pairs",
    )
    # The documents come last, sorted, so a task meets all pairs of a document one after the other.
    sources = lined.select(F.col("doc_id").alias("first_id"), F.col("hashes").alias("there"))
    met = pairs.join(sources, "first_id").join(lined.select("doc_id", "name", "hashes", "words", "numbers").hint("merge"), "doc_id")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, found = None, []
        for batch in batches:
            (hashes, a), (words, b), (numbers, c), (there, d), (anchors, e) = (_cells(batch, x) for x in ("hashes", "words", "numbers", "there", "anchors"))
            done = []
            for i, own in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("name").to_pylist(), strict=True)):
                if own != text:
                    if found:
                        done.append((*text, merged(found)))
                    text, found = own, []
                pairs_of = anchors[e[i] : e[i + 1]].reshape(-1, 2)
                for x, y in grown(hashes[a[i] : a[i + 1]], there[d[i] : d[i + 1]], words[b[i] : b[i + 1]], pairs_of, min_words):
                    found.append((int(numbers[c[i] + x]), int(numbers[c[i] + y - 1]) + 1))
                if len(found) > MERGE_AT:
                    found = merged(found)
            if done:
                yield _run_rows(done)
        if found:
            yield _run_rows([(*text, merged(found))])

    return met.select("doc_id", "name", "hashes", "words", "numbers", "there", "anchors").mapInArrow(grow, RUNS)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted runs, those that overlap or touch as one."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _run_rows(rows: list[tuple[int, int, list[tuple[int, int]]]]) -> pa.RecordBatch:
    ids, names, runs = zip(*rows, strict=True)
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    cells = [[{"start": a, "end": b} for a, b in r] for r in runs]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.int64()), pa.array(cells, pa.list_(pair))], ["doc_id", "name", "runs"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS, prefix: str = "") -> DataFrame:
    """docs with the later copies of repeated runs cut out of text, and n_removed, the number of lines cut.

    A null text stays null. A text of which nothing is cut stays as it is, byte for byte. The new column's name follows
    `prefix`; a column of docs so named is replaced.
    """
    runs = repeated_runs(docs, min_words, gram_words)
    docs = docs.drop(f"{prefix}n_removed")
    own = unused_prefix(docs)
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_list("runs"))))
    cut = stored(runs.groupBy(F.col("doc_id").alias(f"{own}id"), F.col("name").alias(f"{own}name")).agg(spans.alias(f"{own}runs")), "runs")
    same = (F.col("doc_id") == F.col(f"{own}id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(f"{own}name"))
    # The runs grow with the documents, so the plan is that of a large table at every size.
    joined = docs.join(cut.hint("merge"), same, "left").select(*docs.columns, f"{own}runs")
    cuts, lines = F.col(f"{own}runs"), F.split("text", SPLIT)
    inside = lambda i: F.exists(cuts, lambda r: (r["start"] <= i) & (i < r["end"]))
    left = F.array_join(F.filter(lines, lambda x, i: ~inside(i)), "")
    # Runs may overlap: each counts from where those before it end.
    step = lambda s, r: F.struct(F.greatest(s["end"], r["end"]).alias("end"), (s["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(s["end"], r["start"]))).alias("n"))
    removed = F.aggregate(cuts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda s: s["n"])
    return joined.select(
        *[F.when(cuts.isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.coalesce(removed, F.lit(0)).cast("long").alias(f"{prefix}n_removed"),
    )
