"""Near-duplicate documents by MinHash with odd sketches.

A document's set is its distinct word shingles. 96 MinHash samples serve twice: 24 bands of 4 find candidates, and
all of them, folded into a parity bitmap of 256 bits (the odd sketch), estimate a pair's likeness from the
population count of the XOR of two bitmaps. Links are confirmed on the full sets.

1. One pass over the texts gives each row its set's size, 128-bit name, bands and sketch. Equal sets are one class.
2. Classes that share a band are joined to that bucket's two centres, never to each other, and pairs whose sketches
   are far apart go. The components of what stays are neighbourhoods.
3. A neighbourhood is dealt in blocks of bounded size, and every two blocks meet in a task of their own, which holds
   sets of shingle hashes and no texts. There,
   sketches choose the pairs to look at, nearest first, and full sets confirm them. Pairs that are already
   connected are not looked at again, so a task returns fewer links than it has members.
4. The components of the links name the groups.

Two sets of likeness 0.8 miss all bands with probability 3e-6. A neighbourhood of b blocks makes b * b / 2 tasks:
that is the price of missing no link inside a large group of loose copies, and no task grows with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import Words, bounded_batches, grams, id_and_text, lower_ascii, mix, pieces, salts, stored, utf8, words_of
from stationflow.llm.components import components

BANDS, ROWS, BITS = 24, 4, 256
SAMPLES = BANDS * ROWS
#: Differing sketch bits beyond which a pair isn't looked at. At likeness 0.8 the mean is 33 and the deviation 6.
FAR_BITS = 66
#: Shingles in a block of a neighbourhood.
BLOCK_SHINGLES = 1 << 20

#: White space of the contract.
INSIDE = np.ones(256, bool)
INSIDE[0x09:0x0E] = INSIDE[0x20] = False

SIGNATURE = "doc_id long, n_shingles long, name_a long, name_b long, bands array<long>, sketch array<long>"

_A, _B = salts(SAMPLES, 11), salts(SAMPLES, 13)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and where each text's begin."""
    words: Words = words_of(*utf8(column), INSIDE, lower_ascii())
    every, first = grams(words.hash, words.first, k, 5)
    sets = [np.unique(every[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return np.concatenate(sets) if sets else every, np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def names(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit name of each set, in two halves; 0 for an empty set."""
    full = np.flatnonzero(np.diff(first))
    at = first[:-1][full]
    name_a, name_b = np.zeros(len(first) - 1, np.uint64), np.zeros(len(first) - 1, np.uint64)
    if len(full):
        name_a[full] = np.add.reduceat(mix(sets + np.uint64(1)), at)
        name_b[full] = np.bitwise_xor.reduceat(mix(sets ^ np.uint64(0xC2B2AE3D27D4EB4F)), at)
    return name_a, name_b


def signatures(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    sets, first = shingle_sets(batch.column("text"), k)
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    at = first[:-1][full]
    n = batch.num_rows
    name_a, name_b = names(sets, first)
    low = np.zeros((SAMPLES, len(full)), np.uint64)
    if len(full):
        for j in range(SAMPLES):
            low[j] = np.minimum.reduceat((sets * _A[j] + _B[j]) >> np.uint64(24), at)
    bands = np.zeros((BANDS, len(full)), np.uint64)
    for band in range(BANDS):
        for r in range(ROWS):
            bands[band] = mix(bands[band] + low[band * ROWS + r] + np.uint64(r + 1))
    sketch = np.zeros((BITS // 64, len(full)), np.uint64)
    columns = np.arange(len(full))
    for j in range(SAMPLES):  # parity of how many samples fall on each bit
        bit = mix(low[j] + _B[j]) % np.uint64(BITS)
        sketch[(bit // np.uint64(64)).astype(np.int64), columns] ^= np.uint64(1) << (bit % np.uint64(64))

    def lists(cells: np.ndarray) -> pa.Array:
        width = np.zeros(n + 1, np.int32)
        width[full + 1] = len(cells)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(width, dtype=np.int32)), pa.array(cells.T.ravel().view(np.int64)))

    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes), pa.array(name_a.view(np.int64)), pa.array(name_b.view(np.int64)), lists(bands), lists(sketch)],
        ["doc_id", "n_shingles", "name_a", "name_b", "bands", "sketch"],
    )


def signature_table(docs: DataFrame, k: int) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield signatures(batch, k)

    return id_and_text(docs).mapInArrow(sign, SIGNATURE)


def differing_bits(x, y):
    """Population count of the XOR of two sketches."""
    return sum(F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(BITS // 64))


def estimated_likeness(x, y):
    """Likeness that two sketches tell of, from the share of bits in which they differ."""
    share = F.least(F.lit(0.499), differing_bits(x, y) / F.lit(BITS))
    return F.greatest(F.lit(0.0), 1 + F.lit(BITS / (4 * SAMPLES)) * F.log(1 - 2 * share))


def candidates(classes: DataFrame) -> DataFrame:
    """Pairs of a class and a centre of a bucket they share, whose sketches are close."""
    members = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    order = F.struct(F.xxhash64("rep", "band").alias("h"), "rep")
    centres = stored(
        members.groupBy("band", "key").agg(F.min(order).alias("low"), F.max(order).alias("high")).where("low.rep <> high.rep").select("band", "key", F.col("low.rep").alias("low"), F.col("high.rep").alias("high")),
        "centres",
    )
    pairs = (
        members.join(centres, ["band", "key"])
        .select("rep", F.explode(F.array("low", "high")).alias("centre"))
        .where("rep <> centre")
        .select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
        .distinct()
    )
    left = classes.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n_shingles").alias("n_a"))
    right = classes.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n_shingles").alias("n_b"))
    return pairs.join(left, "a").join(right, "b").where(differing_bits(F.col("sketch_a"), F.col("sketch_b")) <= FAR_BITS).select("a", "b")


class _Sets:
    """Sets that merge."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def links(members: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """`set_links` of members that come with their texts."""
    sets, first = shingle_sets(pa.array(members["text"], pa.large_string()), k)
    return set_links(members.assign(shingles=[sets[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]), percent)


def set_links(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that connect the members as far as pairs of their likeness do; two blocks meet across only."""
    members = members.sort_values("rep", ignore_index=True)
    reps, block = members["rep"].to_numpy(), members["block"].to_numpy()
    sizes = members["shingles"].map(len).to_numpy()
    first = np.append(0, np.cumsum(sizes))
    _, dense = np.unique(np.concatenate(members["shingles"].to_list()), return_inverse=True)
    sketch = np.stack(members["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
    across = len(np.unique(block)) > 1
    here = np.zeros(int(dense.max()) + 1 if len(dense) else 0, np.uint8)
    joined, out = _Sets(len(reps)), []
    for i in range(len(reps) - 1):
        rest = np.arange(i + 1, len(reps))
        near = np.bitwise_count(sketch[rest] ^ sketch[i]).sum(axis=1) <= FAR_BITS
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        near &= 100 * small >= percent * large
        if across:
            near &= block[rest] != block[i]
        rest = rest[near]
        if not len(rest):
            continue
        roots = joined.roots()
        rest = rest[roots[rest] != roots[i]]
        if not len(rest):
            continue
        here[dense[first[i] : first[i + 1]]] = 1
        for j in rest.tolist():
            both = int(here[dense[first[j] : first[j + 1]]].sum())
            if 100 * both >= percent * (sizes[i] + sizes[j] - both) and joined.root(i) != joined.root(j):
                joined.up[max(joined.root(i), joined.root(j))] = min(joined.root(i), joined.root(j))
                out.append((reps[i], reps[j]))
        here[dense[first[i] : first[i + 1]]] = 0
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def class_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """rep, name_a, name_b, shingles: the set of each class, also where rows of one doc_id have several."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets, first = shingle_sets(batch.column("text"), k)
            name_a, name_b = names(sets, first)
            shingles = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(name_a.view(np.int64)), pa.array(name_b.view(np.int64)), shingles], ["rep", "name_a", "name_b", "shingles"])

    texts = id_and_text(docs).join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    return texts.mapInArrow(name, "rep long, name_a long, name_b long, shingles array<long>").dropDuplicates(["rep", "name_a", "name_b"])


def confirmed(docs: DataFrame, classes: DataFrame, near: DataFrame, k: int, percent: int, block_shingles: int) -> DataFrame:
    """Links (a, b) between classes, confirmed on full sets."""
    hoods = components(near)
    sized = stored(hoods.join(classes.select("rep", "name_a", "name_b", "n_shingles", "sketch"), hoods.node == F.col("rep")).select("rep", "name_a", "name_b", F.col("component").alias("hood"), "n_shingles", "sketch"), "hoods")
    parts = stored(sized.groupBy("hood").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("parts")), "parts")
    dealt = sized.join(parts, "hood").withColumn("block", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    meeting = (
        dealt.join(class_sets(docs, dealt, k), ["rep", "name_a", "name_b"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("hood", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "rep", "sketch", "shingles")
    )

    def meet(members: pd.DataFrame) -> pd.DataFrame:
        return set_links(members, percent)

    return meeting.groupBy("hood", "first", "second").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest doc_id linked with it, through others too)
    and kept (it is that document).

    Two documents are linked if 100 * shared shingles >= percent * all shingles of both. A text of fewer than k
    words is one shingle; a text without words, or null, has none and is linked with nothing. Rows that repeat
    a doc_id are one document, whose likeness each text of it may bring; a null doc_id is linked with nothing.
    """
    signed = stored(signature_table(docs, k), "signatures")
    name = ["name_a", "name_b", "n_shingles"]
    named = signed.where("n_shingles > 0 and doc_id is not null")
    reps = stored(named.groupBy(*name).agg(F.min("doc_id").alias("rep")), "classes")
    classes = stored(
        named.join(reps, (named.doc_id == reps.rep) & (named.name_a == reps.name_a) & (named.name_b == reps.name_b), "left_semi")
        .select(F.col("doc_id").alias("rep"), named.name_a, named.name_b, "n_shingles", "bands", "sketch")
        .dropDuplicates(["rep", "name_a", "name_b"]),
        "representatives",
    )
    near = stored(candidates(classes), "candidates")
    groups = components(confirmed(docs, classes, near, k, percent, block_shingles))
    known = stored(reps.join(groups, reps.rep == groups.node, "left").select(*name, F.coalesce("component", "rep").alias("component_id")), "named")
    rows = signed.select("doc_id", *name).join(known, name, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, one document of each group."""
    gone = stored(near_duplicates(docs, k, percent).where("not kept").select("doc_id").distinct(), "copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
