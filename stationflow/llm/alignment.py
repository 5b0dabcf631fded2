"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both token sequences spell the same bytes. A byte offset at which a token of each side ends is a shared cut. An interval of
tokens is split at the shared cut nearest to its middle, which is looked for by bisection among the other side's ends, and
both halves are split again. An interval without an inner cut is a leaf: a group of tokens of both sides.

The outermost cuts are known beforehand: neither tokenizer joins bytes across a space or line feed that follows a character
that isn't white space. So a text falls into chunks there, and a worker keeps the alignment of chunks it has met, up to a
bound. Chunks that are new to it are tokenized together and their intervals are split together, level by level.

Each row's distinct pairs of linked ids are stored with the number of their links. How many documents hold a pair is counted in
tasks first and then summed. The counts are a table of pairs of the two vocabularies, not of documents: while it has at most
`TABLE_PAIRS` rows, every task gets it and adds up the counts of its links. Beyond that, the rows' pairs are joined with it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, pieces, stored

#: Chunks that a worker keeps, and links of them all; a worker that has more keeps those it has met again, half as many at most.
KEPT_CHUNKS, KEPT_LINKS = 200_000, 3_000_000
#: Pairs in a table that every task may hold: 17 bytes each.
TABLE_PAIRS = 4_000_000
#: Pairs that a task counts before it hands the counts on.
COUNTED_PAIRS = 1 << 20
#: New chunks that are tokenized as one text, and the longest of them; longer ones go alone.
CHUNKS_AT_ONCE, CHUNK_CHARS = 64, 200

#: Where a text falls into chunks: before a space or line feed behind a character that isn't white space.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
BLANK_RUN = re.compile(r"\s[ \n]")

#: Fixed value: where byte-level vocabularies split a text before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What stands before new chunks that are tokenized, so that neither tokenizer sees them at the begin of a text.
CARRIER = " a"

#: Fixed values of the second tokenizer: the mark for a space, and pieces that stand for one byte.
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")

DIGEST = ("n_a", "n_b", "n_groups", "n_links")


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, in order."""
    if "\0" in text or BLANK_RUN.search(text):
        return CUT.split(text)
    parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return parts if parts[0] else parts[1:]


def byte_level() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where it shows, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Ids of texts by both tokenizers, and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_of = byte_level()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        special = {i for i, token in self.a.get_added_tokens_decoder().items() if token.special}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = token.encode() if i in special else bytes(bytes_of[c] for c in token)
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in special}
        #: The same merges in a faster library. It looks for them anew after each, so long chunks don't go there.
        self.fast = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.match(p)) else p.replace(SPACE_MARK, " ").encode() for p in pieces_b]
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.bits_b = len(self.bytes_b).bit_length()
        self.digits = max(len(str(len(self.bytes_a))), len(str(len(self.bytes_b))))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides of texts that begin with a space, which the second tokenizer adds by itself; None where the two
        don't both spell the text."""
        most = CHUNKS_AT_ONCE * CHUNK_CHARS + len(CARRIER)
        a = [self.fast.encode_ordinary(t) if len(t) <= most else self.a.encode(t, add_special_tokens=False).ids for t in texts]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for t, x, y in zip(texts, a, b, strict=True):
            own = t.encode()
            same = b"".join([self.bytes_a[i] for i in x]) == own and b"".join([self.bytes_b[i] for i in y]) == own
            out.append((x, y) if same else None)
        return out


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, intervals: np.ndarray) -> np.ndarray:
    """Leaf groups (a from, a to, b from, b to) of intervals of tokens that begin and end at shared cuts, in order.

    ends_a, ends_b: byte offset at which each token ends, rising over all tokens (tokens without bytes allowed).
    All intervals of a level are looked at together. Each looks at the token ends of side A next to its middle, then one
    further away on both sides, until bisection finds one among the ends of side B, or none is left.
    """
    leaves, todo = [], intervals
    while len(todo):
        a0, a1, b0, b1 = todo.T
        middle, cut_a, cut_b = (a0 + a1) // 2, np.full(len(todo), -1), np.full(len(todo), -1)
        active, step = np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1)), 0
        while len(active):
            for side in (middle[active] - step, middle[active] + step) if step else (middle[active],):
                inside = (side > a0[active]) & (side < a1[active]) & (cut_a[active] < 0)
                at, probe = active[inside], side[inside]
                end = ends_a[probe - 1]
                found = np.searchsorted(ends_b, end, side="right")  # the tokens of B that end up to there
                hit = (found > b0[at]) & (found < b1[at])
                hit[hit] = ends_b[found[hit] - 1] == end[hit]
                hit &= ends_a[np.minimum(probe, len(ends_a) - 1)] > end  # tokens without bytes stay with the one before
                cut_a[at[hit]], cut_b[at[hit]] = probe[hit], found[hit]
            step += 1
            open_ = (cut_a[active] < 0) & ((middle[active] - step > a0[active]) | (middle[active] + step < a1[active]))
            active = active[open_]
        done = cut_a < 0
        leaves.append(todo[done])
        a0, a1, b0, b1, cut_a, cut_b = (x[~done] for x in (a0, a1, b0, b1, cut_a, cut_b))
        todo = np.concatenate([np.stack([a0, cut_a, b0, cut_b], axis=1), np.stack([cut_a, a1, cut_b, b1], axis=1)])
    every = np.concatenate(leaves) if leaves else intervals
    return every[np.argsort(every[:, 0], kind="stable")]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    return np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(int(size.sum()))


def written(ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text, `a1,a2|b1;`, each with its semicolon: all bytes, and where each group's end."""
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    first = np.append(0, np.cumsum(n_a + n_b))
    place_a = _ranges(first[:-1], n_a)
    place_b = _ranges(first[:-1] + n_a, n_b)
    ids, marks = np.empty(first[-1], np.int64), np.full(first[-1], ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a[_ranges(groups[:, 0], n_a)], ids_b[_ranges(groups[:, 2], n_b)]
    marks[first[:-1] + n_a - 1], marks[first[1:] - 1] = ord("|"), ord(";")
    cells = np.empty((len(ids), digits + 1), np.uint8)
    rest = ids.copy()
    for k in range(digits - 1, -1, -1):
        cells[:, k] = rest % 10 + 48
        rest //= 10
    cells[:, digits] = marks
    size = np.searchsorted(10 ** np.arange(1, digits), ids, side="right") + 1
    keep = np.arange(digits + 1) >= digits - size[:, None]
    return cells[keep], np.cumsum(np.add.reduceat(size + 1, first[:-1])) if len(groups) else np.zeros(0, np.int64)


class Aligner:
    """Alignments of chunks; those met before are kept in flat arrays."""

    def __init__(self, path_a: str, path_b: str):
        self.tok = tokenizers(path_a, path_b)
        #: chunk -> its place in the arrays below; -1 if the two sides don't both spell it.
        self.known: dict[str, int] = {}
        self.names: list[str] = []
        #: How often each chunk was met.
        self.met = np.zeros(0, np.int64)
        #: n_a, n_b, n_groups, n_links of each chunk.
        self.sizes = np.zeros((0, 4), np.int64)
        #: Groups as text, and a pair (a << bits_b | b) for each link; where each chunk's begin (one more: the end).
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.pairs, self.pairs_at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keep the chunks met most often, of those met more than once."""
        again = np.flatnonzero(self.met > 1)
        kept = np.sort(again[np.argsort(-self.met[again], kind="stable")][: KEPT_CHUNKS // 2])
        links = np.diff(self.pairs_at)[kept]
        kept = kept[: int(np.searchsorted(np.cumsum(links), KEPT_LINKS // 2, side="right"))]
        for name in ("text", "pairs"):
            at = getattr(self, f"{name}_at")
            size = np.diff(at)[kept]
            setattr(self, name, getattr(self, name)[_ranges(at[kept], size)])
            setattr(self, f"{name}_at", np.append(0, np.cumsum(size)))
        self.sizes, self.met = self.sizes[kept], np.zeros(len(kept), np.int64)
        self.names = [self.names[i] for i in kept.tolist()]
        self.known = dict(zip(self.names, range(len(self.names)), strict=True))

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that aren't known yet."""
        # A chunk that ends in white space ends its text, so none may follow it.
        short = [c for c in chunks if len(c) <= CHUNK_CHARS and not c[-1].isspace()]
        sets = [short[i : i + CHUNKS_AT_ONCE] for i in range(0, len(short), CHUNKS_AT_ONCE)]
        sets += [[c] for c in set(chunks).difference(short)]
        found = self.tok.encode([CARRIER + "".join(x) for x in sets])
        odd = [[c] for x, ids in zip(sets, found, strict=True) if ids is None and len(x) > 1 for c in x]
        sets, found = sets + odd, found + self.tok.encode([CARRIER + x[0] for x in odd])
        self.known.update((x[0], -1) for x, ids in zip(sets, found, strict=True) if ids is None and len(x) == 1)
        spelled = [(x, ids) for x, ids in zip(sets, found, strict=True) if ids is not None]
        if not spelled:
            return
        names = [c for x, _ in spelled for c in x]
        flat_a, flat_b = (np.concatenate([np.array(ids[side], np.int64) for _, ids in spelled]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.tok.length_a[flat_a]), np.cumsum(self.tok.length_b[flat_b])
        size = np.array([len(c.encode()) for c in names])
        carrier = np.zeros(len(names), np.int64)
        carrier[np.cumsum([0, *(len(x) for x, _ in spelled[:-1])])] = len(CARRIER)
        stop = np.cumsum(size + carrier)
        start = stop - size
        (a0, a1), (b0, b1) = [[np.searchsorted(ends, x, side="right") for x in (start, stop)] for ends in (ends_a, ends_b)]
        if not all((ends[np.maximum(at, 1) - 1] == x).all() for ends, at, x in ((ends_a, a0, start), (ends_a, a1, stop), (ends_b, b0, start), (ends_b, b1, stop))):
            raise ValueError("a tokenizer joins bytes across the begin of a chunk")
        groups = shared_cuts(ends_a, ends_b, np.stack([a0, a1, b0, b1], axis=1))
        first = np.append(np.searchsorted(groups[:, 0], a0), len(groups))  # groups of each chunk
        size_a, size_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
        links = size_a * size_b
        row, k = np.repeat(np.arange(len(groups)), links), _ranges(np.zeros(len(groups), np.int64), links)
        pairs = flat_a[groups[row, 0] + k // size_b[row]] << self.tok.bits_b | flat_b[groups[row, 2] + k % size_b[row]]
        linked = np.append(0, np.cumsum(links))[first]
        text, text_end = written(flat_a, flat_b, groups, self.tok.digits)
        self.known.update(zip(names, range(len(self.names), len(self.names) + len(names)), strict=True))
        self.names += names
        self.met = np.append(self.met, np.zeros(len(names), np.int64))
        self.sizes = np.concatenate([self.sizes, np.stack([a1 - a0, b1 - b0, np.diff(first), np.diff(linked)], axis=1)])
        self.text_at = np.concatenate([self.text_at, len(self.text) + np.append(0, text_end)[first][1:]])
        self.pairs_at = np.concatenate([self.pairs_at, len(self.pairs) + linked[1:]])
        self.text, self.pairs = np.concatenate([self.text, text]), np.concatenate([self.pairs, pairs])

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the texts' chunks, one text after the other, and how many each has: none without tokens."""
        split = [chunks_of(" " + t) if t else [] for t in texts]
        if len(self.known) > KEPT_CHUNKS or len(self.pairs) > KEPT_LINKS:
            self.forget()
        new = list(set().union(*split).difference(self.known))
        if new:
            self.learn(new)
        found = [list(map(self.known.__getitem__, chunks)) for chunks in split]
        found = [[] if -1 in x else x for x in found]
        place = np.fromiter(chain.from_iterable(found), np.int64)
        self.met += np.bincount(place, minlength=len(self.met))
        return place, np.array([len(x) for x in found], np.int64)

    def rows(self, texts: list[str]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs and their links of each text."""
        place, n = self.places(texts)
        row = np.repeat(np.arange(len(n)), n)
        sizes = np.zeros((len(n), 4), np.int64)
        for k in range(4):
            sizes[:, k] = np.bincount(row, self.sizes[place, k], len(n))
        length = np.diff(self.text_at)[place]
        data = self.text[_ranges(self.text_at[place], length)].tobytes()
        end = np.cumsum(np.bincount(row, length, len(n)).astype(np.int64))
        sums = [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]
        many = np.diff(self.pairs_at)[place]
        bits = self.tok.bits_b + len(self.tok.bytes_a).bit_length()
        code = np.sort((np.repeat(row, many) << bits) + self.pairs[_ranges(self.pairs_at[place], many)])
        at = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        bounds = pa.array(np.searchsorted(code[at] >> bits, np.arange(len(n) + 1)).astype(np.int32))
        pairs = pa.array(code[at] & ((1 << bits) - 1))
        times = pa.array(np.diff(np.append(at, len(code))))
        return [*(pa.array(sizes[:, k]) for k in range(4)), pa.array(sums, pa.string()), pa.ListArray.from_arrays(bounds, pairs), pa.ListArray.from_arrays(bounds, times)]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct) and times (links of each)."""
    bounded_batches(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            cells = aligner(path_a, path_b).rows(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cells], ["doc_id", *DIGEST, "groups_sha256", "pairs", "times"])

    kinds = ", ".join(f"{c} long" for c in DIGEST)
    return id_and_text(docs).mapInArrow(digest, f"doc_id long, {kinds}, groups_sha256 string, pairs array<long>, times array<long>")


def count_pairs(aligned: DataFrame) -> DataFrame:
    """pair, n: how many rows hold it linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column("pairs").flatten().to_numpy())
            size += len(held[-1])
            if size >= COUNTED_PAIRS:
                yield _counted(held)
                held, size = [], 0
        if size:
            yield _counted(held)

    return aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    pairs, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])


def with_best(counted: DataFrame, bits_b: int) -> DataFrame:
    """Counts with best: whether no pair of the same A id has a higher one. An id of A has at most a vocabulary of pairs."""
    same_a = Window.partitionBy(F.shiftright("pair", bits_b))
    return counted.select("pair", "n", (F.col("n") == F.max("n").over(same_a)).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, as the contract has them.

    A text that is null, empty or not spelled by both tokenizers has zeros and ''. Rows that repeat a doc_id, or have none, are
    documents of their own, also in the counts.
    """
    aligned = stored(alignments(docs, path_a, path_b), "alignments")
    counts = stored(with_best(count_pairs(aligned), tokenizers(path_a, path_b).bits_b), "pair_counts")
    made = _summed(aligned, counts) if counts.count() <= table_pairs else _joined(aligned, counts)
    return made.select("doc_id", *DIGEST, "n_best", "count_sum", "groups_sha256")


def _summed(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums over links with the table of counts in every task: 17 bytes for each of at most TABLE_PAIRS rows."""
    rows = counts.orderBy("pair").toPandas()
    held = aligned.sparkSession.sparkContext.broadcast((rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(bool)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = held.value
        for batch in batches:
            size = batch.column("pairs").value_lengths().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            at = np.searchsorted(known, batch.column("pairs").flatten().to_numpy())
            times = batch.column("times").flatten().to_numpy()
            sums = [np.zeros(len(size), np.int64) for _ in range(2)]
            for total, weight in zip(sums, (best, n), strict=True):
                np.add.at(total, row, times * weight[at])
            columns = [batch.column(c) for c in ("doc_id", *DIGEST, "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], ["doc_id", *DIGEST, "groups_sha256", "n_best", "count_sum"])

    kinds = ", ".join(f"{c} long" for c in DIGEST)
    return aligned.mapInArrow(add, f"doc_id long, {kinds}, groups_sha256 string, n_best long, count_sum long")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums over links by a join, for tables too large for a task. A row's pairs are distinct, and a task adds up what it has of
    a row before the sums meet."""
    made = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment_rows")
    links = made.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return made.join(sums, "row", "left").withColumn("n_best", F.coalesce("n_best", zero)).withColumn("count_sum", F.coalesce("count_sum", zero))
