"""Packing of token sequences by best-fit decreasing.

Texts become ids task by task; ids of a white-space-separated chunk don't depend on its neighbours, so each worker keeps
the chunks it has met, up to a bound. A document longer than a window is first cut into full windows. What is left is dealt
to shards of about `shard_tokens` ids, and packed there: longest piece first, each into the open window with the least room
that still takes it. A segment tree over the possible remaining capacities finds that window.

Only the pieces' places move between tasks, not their ids; `sequences` joins ids and places where they are wanted.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, id_and_text, pieces, stored

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1 << 24
#: Pieces in one shard: many short documents fill a task's memory before their ids do.
SHARD_PIECES = 1 << 20
#: Chunks that a worker keeps, and the longest one it keeps.
KEPT_CHUNKS, KEPT_CHARS = 500_000, 48
#: Marks that end words most often.
MARKS = ".,!?;:"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of each chunk. Words of letters go in one run, which is cut behind the ids that end a word."""
        words = [c for c in chunks if c.isalpha()] if self.ends.any() else []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words):
            words, ends = [], ends[:0]
        data = ids.tobytes()
        out = {w: data[a:b] for w, a, b in zip(words, [0, *ends[:-1].tolist()], ends.tolist(), strict=False)}
        rest = [c for c in chunks if c not in out]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        return out | {c: np.array(e.ids, "<u4").tobytes() for c, e in zip(rest, found, strict=True)}

    def _chunks(self, text: str) -> list[str]:
        """Chunks between white space. The tokenizer folds case, so they are lower-cased, but not where that could
        change what it sees: a final sigma, a dotted I, or the names of special tokens."""
        if "<|" not in text and "\u03a3" not in text and "\u0130" not in text:
            text = text.lower()
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        if len(self.known) > KEPT_CHUNKS:
            self.known = {}
        new = set().union(*split).difference(self.known)
        # A mark behind a letter is a token of its own, so the word before it may be known or needed once only.
        marked = {c for c in new if len(c) > 1 and c[-1] in MARKS and c[-2].isalpha()}
        bare = {c[:-1] for c in marked}
        once = self._encode(list((new - marked | bare | set(MARKS)).difference(self.known)))
        look = ChainMap(once, self.known)
        once |= {c: look[c[:-1]] + look[c[-1]] for c in marked}
        self.known |= {c: ids for c, ids in once.items() if len(c) <= KEPT_CHARS}
        long = {c: ids for c, ids in once.items() if len(c) > KEPT_CHARS}
        known = self.known if not long else ChainMap(long, self.known)
        return [b"".join([known[c] for c in chunks]) for chunks in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, window: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full windows, then the rest."""
    n = len(ids) // 4
    return [(at, min(window, n - at)) for at in range(0, n, window)]


def piece_table(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: PIECES, and with keep_ids their ids (array). A null text is empty: one piece of end_id."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * keep_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            texts = batch.column("text").to_pylist()
            for doc, body in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer).encode(texts), strict=True):
                ids = body + end
                for at, n in cut(ids, window):
                    own = ids[4 * at : 4 * (at + n)]
                    row = (doc, at, n, zlib.crc32(own), len(ids) // 4)
                    rows.append((*row, np.frombuffer(own, "<i4").tolist()) if keep_ids else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return id_and_text(docs).mapInArrow(encode, PIECES + (", ids array<int>" if keep_ids else ""))


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree that tells which capacities there are."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.has = [0] * (2 * self.base)
        self.by_room: dict[int, list[int]] = {}

    def add(self, room: int, sequence: int) -> None:
        self.by_room.setdefault(room, []).append(sequence)
        at = room + self.base
        while at:
            self.has[at] += 1
            at >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least `length`: its room and number."""
        at = length + self.base
        if not self.has[at]:
            # up until a subtree to the right has a window, then down to its leftmost one
            while at > 1 and not (at % 2 == 0 and self.has[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if self.has[2 * at] else 2 * at + 1
        room = at - self.base
        sequence = self.by_room[room].pop()
        while at:
            self.has[at] -= 1
            at >>= 1
        return room, sequence


def best_fit(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """Sequence and offset of each length; they come in falling order."""
    open_windows, out, made = OpenWindows(window), [], 0
    for length in lengths:
        found = open_windows.tightest(length)
        if found is None:
            found, made = (window, made), made + 1
        room, sequence = found
        out.append((sequence, window - room))
        if room > length:
            open_windows.add(room - length, sequence)
    return out


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Repeated rows are packed as often as they come, and dealt to shards like all others; a null doc_id stays null. Sequences of a shard are numbered from
    shard * 2 ** 32 on.
    """
    cuts = stored(piece_table(docs, tokenizer, window, end_id), "pieces")
    size = cuts.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("pieces")).first()
    shards = max(1, math.ceil(size.tokens / shard_tokens), math.ceil(size.pieces / shard_pieces))
    # A row's place in the stored table deals equal pieces to different shards.
    dealt = cuts.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(shards))).drop("row")

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        at = best_fit(rows["length"].tolist(), window)
        rows["sequence_id"] = np.array([s for s, _ in at], np.int64) + (int(key[0]) << 32)
        rows["offset"] = np.array([o for _, o in at], np.int64)
        return rows.drop(columns="shard")

    return dealt.groupBy("shard").applyInPandas(place, PLACED)


def sequences(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids padded to the window.

    Ids and places meet by document, place and checksum; equal pieces of repeated rows share their ids.
    """
    key = ["doc_id", "start", "length", "ids_crc32"]
    ids = piece_table(docs, tokenizer, window, end_id, keep_ids=True).select(*key, "ids").dropDuplicates(key)
    placed = pack(docs, tokenizer, window, end_id).select(*key, "sequence_id", "offset")
    same = [placed[c].eqNullSafe(ids[c]) for c in key]
    met = placed.join(ids, same).select("sequence_id", "offset", "ids")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = met.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    padding = F.array_repeat(F.lit(pad_id), F.lit(window) - F.size("ids"))
    return whole.select("sequence_id", F.size("ids").cast("long").alias("length"), F.concat("ids", padding).alias("ids"))
