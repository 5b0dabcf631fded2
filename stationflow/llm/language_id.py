"""Language of mixed-language text: script ranges, scores per word, Viterbi with a switching penalty.

Words are runs of letters, lower-cased. A word's score for a language is the log-probability of its character trigrams
(ends marked) there, from counts in 65,536 hash buckets over all training rows; short words also count whole. A word's
script, by ranges of code points, narrows the candidates to the languages that were seen to use it. Viterbi over a
text's words then labels spans, where each change of language costs a penalty. The language with the most letters
wins, and its share of the letters is the score.

The model is languages * 65,568 counts: its size depends on the number of languages alone, not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationflow.llm.common import PIECE_BYTES, bounded_batches, id_and_text, mix, pieces, stored, unused_prefix

BUCKETS = 1 << 16
SWITCH_PENALTY = 10.0
SMOOTHING = 0.5
#: A language uses a script if at least this share of its words do.
SCRIPT_SHARE = 0.001
#: Score of a language whose scripts do not hold the word's.
WRONG_SCRIPT = -1e4
UNKNOWN = "und"
#: Share of the training rows that a language must have to be learned.
LEAST_SHARE = 1 / 200
#: Scores (words times languages) held at once.
MOST_SCORES = 1 << 26

#: First code point of each range, and its script.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"), (0x30000, "other"),
]
NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@dataclass(frozen=True)
class Grams:
    """Words of some texts: row, first and last code point, script, letters; buckets of their trigrams, one word's after another's."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    bucket: np.ndarray
    first: np.ndarray


def grams(texts: list[str]) -> Grams:
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    is_letter = letters()[chars]
    begins, ends = is_letter.copy(), is_letter.copy()
    begins[1:] &= ~is_letter[:-1]
    ends[:-1] &= ~is_letter[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(chars))]
    begins[inner] = is_letter[inner]
    ends[inner - 1] = is_letter[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    length = end - start
    # a trigram around each letter, code 1 beyond the word's ends, and one bucket for the whole of a short word
    many = length + 1
    first = np.concatenate([[0], np.cumsum(many)])
    at = np.flatnonzero(is_letter)
    here = chars[at].astype(np.uint64)
    word = np.repeat(np.arange(len(start)), length)
    before = np.where(at > start[word], chars[np.maximum(at - 1, 0)], 1).astype(np.uint64)
    after = np.where(at + 1 < end[word], chars[np.minimum(at + 1, max(len(chars) - 1, 0))], 1).astype(np.uint64)
    bucket = np.zeros(int(first[-1]), np.int32)
    bucket[at - start[word] + first[word]] = (mix(before << np.uint64(42) | here << np.uint64(21) | after) >> np.uint64(48)).astype(np.int32)
    if len(start):
        place = (at - start[word]).astype(np.uint64)
        whole = np.add.reduceat(mix(here + place * np.uint64(0x110000)), first[:-1] - np.arange(len(start)))
        bucket[first[1:] - 1] = np.where(length <= 5, (mix(whole) >> np.uint64(48)).astype(np.int32), bucket[first[:-1]])
    script = _SCRIPT[np.searchsorted(_STARTS, chars[start], side="right") - 1] if len(start) else np.zeros(0, np.int64)
    return Grams(row, start - offsets[row], end - offsets[row], script, bucket, first)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # language, bucket: log-probability
    uses: np.ndarray  # script, language: 0, or WRONG_SCRIPT


def held_out(doc_id="doc_id"):
    """Rows that no model learns from; a null id counts as an empty text and is held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, least_share: float = LEAST_SHARE) -> Model:
    """Counts over the training rows (text and lang not null, not held out).

    A language is learned if `least_share` of these rows or more have it, so there are 1 / least_share at most, and the model has a
    bounded size whatever else the column holds. With 0 every value of the column is learned, and each takes 262 KB.
    """
    bounded_batches(docs.sparkSession)
    width = BUCKETS + len(NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])

        for batch in pieces(batches):
            found = grams(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist(), object)
            own = langs[found.row] if len(found.row) else np.zeros(0, object)
            per_gram = np.repeat(own, np.diff(found.first))
            for lang in set(langs.tolist()):
                if len(held) >= 64 and lang not in held:  # many languages: send what there is
                    yield from out()
                    held.clear()
                counts = held.setdefault(lang, np.zeros(width, np.int64))
                counts[:BUCKETS] += np.bincount(found.bucket[per_gram == lang], minlength=BUCKETS)
                counts[BUCKETS:] += np.bincount(found.script[own == lang], minlength=len(NAMES))
        yield from out()

    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    if least_share:
        per_lang = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
        total = per_lang.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        known = [r.lang for r in per_lang.where(F.col("n") >= least_share * total).select("lang").collect()]
        rows = rows.where(F.col("lang").isin(known)) if known else rows.limit(0)
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.zeros((len(languages), width))
    table[np.searchsorted(languages, counts["lang"].to_numpy()) if languages else [], counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    languages = [x for x, n in zip(languages, table[:, BUCKETS:].sum(axis=1), strict=True) if n]
    table = table[table[:, BUCKETS:].sum(axis=1) > 0]
    words = table[:, BUCKETS:]
    uses = np.where(words >= SCRIPT_SHARE * words.sum(axis=1, keepdims=True), 0.0, WRONG_SCRIPT)
    uses[:, uses.max(axis=0, initial=WRONG_SCRIPT) < 0] = 0.0  # a script that nobody uses narrows nothing
    scores = np.empty((len(languages), BUCKETS), np.float32)
    for k, own in enumerate(table):
        smooth = own[:BUCKETS] + SMOOTHING
        scores[k] = np.log(smooth / smooth.sum())
    return Model(languages, scores, uses.T.astype(np.float32))


def viterbi(scores: np.ndarray, row: np.ndarray, rows: int, penalty: float) -> np.ndarray:
    """Label of each word: the best path of each row's words, all rows side by side, the longest first."""
    counts = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    order = np.argsort(-counts, kind="stable")
    active = np.searchsorted(-counts[order], -np.arange(1, counts.max(initial=0) + 1), side="right")
    n, languages = scores.shape
    back = np.zeros((n, languages), np.int16)
    own = np.arange(languages, dtype=np.int16)
    total = np.zeros((rows, languages), np.float64)
    starts = first[order]
    for t, live in enumerate(active.tolist()):
        at = starts[:live] + t
        now = total[:live]
        if t:
            best = now.argmax(axis=1)
            top = now[np.arange(live), best][:, None] - penalty
            stays = now >= top
            back[at] = np.where(stays, own, best[:, None])
            now = np.where(stays, now, top)
        total[:live] = now + scores[at]
    label = np.zeros(n, np.int16)
    last = total.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        at = starts[: active[t]] + t
        label[at] = last[: active[t]]
        last[: active[t]] = back[at, label[at]]
    return label


def label(texts: list[str], model: Model, penalty: float) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """Language, score and labelled spans (code points of the lower-cased text) of each text."""
    found = grams(texts)
    n = len(texts)
    names, share, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    if not len(found.row) or not model.languages:
        return names, share, spans
    scores = model.uses[found.script]
    for k in range(len(model.languages)):
        scores[:, k] += np.add.reduceat(model.scores[k][found.bucket], found.first[:-1])
    labels = viterbi(scores, found.row, n, penalty)
    sizes = np.zeros((n, len(model.languages)), np.int64)
    np.add.at(sizes, (found.row, labels), found.end - found.start)
    total = sizes.sum(axis=1)
    for i in np.flatnonzero(total).tolist():
        names[i] = model.languages[int(sizes[i].argmax())]
        share[i] = sizes[i].max() / total[i]
    change = np.flatnonzero((np.diff(found.row) != 0) | (np.diff(labels) != 0)) + 1
    for a, b in zip(np.append(0, change).tolist(), np.append(change, len(labels)).tolist(), strict=True):
        spans[found.row[a]].append({"start": int(found.start[a]), "end": int(found.end[b - 1]), "lang": model.languages[labels[a]]})
    return names, share, spans


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, prefix: str = "") -> DataFrame:
    """docs with lang_pred, score and lang_spans (their names after `prefix`; columns so named are replaced).

    A text that is null, empty or without letters is `und`, with score 0 and no spans. lang_pred is the first in
    alphabetical order of the languages with the most letters.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    new = [f"{prefix}{c}" for c in ("lang_pred", "score", "lang_spans")]
    rows = docs.drop(*new)
    held = spark.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
    kinds = [pa.string(), pa.float64(), pa.list_(span)]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a word has two bytes or more
        most = min(PIECE_BYTES, 2 * MOST_SCORES // max(len(held.value.languages), 1))
        for batch in pieces(batches, most):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for column, kind, name in zip(label(texts, held.value, penalty), kinds, new, strict=True):
                batch = batch.append_column(name, pa.array(column, kind))
            yield batch

    added = StructType.fromDDL(f"`{new[0]}` string, `{new[1]}` double, `{new[2]}` array<struct<start:long,end:long,lang:string>>")
    return rows.mapInArrow(mark, StructType([*rows.schema.fields, *added.fields]))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and number of spans of every row, by a model of the training rows and all their languages."""
    found = identify(id_and_text(docs), fit(docs, least_share=0))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("lang_spans").cast("long").alias("n_spans"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text has letters in identified spans, be it of one language or of many."""
    own = unused_prefix(docs)
    found = identify(docs, fit(docs), prefix=own)
    return found.where(F.col(f"{own}lang_pred") != UNKNOWN).select(*docs.columns)
