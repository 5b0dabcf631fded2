"""Suffix-array dedup, cross-tokenizer alignment and embedding whitening against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import alignment, suffix_dedup, whitening
from stationflow.llm.queries import QUERIES, tokenizer_path
from tests.llm.conftest import DOCS

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# -- suffix-array dedup --------------------------------------------------------------------------------


def without_repeated_bytes(docs, least):
    seen = {}
    for i, text in docs:
        data = (text or "").encode()
        if i is not None:
            for p in range(len(data) - least + 1):
                window = data[p : p + least]
                seen[window] = min(i, seen.get(window, i))
    out = []
    for i, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for p in range(len(data) - least + 1):
                if seen[data[p : p + least]] < i:
                    gone[p : p + least] = b"\1" * least
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def deduped(df, **settings):
    return sorted((tuple(r) for r in suffix_dedup.dedup_bytes(df, digest=True, **settings).collect()), key=repr)


def test_repeated_bytes_of_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_suffix_dedup"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == without_repeated_bytes(docs, 50)


@pytest.mark.parametrize(("least", "letters", "hot"), [(50, "ab", 20_000), (50, "abé", 1), (20, "ab", 1), (8, "abc", 20_000), (11, "aé", 1)])
def test_repeated_bytes_of_pieced_texts(spark, least, letters, hot):
    draw = random.Random(least)
    base = ["".join(draw.choice(letters) for _ in range(draw.randrange(300))) for _ in range(15)]
    docs = [(draw.randrange(60), "".join(draw.choice(base)[draw.randrange(50) :][: draw.randrange(10, 200)] for _ in range(draw.randrange(6)))) for _ in range(80)]
    docs += [(None, base[0]), (None, base[0]), (None, None), (7, None), (3, ""), (70, "a" * 3000), (71, "a" * 200), (72, docs[4][1]), (73, docs[4][1]), (1, "\0" * 200), (5, "\0" * 120 + "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert deduped(df, least=least, hot_least=hot) == without_repeated_bytes(docs, least)


def test_long_texts_go_in_slices(spark):
    draw = random.Random(2)
    text = "".join(draw.choice("abcdefgh ") for _ in range(suffix_dedup.RUN_BYTES * 2 + 100))
    cut = suffix_dedup.RUN_BYTES
    docs = [(1, text), (2, "own " + text[cut - 60 : cut + 60] + " end"), (3, text[:10] + "!" + text[cut - 30 : cut + 19]), (4, text[cut - 30 : cut + 20])]
    found = {r[0]: r[1:4] for r in deduped(spark.createDataFrame(docs, "doc_id long, text string"))}
    assert found == {1: (len(text), 0, 0), 2: (128, 120, 1), 3: (60, 0, 0), 4: (50, 50, 1)}


def test_repeated_bytes_of_odd_rows(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert deduped(odd_docs) == without_repeated_bytes(docs, 50)
    assert deduped(no_docs) == []
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_bytes(odd_docs).where("doc_id in (4, 104)").collect()}
    assert kept == {4: b"x" * 70_000, 104: b""}
    with pytest.raises(ValueError):
        suffix_dedup.dedup_bytes(odd_docs, least=7)


def test_passes_end_where_one_owner_is_left():
    words = np.array([[1, 1], [1, 1], [1, 2], [3, 1], [3, 1]], np.uint64)
    asked = []

    def digit(items, k):
        asked.append(len(items))
        return words[items, k]

    items, group = suffix_dedup.repeated_groups(digit, 2, np.array([1, 2, 2, 5, 5]))
    assert sorted(items.tolist()) == [0, 1] and len(set(group.tolist())) == 1
    assert asked == [5, 3]


# -- cross-tokenizer alignment -------------------------------------------------------------------------


def aligned_plainly(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    known = alignment.tokenizers(tokenizer_path(A), tokenizer_path(B))
    made, counts = [], Counter()
    for _, text in docs:
        made.append(None)
        if not text:
            continue
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        if any(b"".join(table[i] for i in ids) != (" " + text).encode() for table, ids in ((known.bytes_a, a), (known.bytes_b, b))):
            continue
        ends_a, ends_b = (np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((known.bytes_a, a), (known.bytes_b, b)))
        groups, low = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            groups.append(tuple([i for i, e in zip(ids, ends) if low < e <= cut] for ids, ends in ((a, ends_a), (b, ends_b))))
            low = cut
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        counts.update(links.keys())
        made[-1] = (len(a), len(b), groups, links)
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    out = []
    for (i, _), found in zip(docs, made):
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        n_best = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        out.append((i, n_a, n_b, len(groups), links.total(), n_best, sum(n * counts[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


ODD_TEXTS = [
    None, "", " ", "  a  b", "x" * 3000, "a\n\n b\n \nc  \n d", "<|endoftext|> </s> <0x41>", "日本語 テキスト　x", "\x00\x0b\x1c a\x1c b", "é́ ﬁ   x", "▁ a▁b", "a\r\n b\tc\n", "\n", "\n a",
    "﻿abc", "a \n b", "�", "Ünï cödé 日本語 текст \U0001f600", "it's  they'll\n'quoted' 12 345", "tab\t\tend ", "trailing  ", "a b  c", "same text", "same text",
]


@pytest.mark.parametrize("table", [alignment.TABLE_PAIRS, 0])
def test_alignments_of_odd_texts(spark, table):
    docs = [(i if i % 5 else None, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_a int, pairs string").repartition(3)
    found = alignment.align(df, tokenizer_path(A), tokenizer_path(B), table_pairs=table)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == aligned_plainly(docs)
    assert alignment.align(df.limit(0), tokenizer_path(A), tokenizer_path(B), table_pairs=table).count() == 0


def test_alignments_of_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_cross_tokenizer_alignment"](spark, sf_dir)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == aligned_plainly(docs)


def test_chunks_that_a_worker_forgets(monkeypatch):
    own = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    texts = [f"word{i} and some more {i % 3}" for i in range(40)]
    whole = [x.to_pylist() for x in own.rows(texts)]
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 10)
    again = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    parts = [again.rows(texts[i : i + 8]) for i in range(0, 40, 8)]
    assert [[y for p in parts for y in p[k].to_pylist()] for k in range(len(whole))] == whole
    assert len(again.known) < len(own.known)


@pytest.mark.parametrize("seed", range(20))
def test_divide_and_conquer_finds_every_shared_cut(seed):
    draw = random.Random(seed)
    n = draw.randrange(1, 60)
    sides = [sorted({n, *(draw.randrange(1, n + 1) for _ in range(draw.randrange(40)))}) for _ in range(2)]
    ends = [np.array(s) for s in sides]
    found = alignment.shared_cuts(*ends, np.array([[0, len(sides[0]), 0, len(sides[1])]]))
    assert ends[0][found[:, 1] - 1].tolist() == sorted(set(sides[0]) & set(sides[1]))
    assert ends[1][found[:, 3] - 1].tolist() == sorted(set(sides[0]) & set(sides[1]))
    assert found[0, [0, 2]].tolist() == [0, 0] and (found[1:, [0, 2]] == found[:-1, [1, 3]]).all()


# -- embedding whitening -------------------------------------------------------------------------------


def whitened_plainly(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    v = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    values, parts = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    return y, (x - sums / n) @ parts[:, order] / np.sqrt(values[order]), values[order] / np.trace(v)


def test_whitening_of_embeddings(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect())
    found = QUERIES["op13_embedding_whitening"](spark, sf_dir).toPandas()
    y, scores, explained = whitened_plainly([r.embedding for r in rows])
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == 8 * len(rows) and set(found["n"]) == {len(rows)}
    table = found.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    signs = np.sign((table.to_numpy() * scores).sum(axis=0))
    assert np.allclose(table.to_numpy() * signs, scores, atol=1e-9)
    assert found.groupby("vec_id")["deviation"].first().sort_index().tolist() == (y * y).sum(axis=1).tolist()
    assert np.allclose(found.groupby("component")["explained"].first(), explained, rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1 * i, (i * i % 7) / 3, 1.0] for i in range(12)]
    rows = [(i if i else None, v, "w", 5) for i, v in enumerate(good)] + [(3, good[3], None, None)]
    rows += [(100, None, "", 0), (101, [], "", 0), (102, [1.0, None, 2.0], "", 0), (103, [nan, 1.0, 2.0], "", 0), (104, [1.0, inf, 2.0], "", 0), (105, [1.0, 2.0], "", 0), (106, [1e300, 0.0, 0.0], "", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, n int").repartition(3)
    found = whitening.whiten(df).toPandas()
    y, scores, _ = whitened_plainly([*good, good[3]], 2)
    assert len(found) == 2 * 13 and set(found["component"]) == {1, 2}  # the third dimension is constant
    assert sorted(found["deviation"].tolist()) == sorted(np.repeat((y * y).sum(axis=1), 2).tolist())
    assert np.allclose(np.sort(np.abs(found["whitened"])), np.sort(np.abs(scores).ravel()), atol=1e-9)
    assert found["vec_id"].isna().sum() == 2 and found["identity_error"][0] < 1e-9
    for empty in (df.limit(0), df.where("vec_id > 99"), df.where("vec_id = 5")):
        assert whitening.whiten(empty).count() == 0


def test_variances_alone_give_exact_covariances():
    draw = np.random.default_rng(3)
    x = draw.integers(-(1 << 40), 1 << 40, (50, 4))
    sums = [int(s) for s in x.sum(axis=0)]
    totals = whitening.pair_squares(x, 50, sums)
    y = [[50 * int(c) - s for c, s in zip(row, sums)] for row in x.tolist()]
    for (i, j), total in totals.items():
        assert total == sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in y)
    v = whitening.covariance(totals, 50, 4)
    assert v[1, 2] == pytest.approx(sum(r[1] * r[2] for r in y) / 50**3, rel=1e-15)


def test_large_deviations_become_decimals(spark):
    df = spark.range(50).select(F.col("id").alias("vec_id"), F.array((F.col("id") * 1e9).cast("double"), F.col("id").cast("double")).alias("embedding"))
    found = whitening.whiten(df)
    assert dict(found.dtypes)["deviation"] == "decimal(38,0)"
    first = found.where("vec_id = 0 and component = 1").first()
    x = [int(1024 * i * 1e9) + 100_000 for i in range(50)], [1024 * i + 100_000 for i in range(50)]
    assert int(first.deviation) == sum((50 * c[0] - sum(c)) ** 2 for c in x)
