"""Operators that treat each text by itself: fingerprints, packing, personal data, language, quality."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationflow.llm import language_id, packing, pii, quality, winnowing
from stationflow.llm.queries import QUERIES, tokenizer_path
from tests.llm import brute
from tests.llm.conftest import DOCS


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


# Fingerprints


def test_edits_of_documents(spark, sf_dir):
    docs = documents(spark, sf_dir).sort_values("doc_id", ascending=False, ignore_index=True)
    found = {r.doc_id: r for r in QUERIES["op4_fingerprints"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    by_text, compared = {}, 0
    for i, (doc, text) in enumerate(zip(docs.doc_id, docs.text, strict=True)):
        n, following = len(text) // 3, docs.text[(i + 1) % len(docs)]
        edited = text[: len(text) - n] + following[:n]
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if len(text) + len(following) > 1500:  # the plain version takes its time
            continue
        compared += 1
        marks = [set(brute.winnowed(t, winnowing.K, winnowing.WINDOW)) for t in (text, edited, following)]
        assert [int(x.split(":")[1]) for x in r.fingerprint.split(",") if x] == [p for p, _ in sorted(marks[0])]
        grams = [{g for _, g in m} for m in marks]
        for near, other in ((r.near_edited, grams[1]), (r.near_next, grams[2])):
            assert near == pytest.approx(len(grams[0] & other) / len(grams[0] | other))
    assert compared > 5


def test_ranges_of_few_documents(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGE_MB", 1e-5)
    texts = {i * i * 7: f"text {i} " * (i % 5) for i in range(30)}
    rows = [(i, t) for i, t in texts.items()] + [(49, "again 49"), (None, "nobody"), (None, None)]
    found = winnowing.edit_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    order = [(i, t or "") for i, t in order]
    expected = []
    for (i, t), (_, f) in zip(order, order[1:] + order[:1], strict=True):
        edited = t[: len(t) - len(t) // 3] + f[: len(t) // 3]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == sorted(expected, key=repr)


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    found = winnowing.edit_fingerprints(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert all(r.fingerprint == "" for r in found if r.n_chars == 0)
    assert len({r.fingerprint for r in found if r.doc_id in (6, 106)}) == 1
    assert winnowing.edit_fingerprints(no_docs).count() == 0
    one = winnowing.edit_fingerprints(spark.createDataFrame([(1, "alone" * 20)], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    table = winnowing.fingerprint_table(odd_docs).where("doc_id = 4").first()
    assert table.positions[0] == winnowing.WINDOW - 1  # equal hashes: the rightmost


# Packing


def test_pieces_of_documents_cover_all_ids(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = dict(documents(spark, sf_dir)[["doc_id", "text"]].itertuples(index=False))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    found = QUERIES["op5_packing"](spark, sf_dir).toPandas()
    for r in found.itertuples():
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(own), zlib.crc32(own.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
    assert found.groupby("doc_id").length.sum().to_dict() == {i: len(a) for i, a in ids.items()}
    for _, rows in found.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 4096
    assert found.length.sum() / (4096 * found.sequence_id.nunique()) > 0.98


@pytest.mark.parametrize("text", ["<|endoftext|> a<|startoftext|>b", "ΣΑΣ Σ İstanbul", "é ́x ﬁ", "a b c\x1cd\x0be", "don't we'll 12345 a-b_c!?", "\U0001f600‍\U0001f600 \u0000", "x" * 500])
def test_chunks_give_the_ids_of_the_whole(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(tokenizer_path()).encode([text])[0], "<u4").tolist() == whole


def test_best_fit_is_the_tightest():
    draw = random.Random(2)
    lengths = sorted((draw.randrange(1, 101) for _ in range(400)), reverse=True)
    rooms, expected = [], []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        expected.append(100 - min(fits) if fits else 0)
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 100) - n)
    assert [at for _, at in packing.best_fit(lengths, 100)] == expected


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * i) for i in range(30)], "doc_id long, text string")
    whole = packing.sequences(docs, tokenizer_path(), window=64, pad_id=7).collect()
    parts = packing.piece_table(docs, tokenizer_path(), window=64, keep_ids=True).collect()
    assert all(len(r.ids) == 64 and set(r.ids[r.length :]) <= {7} for r in whole)
    assert sorted(x for r in whole for x in r.ids[: r.length]) == sorted(x for p in parts for x in p.ids)


def test_packing_of_odd_rows(odd_docs, no_docs):
    found = packing.pack(odd_docs, tokenizer_path(), window=512, shard_tokens=4000).collect()
    assert sum(r.start == 0 for r in found) == odd_docs.count()
    assert {(r.length, r.doc_tokens) for r in found if r.doc_id in (0, 1, 2)} == {(1, 1)}
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


# Personal data

TRICKY = [
    "a@b.c x@y d..e@f-g.h.i.j. k@l.m_n@o.p q@r-s@t.u @v.w", "mail a@b..c a@b.c- é@x.y a@b.cé", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 0256.1.1.1 000255.0.0.1 1.2.3.4.",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111114111111111111111", "+1 (988) 555-2485 +12345 +1-2-3-4-5-6-7-8-9 ++49 30 1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "\U0001f600 é 1.2.3.4 \U0001f600 a@b.co", "token = \"1beb58b8af68854f0e01b4ad40cdbb6a\" password=135299847ac0e0f0dc", "5", "+1 ", "1" * 3000 + "." * 50, "a" * 5000 + "@", "a@" + "b." * 4000 + "c",
]


def check_spans(found, texts):
    for r in found:
        base = brute.personal(texts[r.doc_id])
        assert [getattr(r, f"n_{k}") for k in brute.PII] == [sum(s[0] == k for s in base) for k in brute.PII]
        names = [":".join(map(str, s)) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r.spans.split(",")) | {""}


def test_base_spans_of_documents(spark, sf_dir):
    check_spans(QUERIES["op7_pii"](spark, sf_dir).collect(), dict(documents(spark, sf_dir)[["doc_id", "text"]].itertuples(index=False)))


def test_base_spans_of_tricky_texts(spark, odd_docs, no_docs):
    draw = random.Random(9)
    texts = dict(enumerate([*TRICKY, None, "", *("".join(draw.choice("a1@.+- 4(") for _ in range(200)) for _ in range(60))]))
    check_spans(pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)
    assert pii.personal_data(odd_docs).count() == odd_docs.count()
    assert pii.personal_data(no_docs).count() == 0


def test_estimation_tells_reliable_labelers(spark):
    draw = np.random.default_rng(4)
    truth = draw.random(4000) < 0.6
    reliable = [0.95, 0.9, 0.85, 0.6, 0.75, 0.7]
    rows = {}
    for t in truth:
        votes = tuple(int(v) for v in np.where(draw.random(6) < reliable, 1, -1) * (1 if t else -1))
        rows[votes] = rows.get(votes, 0) + 1
    patterns = spark.createDataFrame([("email", list(v), n) for v, n in rows.items()], "kind string, votes array<int>, n long")
    weights, priors = pii.estimate(patterns)
    assert np.allclose([1 / (1 + np.exp(-w)) for w in weights], reliable, atol=0.05)
    assert abs(1 / (1 + np.exp(-priors["email"])) - 0.6) < 0.05


def test_plans_of_personal_data_are_native(spark, sf_dir, capsys):
    pii.personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    pii.proposals(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    plans = capsys.readouterr().out
    assert "Python" not in plans and "Arrow" not in plans and "Cartesian" not in plans and "NestedLoop" not in plans


# Language


def test_languages_of_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf_dir).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in docs.doc_id)
    held = [(r.lang, found[r.doc_id].lang_pred) for r in docs.itertuples() if found[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(3)
    row = np.repeat([0, 2, 3], [4, 6, 1])
    scores = draw.normal(size=(11, 3)) * 2
    labels = language_id.viterbi(scores, row, 5, 1.5)
    for r in (0, 2, 3):
        own = scores[row == r]
        paths = np.stack(np.meshgrid(*[range(3)] * len(own), indexing="ij"), -1).reshape(-1, len(own))
        value = own[np.arange(len(own)), paths].sum(axis=1) - 1.5 * (np.diff(paths, axis=1) != 0).sum(axis=1)
        assert paths[value.argmax()].tolist() == labels[row == r].tolist()


def test_mixed_text_has_spans(spark):
    german, greek = "der hund und die katze sind im haus ", "ο σκύλος και η γάτα είναι στο σπίτι "
    french = "le chien et la vache sont dans les champs "
    rows = [(i, t * (2 + i % 3), lang, None, None) for i in range(60) for t, lang in ((german, "de"), (greek, "el"), (french, "fr"))]
    docs = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], DOCS)
    model = language_id.fit(docs)
    text = german * 3 + french * 3 + "σκύλος"
    names, share, spans = language_id.label([text, None or "", "123"], model, language_id.SWITCH_PENALTY)
    assert [s["lang"] for s in spans[0]] == ["de", "fr", "el"] and names == ["fr", "und", "und"] and 0.4 < share[0] < 0.6
    assert spans[0][1]["start"] == len(german * 3)


def test_documents_of_many_languages_stay(spark):
    of = {
        "de": "der hund und die katze sind im haus ", "el": "ο σκύλος και η γάτα είναι στο σπίτι ",
        "fr": "le chien et la vache sont dans les champs ", "ru": "собака и кошка живут в большом доме ",
    }
    rows = [(t * (2 + i % 3), lang) for i in range(60) for lang, t in of.items()] + [("".join(of.values()), None), ("123 ...", None)]
    docs = spark.createDataFrame([(n, *r, None, None) for n, r in enumerate(rows)], DOCS)
    share = {r.doc_id: r.score for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert 0 < share[240] < 0.5
    assert {r.doc_id for r in language_id.keep_identified(docs).collect()} == set(range(241))


def test_languages_of_odd_rows(odd_docs, no_docs):
    found = language_id.identify(odd_docs, language_id.fit(odd_docs))
    assert found.count() == odd_docs.count()
    assert {r.lang_pred for r in found.where("doc_id in (0, 1, 2, 3, 100, 8)").collect()} == {"und"}
    assert language_id.predict(no_docs).count() == 0
    assert language_id.keep_identified(odd_docs).columns == odd_docs.columns
    alone = language_id.predict(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in alone} == {"und"}


# Quality


def test_quality_of_documents(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = QUERIES["op10_quality_classifier"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in found)
    held = [labels[r.doc_id] == r.predicted for r in found if r.held_out and r.doc_id in labels]
    assert np.mean(held) > 0.85


def test_log_odds_are_those_of_the_densities():
    draw = np.random.default_rng(8)
    x = [draw.normal(size=(300, 4)) * [1, 2, 3, 1], draw.normal(size=(200, 4)) + 1]
    n = np.array([300.0, 200.0])
    model = quality.discriminant(n, np.stack([a.sum(axis=0) for a in x]), np.stack([a.T @ a for a in x]), 0.0, 0.0, 0.0)
    points = draw.normal(size=(20, 4))

    def density(a):
        spread = np.cov(a.T, bias=True)
        d = points - a.mean(axis=0)
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(spread), d) - 0.5 * np.linalg.slogdet(spread)[1]

    assert np.allclose(model.log_odds(points), density(x[1]) - density(x[0]) + np.log(201 / 301))


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)] + [(None, 1, 0), (3, None, 0), (4, 5, 0), (2, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.score_quality(odd_docs, labels).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.score_quality(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(no_docs, labels).count() == 0
    ones = quality.score_quality(odd_docs, labels.where("quality = 1")).collect()
    assert all(r.predicted == 1 for r in ones)
    assert np.isfinite(quality.statistics(pa.array(["", "a", "\n"]))).all()


def test_added_personal_data_is_found(spark):
    """Planted secrets, local phones and spelled-out addresses, some of them very long, among look-alikes."""
    draw = random.Random(8)
    token = lambda n: "".join(draw.choice("abcdef0123456789") for _ in range(n))
    words = lambda: " ".join(draw.choice("the of and house river".split()) for _ in range(draw.randrange(3, 12)))
    made = {
        "secret": lambda: f'{draw.choice(["token", "password", "api_key"])} = "{token(draw.choice([16, 40, 400, 5000]))}"',
        "local_phone": lambda: f"{draw.randrange(200, 999)}-{draw.randrange(200, 999)}-{draw.randrange(1000, 9999)}",
        "spaced_email": lambda: f"{draw.choice(['ana', 'li.wu', 'x' * 90])} at {draw.choice(['mail', 'host', 'y' * 80])} dot {draw.choice(['com', 'org'])}",
    }
    cue = {"secret": "config", "local_phone": "call", "spaced_email": "mail"}
    rows, planted = [], {}
    for i in range(900):
        kind = draw.choice(list(made))
        plant, before = made[kind](), f"{words()} {cue[kind]} "
        rows.append((i, f"{before}{plant} {words()}", None, None, None))
        planted[i] = f"{kind}:{len(before)}:{len(before) + len(plant)}"
    decoys = [f"{words()} version {draw.randrange(1000)}.{draw.randrange(1000)} token of {words()} at the dot {words()}" for _ in range(900)]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(decoys)]
    found = {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.personal_data(spark.createDataFrame(rows, DOCS)).collect()}
    for kind in made:
        own = [i for i, span in planted.items() if span.startswith(kind)]
        assert sum(planted[i] in found[i] for i in own) >= 0.9 * len(own)
    added = {i: [s for s in spans if s.partition(":")[0] in made] for i, spans in found.items()}  # digits of a token may pass for a card
    assert sum(planted[i] in found[i] for i in planted) >= 0.9 * sum(map(len, added.values()))
    assert sum(bool(added[1000 + i]) for i in range(len(decoys))) <= 9


def test_equal_pieces_are_dealt_to_shards(spark):
    rows = [(None, "same text", None, None, None)] * 500 + [(7, "same text", None, None, None)] * 500
    placed = packing.pack(spark.createDataFrame(rows, DOCS).repartition(4), tokenizer_path(), window=64, shard_pieces=100).collect()
    shards = Counter(r.sequence_id >> 32 for r in placed)
    assert len(placed) == 1000 and len(shards) == 10 and max(shards.values()) < 200
    whole = packing.sequences(spark.createDataFrame(rows, DOCS), tokenizer_path(), window=64).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in placed)


def test_rare_values_of_lang_are_not_learned(spark):
    rows = [(i, f"plain words number {i}", "en" if i < 900 else f"dirt{i}", None, None) for i in range(1000)]
    assert language_id.fit(spark.createDataFrame(rows, DOCS)).languages == ["en"]


def test_rare_languages_are_learned_for_predictions(spark):
    rare = "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440"
    rows = [(i, rare if i % 400 == 0 else f"plain words number {i}", "ru" if i % 400 == 0 else "en", None, None) for i in range(2000)]
    found = {r.doc_id: r.lang_pred for r in language_id.predict(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {i: "ru" if i % 400 == 0 else "en" for i in range(2000)}  # five rows of 2,000


def test_rolling_hashes_depend_on_the_gram_alone():
    text = "abcdefghijklmnop"
    alone = {g: int(winnowing.winnow([g], 10, 24)[0][0][0]) for g in (text[i : i + 10] for i in range(7))}
    (hashes, places), = winnowing.winnow(["", "zz" + text, text], 10, 1)[2:]
    assert [alone[text[p : p + 10]] for p in places.tolist()] == hashes.tolist() and len(places) == 7
