"""Near duplicates, line dedup and decontamination against plain versions."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.llm import decontaminate, line_dedup, odd_sketch
from stationflow.llm.components import components
from stationflow.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DOCS


def texts_of(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def as_docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], DOCS)


def near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_near_duplicates_of_documents(spark, sf_dir):
    assert near(QUERIES["op3_minhash_near_dedup"](spark, sf_dir)) == brute.groups(texts_of(spark, sf_dir), 4)


@pytest.fixture(scope="module")
def loose_copies():
    """A large group of copies with edits, around the threshold, and texts of their own."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(90)]
    texts = {}
    for i in range(160):
        own = list(base)
        for _ in range(draw.randrange(0, 7)):
            own[draw.randrange(len(own))] = draw.choice(words)
        texts[i * 3] = " ".join(own)
    for i in range(60):
        texts[1000 + i] = " ".join(draw.choice(words) for _ in range(draw.randrange(1, 40)))
    return texts


@pytest.mark.parametrize("block", [odd_sketch.BLOCK_SHINGLES, 1500])
def test_loose_copies_in_one_or_many_blocks(spark, loose_copies, block):
    found = near(odd_sketch.near_duplicates(as_docs(spark, loose_copies), k=4, block_shingles=block))
    assert found == brute.groups(loose_copies, 4)
    assert sum(not kept for _, _, kept in found.values()) > 50


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = odd_sketch.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[104].component_id == 4 and not by_id[104].kept
    assert by_id[100].component_id == 100 and by_id[100].kept and by_id[100].n_shingles == 0
    assert [r.kept for r in found if r.doc_id is None] == [True, True]
    assert near(odd_sketch.near_duplicates(no_docs)) == {}


def test_each_text_of_a_repeated_id_brings_its_links(spark):
    rows, near_id = [], {}
    for case in range(30):
        base = 10 * case
        for k, other in enumerate((base + 1, base + 2, base + 3)):
            text = " ".join(f"t{case}x{k}y{j}" for j in range(60 + 20 * k))
            rows += [(base, text, None, None, None), (other, text + " more", None, None, None)]
            near_id[other] = base
    found = odd_sketch.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id in near_id} == near_id


def test_blocks_hold_sets_and_no_long_texts(spark):
    texts = {i: "one two three four five six seven " * 20_000 + f"end{i}" for i in range(4)}
    docs = as_docs(spark, texts)
    found = odd_sketch.class_sets(docs, spark.range(4).withColumnRenamed("id", "rep"), 4).toPandas()
    assert "text" not in found and found["shingles"].map(len).tolist() == [8] * 4
    members = found.assign(block=0, sketch=[np.zeros(4, np.int64)] * 4)
    assert len(odd_sketch.set_links(members, 70)) == len(odd_sketch.links(members.assign(text=members["rep"].map(texts)), 4, 70)) == 3
    assert {v[1] for v in near(odd_sketch.near_duplicates(docs, 4, 70)).values()} == {0}


def test_sketches_estimate_likeness(spark):
    words = [f"w{i}" for i in range(600)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:570] + [f"x{i}" for i in range(30)]))]
    signed = odd_sketch.signature_table(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    a, b = (signed.where(F.col("doc_id") == i).select(F.col("sketch").alias(f"s{i}")) for i in (0, 1))
    likeness = len(brute.shingles(rows[0][1], 3) & brute.shingles(rows[1][1], 3)) / len(brute.shingles(rows[0][1], 3) | brute.shingles(rows[1][1], 3))
    estimate = a.join(b, F.lit(True)).select(odd_sketch.estimated_likeness(F.col("s0"), F.col("s1"))).first()[0]
    assert abs(estimate - likeness) < 0.15


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 70)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 1), 50: 50, 60: 50, 70: 50}


def test_hits_of_documents(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op8_benchmark_decontamination"](spark, sf_dir).collect()}
    assert found == brute.overlaps(texts_of(spark, sf_dir), items)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 100])
def test_hits_with_short_items_and_blocks(spark, block):
    draw = random.Random(3)
    word = lambda: draw.choice("ab cd Ef gh ü9".split())
    texts = {i: " ".join(word() for _ in range(draw.randrange(0, 60))) for i in range(40)} | {90: None, 91: "", 92: "zz"}
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 3, 5, 9, 10, 11, 14, 30])] + [(77, texts[3]), (78, texts[3]), (79, None), (80, "zz")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_overlaps(as_docs(spark, texts), tests, window=4, block_bytes=block)
    expected = brute.overlaps(texts, items, window=4)
    for r in found.collect():
        covered = {w for h in r.hits for w in range(h.start, h.end)}
        assert (r.n_words, len(covered), len(r["items"]), decontaminate.digest(r["items"])) == expected[r.doc_id][:4]


def test_rows_are_the_same_for_any_number_of_blocks(spark):
    draw = random.Random(9)
    text = lambda n: " ".join(draw.choice("ab cd ef gh".split()) for _ in range(n))
    rows = [(i, text(30)) for i in (1, 1, 2, None, None, None)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows + rows[:1] * 2 + rows[3:4]], DOCS)
    tests = spark.createDataFrame([(i, text(8)) for i in range(40)], "item_id long, text string")
    one, many = (decontaminate.find_overlaps(docs, tests, window=4, block_bytes=size).collect() for size in (decontaminate.BLOCK_BYTES, 200))
    assert len(one) == 9 and any(r.hits for r in one)
    assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_longest_matches_have_their_places(spark):
    item = " ".join(f"t{i}" for i in range(30))
    docs = as_docs(spark, {1: "a b c " + " ".join(f"t{i}" for i in range(4, 25)) + " d", 2: "t0 t1 t2"})
    found = {r.doc_id: r for r in decontaminate.find_overlaps(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert [tuple(m) for m in found[1].matches] == [(9, 4, 3, 21)]
    assert found[2].matches == []


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    tests = spark.createDataFrame([(None, "no id here"), (1, None), (2, "123")], "item_id long, text string")
    found = decontaminate.contamination(odd_docs, tests).collect()
    assert len(found) == odd_docs.count()
    assert sorted(r.doc_id for r in found if r.doc_id is not None and r.contaminated) == [3, 103]
    assert sorted((r.n_hit, r.n_items) for r in found if r.doc_id is None) == [(0, 0), (3, 0)]
    assert decontaminate.contamination(no_docs, tests).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(odd_docs, none).collect())
    left = decontaminate.remove_contaminated(odd_docs, tests)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 2


def test_repeated_lines_of_documents(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    found = {r.doc_id: r for r in QUERIES["op1_line_dedup"](spark, sf_dir).collect()}
    left = brute.without_repeated_runs(texts, line_dedup.MIN_WORDS)
    seen = set()
    for i in sorted(texts):
        lines = brute.lines(texts[i])
        kept = brute.lines(found[i].text) if found[i].text else []
        # all that the plain version cuts is cut; what more is cut stands in an earlier place
        assert len(found[i].text) <= len(left[i])
        gone = {brute.bare(x) for x in lines} - {brute.bare(x) for x in kept} - {""}
        assert gone <= seen
        seen |= {brute.bare(x) for x in lines}


def test_runs_are_cut_and_clean_text_stays(spark):
    passage = " ".join(f"Sentence {i} of the passage tells something." for i in range(10))
    short = "A short line that many share."
    rows = {
        1: f"Own words one. {passage} More own words.", 2: f"{short}\nOther words. {passage}\nThe end.", 3: f"{short}\nClean text of its own.",
        4: f"{passage}\n{passage}", 5: None, 6: "\n".join([passage.replace(". ", ".\n")] * 2),
    }
    found = {r.doc_id: r for r in line_dedup.dedup_lines(as_docs(spark, rows)).collect()}
    assert found[1].text == rows[1] and found[3].text == rows[3]
    assert found[2].text == f"{short}\nOther words. The end."
    assert found[4].text == "" and found[6].text == ""
    assert found[5].text is None and found[5].n_removed == 0
    once = {r.doc_id: r.text for r in line_dedup.dedup_lines(as_docs(spark, {4: rows[4]})).collect()}
    assert once[4] == f"{passage}\n"


def test_line_dedup_of_odd_rows(odd_docs, no_docs):
    found = line_dedup.dedup_lines(odd_docs)
    assert found.count() == odd_docs.count()
    rows = found.where("doc_id is not null").collect()
    assert {r.text for r in rows if r.doc_id == 5} == {"line of text.\n"}  # each later line repeats the first
    assert {r.text for r in rows if r.doc_id == 105} == {""}
    assert {r.text for r in rows if r.doc_id in (6, 106)} == {"Ünï cödé 日本語 текст \U0001f600"}
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_parts_of_a_run_in_earlier_documents_hide_no_run(spark):
    line = lambda case, name, n: " ".join(f"{name}{case}x{i}" for i in range(n))
    rows, whole, cases = {}, {}, 40
    for case in range(cases):
        p, g, n = line(case, "p", 16), line(case, "g", 20), line(case, "n", 16)
        long, other, short = line(case, "l", 30), line(case, "o", 30), line(case, "s", 5)
        held = ([p, g], [g, n], [p, g, n], [p, g, n], [long, other], [long, other, short], [long, other, short])
        for k, part in enumerate(held):
            own = line(case, f"own{k}", 50)
            rows[k * cases + case] = "\n".join([own, *part, own[::-1]])
            whole[k * cases + case] = k in (3, 6)
    found = {r.doc_id: r for r in line_dedup.dedup_lines(as_docs(spark, rows)).collect()}
    assert {i for i, last in whole.items() if last and found[i].n_removed != 3} == set()
    assert {i for i in rows if i // cases < 3 and found[i].n_removed} == set()
    assert {found[i].n_removed for i in rows if i // cases == 5} == {2}


def test_excerpts_of_shared_text_against_every_run(spark):
    draw = random.Random(5)
    shared = [" ".join(f"w{i}x{j}" for j in range(draw.randint(1, 30))) for i in range(60)]
    held, rows = {}, {}
    for i in range(300):
        at, n = draw.randrange(55), draw.randint(1, 8)
        held[i] = [f"own{i}", *shared[at : at + n], f"end{i}"]
        rows[i] = "\n".join(held[i])
    seen, expected = set(), {}
    for i, lines in held.items():
        runs = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) if sum(len(x.split()) for x in lines[a:b]) >= line_dedup.MIN_WORDS]
        gone = {k for a, b in runs if tuple(lines[a:b]) in seen for k in range(a, b)}
        seen |= {tuple(lines[a:b]) for a, b in runs}
        expected[i] = [x for k, x in enumerate(lines) if k not in gone]
    found = {r.doc_id: r.text.split("\n") for r in line_dedup.dedup_lines(as_docs(spark, rows)).collect()}
    assert found == expected


def test_fingerprints_of_lines_hit_every_window():
    draw = np.random.default_rng(1)
    grams = draw.integers(0, 5, 50).astype(np.uint64)
    grams <<= np.uint64(40)
    start = np.arange(40)
    stop = start + draw.integers(1, 11, 40)
    chosen = set(line_dedup.fingerprints(grams, start, stop).tolist())
    for i, j in zip(start.tolist(), stop.tolist(), strict=True):
        inside = range(i, j)
        least = min(grams[j] for j in inside)
        assert max(j for j in inside if grams[j] == least) in chosen


def test_links_reports_no_more_than_a_tree():
    texts = [" ".join(f"w{j}" for j in range(50)) + f" x{i}" for i in range(20)]
    members = pd.DataFrame({"rep": range(20), "block": 0, "sketch": [np.zeros(4, np.int64)] * 20, "text": texts})
    assert len(odd_sketch.links(members, 4, 80)) == 19
