"""WARC archives, tool calls and the whole pipeline."""

import gzip
import io
import json

import pyarrow as pa
import pytest
from pyarrow import fs

import corpus_pipeline
from stationflow.llm import line_dedup, tool_links, warc
from stationflow.llm.common import stored, table
from stationflow.llm.queries import QUERIES, tokenizer_path
from stationflow.session import fresh_path
from tests.llm import brute
from tests.llm.conftest import by_name

# WARC


def test_archives_match_the_sql(spark, sf_dir, oracle):
    assert by_name(QUERIES["op6_warc"](spark, sf_dir)) == oracle("op6_warc")


PAGES = [
    (1, "http://a", "x" * 1000), (2, None, "x" * 1000), (3, "u\r\nWARC-Type: evil", "x" * 1000), (3, "twice", "x" * 1000), (4, "s", "y" * 999), (5, "s", "y" * 999),
    (6, "n", None), (7, "e", ""), (None, "no id", "x" * 1000), (8, "é", "é" * 500), (None, "none", "z" * 1500), (None, None, "z" * 1500), (9, "big", "\r\n\r\nWARC/1.1\r\n" * 200_000),
]


def test_odd_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_roundtrip(pages).collect()), key=repr)
    three = [(1, 1000, "revisit", 3), (2, 1000, "revisit", 3), (3, 1000, "response", None), (3, 1000, "response", None), (None, 1000, "revisit", 3)]
    rest = [(4, 999, "response", None), (5, 999, "response", None), (6, 0, "response", None), (7, 0, "response", None), (8, 1000, "response", None)]
    rest += [(None, 1500, "response", None)] * 2 + [(9, 14 * 200_000, "response", None)]
    assert found == sorted(three + rest, key=repr)
    assert warc.archive_roundtrip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_each_record_is_read_once_whatever_the_splits(spark, sf_dir, split):
    pages = table(spark, sf_dir, "pages")
    folder = fresh_path(spark, "archives")
    manifest = warc.write_archives(warc.with_revisits(pages.repartition(3)), folder, file_bytes=20_000)
    assert manifest.count() > 3
    if split < 200:
        manifest = manifest.limit(1)
    found = warc.read_archives(spark, manifest, split).collect()
    assert len(found) == sum(r.records for r in manifest.collect())
    assert len({(r.file, r.offset) for r in found}) == len(found)
    for r in manifest.limit(2).collect():
        files, path = fs.FileSystem.from_uri(r.file)
        with files.open_input_file(path) as source:
            whole = gzip.GzipFile(fileobj=io.BytesIO(source.read())).read()
        assert whole.count(b"WARC-Record-ID: ") == r.records


def test_bytes_that_look_like_a_member_are_passed_over():
    good = warc.member({"WARC-Type": "resource", "Content-Type": "text/plain"}, b"hello")
    other = gzip.compress(b"not an archive record")
    data = b"\x1f\x8b\x08 junk" + good + other + warc.MAGIC + good[:40] + b"\0" * 50 + good
    source = pa.BufferReader(data)
    found = list(warc.members(source, 0, len(data), len(data)))
    assert [(h["WARC-Type"], b) for _, h, b in found] == [("resource", b"hello")] * 2
    assert list(warc.members(source, found[0][0] + 1, found[1][0], len(data))) == []


# Tool calls


def test_conversations_match_the_sql(spark, sf_dir, oracle):
    assert by_name(QUERIES["op2_tool_call_linking"](spark, sf_dir)) == oracle("op2_tool_call_linking")


def test_links_order_and_problems(spark):
    calls = spark.createDataFrame(
        [
            (1, "c", 3, "lookup", '{"query":"q","limit":1}', "b"), (1, "b", 2, "lookup", '{"limit":"1"}', "a"), (1, "a", 1, "count", '{"what":"w","words":true,"odd":1}', None),
            (1, "x", 5, "lookup", '{"query":"q","limit":1.5}', "y"), (1, "y", 6, "lookup", "[1]", "x"), (1, "z", 7, "other", "{}", "gone"), (1, "self", 8, "rewrite", None, "self"),
            (2, "a", 1, "rewrite", '{"text":"t","style":{"b":1.0,"a":[2,{"z":1,"y":null}]}}', "b"), (2, "a", 0, "count", '{"what":"first"}', None),
            (None, "a", 1, "count", '{"what":null}', None), (None, None, 1, "count", "{}", None), (3, "d", 1, None, '{"a":1,"a":2}', None),
        ],
        "conv_id long, call_id string, turn long, name string, arguments string, after string",
    )
    results = spark.createDataFrame(
        [(1, "a", 4, "late"), (1, "a", 2, 'say "é"'), (1, "lost", 9, "r"), (None, "a", 2, None), (2, None, 1, "x")], "conv_id long, call_id string, turn long, content string"
    )
    rows = tool_links.link(calls, results, tool_links.TOOLS).collect()
    found = {(r.conv_id, r.call_id): r for r in rows}
    assert len(found) == len(rows) == 11
    assert {k: r.depth for k, r in found.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "x"): None, (1, "y"): None, (1, "z"): 0, (1, "self"): None, (2, "a"): 0, (None, "a"): 0, (3, "d"): 0, (1, "lost"): None
    }
    errors = {k[1]: r.errors for k, r in found.items() if k[0] in (1, 3)}
    assert errors == {
        "a": "unexpected odd", "b": "missing query, type of limit", "c": "", "x": "type of limit, circle", "y": "not a JSON object, circle", "z": "unknown tool",
        "self": "not a JSON object, circle", "d": "not a JSON object", "lost": "",
    }
    assert (found[1, "a"].status, found[1, "a"].n_results, found[1, "b"].status, found[1, "lost"].status) == ("linked", 2, "no_result", "no_call")
    assert found[1, "a"].record == '{"arguments":{"odd":1,"what":"w","words":true},"call_id":"a","conv_id":1,"depth":0,"name":"count","result":"say \\"é\\"","status":"linked","turn":1}'
    assert (found[2, "a"].n_calls, found[2, "a"].name) == (2, "count")
    assert found[None, "a"].errors == "type of what" and found[None, "a"].status == "linked"
    assert tool_links.link(calls.limit(0), results.limit(0), tool_links.TOOLS).count() == 0


def test_whole_conversations_keep_every_row_and_character(spark):
    said = [("system", "Be brief.\n" * 30), ("user", "opening " * 40)]
    for n in range(90, 120):  # lengths of every tool and defect
        said += [("assistant", f'"é\\ {n} '.ljust(n, "z")), ("user", f"answer {n} " * 20)]
    rows = [(1, i - 1, role, text) for i, (role, text) in enumerate(said)] + [(None, 0, None, "no role"), (2, None, "assistant", "no turn"), (2, 0, "user", None)]
    rows = [(c, 0 if role == "system" else t, role, text) for c, t, role, text in rows]
    found = tool_links.linked_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(found) == 30 + 5
    assert sorted(json.loads(r.record)["content"] for r in found if r.status == "message") == sorted(t or "" for _, _, role, t in rows if t not in [x for _, x in said[2:]])
    lost = {"missing query", "missing query, type of limit", "not a JSON object"}  # defects that leave no text
    calls = {r.turn: r for r in found if r.status == "linked"}
    for turn, (_, text) in enumerate(said, -1):
        if turn > 0 and turn % 2:
            record = json.loads(calls[turn].record)
            assert record["result"] == said[turn + 2][1]
            assert calls[turn].errors in lost or text in record["arguments"].values()
    assert {r.errors for r in calls.values()} >= {"", "type of limit", "missing query", "unexpected mode", "not a JSON object"}


def test_long_chains_have_their_depths(spark):
    calls = spark.range(300).selectExpr("1L AS conv_id", "'c' || id AS call_id", "IF(id > 0, 'c' || (id - 1), null) AS after")
    assert {r.call_id: r.depth for r in tool_links.depths(stored(calls, "chain")).collect()} == {f"c{i}": i for i in range(300)}


def test_plans_of_tool_calls_are_native(spark, sf_dir, capsys):
    QUERIES["op2_tool_call_linking"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# Pipeline


def test_stages_against_plain_versions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir), name)
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(texts)
            assert tokenizer_path().endswith(".json")
            break
        assert out.columns == columns and out.schema == docs.schema
        rows = out.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and set(after) <= set(texts)
        if name == "language_id":
            assert all(any(c.isalpha() for c in t) for t in after.values())
            assert len(after) > 0.95 * len(texts)
        elif name == "line_dedup":
            plain = brute.without_repeated_runs(texts, line_dedup.MIN_WORDS)
            assert all(len(after.get(i, "")) <= len(plain[i]) for i in texts)
            assert all(after[r.doc_id] == texts[r.doc_id] or r.n_chars == len(r.text) for r in rows)
            assert {i for i in texts if plain[i].strip() == texts[i].strip()} <= set(after)
        elif name == "near_dedup":
            assert set(after) == {i for i, g in brute.groups(texts, 5).items() if g[2]}
        else:
            assert set(after) == {i for i, hit in brute.overlaps(texts, items).items() if not hit[4]}
        kept[name] = len(after)
        docs, texts = out, after
    assert QUERIES["pipeline"](spark, sf_dir).select("doc_id").distinct().count() == len(texts)


def test_pipeline_stands_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, sf_dir), name)
            assert name == "packing" or docs.columns == columns
