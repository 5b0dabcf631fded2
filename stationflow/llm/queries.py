"""Queries of this subpackage over the given tables, and the SQL that some of them are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import alignment, decontaminate, language_id, line_dedup, odd_sketch, packing, pii, quality, suffix_dedup, tool_links, warc, whitening, winnowing
from stationflow.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where an installed public tokenizer's file lies, on every machine of the cluster."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "n_removed")


def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_links.linked_conversations(table(spark, sf_dir, "conversations"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_fingerprints(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_roundtrip(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"), digest=True)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # stands beside the package and imports it

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_tool_call_linking, op3_minhash_near_dedup, op4_fingerprints, op5_packing, op6_warc, op7_pii, op8_benchmark_decontamination, op9_language_id, op10_quality_classifier, op11_suffix_dedup, op12_cross_tokenizer_alignment, op13_embedding_whitening, pipeline)}

ORACLES = {
    "op2_tool_call_linking": tool_links.ORACLE,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, sha1(encode(coalesce(html, ''))) AS digest, octet_length(encode(coalesce(html, ''))) AS size FROM pages
        ), g AS (
            SELECT digest, max(page_id) AS target FROM p WHERE size >= 1000 GROUP BY digest
        )
        SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
            CASE WHEN size >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN size >= 1000 AND page_id <> target THEN target END AS refers_to
        FROM p LEFT JOIN g ON p.digest = g.digest
    """,
}
