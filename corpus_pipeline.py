"""From raw documents to packed sequences: five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import decontaminate, language_id, line_dedup, odd_sketch, packing
from stationflow.llm.common import stored, table, unused_prefix
from stationflow.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no known language, go; those of several languages stay."""
    return language_id.keep_identified(docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs go; a document of which nothing but white space is left goes too."""
    own = unused_prefix(docs)
    cut = line_dedup.dedup_lines(docs, prefix=own)
    removed = F.col(f"{own}n_removed")
    kept = cut.where((removed == 0) | F.col("text").rlike(r"\S"))
    n_chars = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars"))
    types = dict(docs.dtypes)
    return kept.select(*[n_chars.cast(types[c]).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, likeness of 0.8."""
    return odd_sketch.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The stages have no SQL form; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
