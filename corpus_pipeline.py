"""Corpus pipeline: from raw documents to packed training sequences.

Stages, each a function of (spark, docs, sf_dir): toxic documents go; one document of each
near-duplicate group stays; repeated passages are cut out of the texts; sources are repeated to
their target weights; the result is packed. Each stage's rows are written and read again as the
next one's ``docs``; all but the last return the columns of ``documents``.

Defined cases, for every stage: null or empty texts stay as they are (their set of shingles is
empty, so they link with nothing; packed, they are the end token alone); null ids stay null, and of
equal texts without an id one stays; a null lang counts for nothing, a null source is a source of
its own; of rows that share id and text one stays; ties go to the smaller id; texts of any length
are taken whole; further columns, whatever their names, go along untouched; an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staffmart.llm import jaccard_join, mixing, packing, suffix_dedup, toxicity
from staffmart.llm.common import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the table of labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start earlier in the corpus."""
    return suffix_dedup.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights."""
    return mixing.emit(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in their sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("mixing", mix_sources), ("packing", pack)]
# A fitted classifier and a tokenizer cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
