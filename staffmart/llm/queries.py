"""The registered queries of the pipeline operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.llm import chat, clustering, fingerprints, jaccard_join, language, mixing, negatives, packing, suffix_dedup, token_counts, topk, toxicity, warc


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _path("word_bpe_49k.json"), end_id=2)


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.round_trip(spark, _table(spark, sf_dir, "pages")))


def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_spans(_table(spark, sf_dir, "documents"))


def fingerprints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(_table(spark, sf_dir, "documents"))


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(_table(spark, sf_dir, "documents")))


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def jaccard_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _path("piece_bpe_32k.model"))


def clustering_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(_table(spark, sf_dir, "embeddings"))


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    test = spark.createDataFrame([(-7, 0, "user", chat.HOSTILE), (-7, 1, "assistant", chat.HOSTILE)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(told.unionByName(test), _path("byte_bpe_50k.json")))


def negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(_table(spark, sf_dir, "embeddings"), label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing_query,
        "op2_warc": warc_query,
        "op3_suffix_dedup": suffix_dedup_query,
        "op4_fingerprints": fingerprints_query,
        "op5_language": language_query,
        "op6_topk": topk_query,
        "op7_mixing": mixing_query,
        "op8_toxicity": toxicity_query,
        "op9_jaccard_join": jaccard_join_query,
        "op10_token_counts": token_counts_query,
        "op11_clustering": clustering_query,
        "op12_chat": chat_query,
        "op13_negatives": negatives_query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.WARC_SQL, "op6_topk": topk.TOPK_SQL, "op7_mixing": mixing.MIX_SQL,
            "op11_clustering": clustering.cluster_sql(), "op12_chat": chat.chat_sql(), "op13_negatives": negatives.NEGATIVES_SQL}
