"""One query for each corpus operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake.llm import (
    balanced_shards,
    decontamination,
    extraction,
    hard_negatives,
    language,
    near_duplicates,
    packing,
    periodic_runs,
    quality_rules,
    resampling,
    suffix_dedup,
    token_counts,
    toxicity,
)
from voltalake.llm.oracles import ORACLES
from voltalake.llm.text import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf, "documents"), str(path))


def op2_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_prefix_free_parsing(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf, "documents")).drop("kept")


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs, model)
    held = held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


def op5_page_differencing(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.main_text(table(spark, sf, "pages"))


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.predict(docs, language.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf, "documents"), str(path))


def op8_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf, "documents"), size=2).drop("class_id")


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality_rules.judge(docs, quality_rules.learn(docs, table(spark, sf, "labels")))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    )
    return found.drop("items")


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs.document_runs(table(spark, sf, "documents"), loop=True)


def op13_balanced_shards(spark: SparkSession, sf: str) -> DataFrame:
    return balanced_shards.shard_documents(table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    """The operators' queries by name."""
    return {
        "op1_token_counts": op1_token_counts,
        "op2_importance_resampling": op2_importance_resampling,
        "op3_prefix_free_parsing": op3_prefix_free_parsing,
        "op4_toxicity": op4_toxicity,
        "op5_page_differencing": op5_page_differencing,
        "op6_language_id": op6_language_id,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_quality_rules": op9_quality_rules,
        "op10_decontamination": op10_decontamination,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_balanced_shards": op13_balanced_shards,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return dict(ORACLES)
