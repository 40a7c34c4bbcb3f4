"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm import bpe, chat, decontaminate, hard_negatives, language, neighbours, quality, repeats, resampling, simhash, sql, token_counts, toxicity, urls
from boardlake.llm.common import materialise, table

#: The rules that the url query applies.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=50, kept=None)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("cleaned")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=2)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation of control strings that is formatted beside the table's.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string"))
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    segments, members = chat.format_chat(rows, vocabulary)
    return chat.read_back(materialise(segments), members, vocabulary)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_repeats": op1_repeats,
        "op2_toxicity": op2_toxicity,
        "op3_bpe": op3_bpe,
        "op4_quality": op4_quality,
        "op5_language": op5_language,
        "op6_simhash": op6_simhash,
        "op7_decontaminate": op7_decontaminate,
        "op8_chat": op8_chat,
        "op9_token_counts": op9_token_counts,
        "op10_urls": op10_urls,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_resampling": op12_resampling,
        "op13_neighbours": op13_neighbours,
    }


def oracle_queries() -> dict[str, str]:
    return {
        "op4_quality": sql.OP4,
        "op7_decontaminate": sql.OP7,
        "op8_chat": sql.OP8,
        "op10_urls": sql.OP10,
        "op11_hard_negatives": sql.OP11,
        "op12_resampling": sql.OP12,
    }
