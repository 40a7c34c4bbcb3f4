"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that becomes the next one's docs.  All but the last return the columns of
``documents``.  ``run`` applies them all to the ``documents`` table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm import bpe, decontaminate, repeats, simhash, toxicity
from boardlake.llm.common import crc_mod, materialise, table

#: The stages beyond SQL (a learned model, suffix order, BPE) leave none for the whole.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model does not reject.  The model learns from the labels of the
    rows in ``docs``, but for those whose crc32 of the id is 1 modulo 3.  Null and empty texts
    stay unless the bias alone would reject them."""
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.where("predicted = 0").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest doc_id, of each group of near-duplicates: 3-word
    shingles, at most 2 differing bits.  Rows with a null doc_id stay."""
    return simhash.keep_one(docs, width=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without the 50-byte strings that start in a document with a smaller
    doc_id, and n_chars of what remains.  A character cut in part goes whole; a null text
    becomes empty."""
    cut = repeats.remove_repeats(docs, length=50, kept="text")
    return cut.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long")).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item: less than 0.8 of the 5-word shingles of each."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every row."""
    found = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)
    return found.drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", keep_one_of_each),
    ("repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
