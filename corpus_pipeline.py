"""The corpus pipeline: five operators over ``documents``, each stage written and read again.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``documents``.
``run(spark, sf_dir)`` applies them in order to the whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm.bpe import encoded_and_decoded
from clicklens.llm.common import table, written
from clicklens.llm.decontaminate import without_contaminated
from clicklens.llm.exact_dedup import deduplicated
from clicklens.llm.langid import UNKNOWN, learn, predictions
from clicklens.llm.simhash import representatives

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: No SQL states language identification by a trained network; tests hold the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those that the network calls ``und`` (no letter, or null) go.

    The network learns from rows outside fold 1 of 3, as in the operator's query.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    net = learn(docs.where(~held_out & F.col("doc_id").isNotNull()))
    named = predictions(docs.select(*COLUMNS, F.col("text").alias("_read")), net, text_col="_read")
    return named.where(F.col("lang_pred") != UNKNOWN).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id."""
    return deduplicated(docs, keep="largest").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest doc_id."""
    return representatives(docs, shingle=3, radius=3).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that ``benchmark`` does not contaminate."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"), n=13, share=20).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and their number; decoding has to give the text back."""
    out = encoded_and_decoded(docs.select("doc_id", "lang", "source", "text", F.sha2(
        F.coalesce("text", F.lit("")), 256).alias("text_sha256")), TOKENIZER)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("decontamination", decontamination), ("bpe", bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline", name)
    return docs
