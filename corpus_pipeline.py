"""The training-corpus pipeline: toxicity, exact dedup, near-dedup, decontamination, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. Every stage works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.

Defined results: an empty table passes through; null texts count as empty, are not toxic, are equal to each
other (one stays), hold no benchmark passage and have no tokens; further columns pass through all stages but
the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pvspark.llm import exact_stream, order_minhash, prefix_bpe, suffix_decontam, toxic_segments
from pvspark.llm.common import scratch, table

#: Documents go from this probability on: all that op10 calls toxic.
REJECT = toxic_segments.CUTOFF


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels"), held_out=True)
    return toxic_segments.score(docs, model).filter(F.col("score") < REJECT).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_stream.drop_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (suffix_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
            .filter(~F.col("contaminated")).select("row.*"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves (little-endian 32-bit)."""
    return (prefix_bpe.bpe(docs, public_tokenizers.path("word_bpe_49k.json"))
            .select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"), "ids"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe", bpe)]

#: SQL can express neither the trained toxicity model nor the tokeniser; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
