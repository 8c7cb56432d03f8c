"""Corpus preparation in five stages, from raw documents to token ids.

Each stage works on all rows that its predecessor kept; what it returns is
written to the shared folder and read again before the next one starts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.llm import bpe, decontaminate, lines, simhash, toxicity
from spendcast.llm.common import read, release, stored

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"), threshold=0.7)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; every document stays, if need be with an empty text."""
    return lines.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left (four bytes each, lowest first), with digests of the ids and of the decoded bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS_FILE))
    kept = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe.encode(kept, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.floor(F.length("token_bytes") / 4).cast("long").alias("n_tokens"),
        "token_bytes",
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs


# The classifier, the fingerprints and the ranked merges cannot be told in SQL.
ORACLE_SQL = None
