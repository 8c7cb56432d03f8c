"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.llm import (
    bpe,
    chat,
    decontaminate,
    filter_audit,
    lines,
    merkle,
    oracles,
    prefix_tree,
    separators,
    simhash,
    spotsigs,
    styletree,
    suffixes,
    toxicity,
)
from spendcast.llm.common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files that are written for it."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = separators.BpeEncoder(ranks, public_tokenizers.PATTERN)
    # 50256 is the first id that the ranks leave free.
    return separators.document_token_counts(read(spark, sf_dir, "documents"), encoder, separator=50256, width=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(documents, read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(documents, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = styletree.extract_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    cut = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), report=True)
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", "n_longest", F.sha2("text", 256).alias("kept_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when strings of 50 bytes that an earlier one has go."""
    cut = suffixes.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return cut.select(
        "doc_id", "kept.n_bytes", "kept.n_removed", "kept.n_spans", F.sha2("kept.data", 256).alias("kept_sha256")
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "similarity", "start_word"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select(
        "doc_id",
        F.floor(F.length("token_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_chat_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from raw transcripts of every conversation; a third of them is no part of the fit."""
    lines_of = chat.transcript_lines(read(spark, sf_dir, "conversations"))
    model = chat.fit_chat_model(lines_of.where(~toxicity.held_out("conv_id")))
    turns = chat.render(chat.parse_transcripts(lines_of, model))
    return turns.select("conv_id", "turn_no", "role", "text", "rendered")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return spotsigs.compare_with_edits(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every language, in all orders of the filters."""
    verdicts = filter_audit.document_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return filter_audit.interactions(verdicts, "ABCDE", ["good", "toxic"])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf and proof of every document, and whether what is claimed of it leads to the root; some claims are one character off."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.audit(read(spark, sf_dir, "documents"), "lang", "doc_id", columns, claimed)
    digest = F.sha2(merkle.proof_hashes(F.col("proof")), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", "verified")


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of four words are nearly the same."""
    return prefix_tree.similar_groups(read(spark, sf_dir, "documents"), shingle=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_style_tree": op3_style_tree,
    "op4_line_dedup": op4_line_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_chat_hmm": op9_chat_hmm,
    "op10_spotsigs": op10_spotsigs,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_tree": op13_prefix_tree,
}

# SQL for the queries that SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": oracles.OP4,
    "op11_filter_audit": oracles.OP11,
    "op12_merkle_manifest": oracles.OP12,
    "op13_prefix_tree": oracles.OP13,
}
