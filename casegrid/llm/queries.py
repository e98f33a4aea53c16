"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import alignment, bpe, chat, fingerprints, html_text, minhash_join, mixing, permutation_index, prefix_trie, quality, token_shards, toxicity, warc_zip
from casegrid.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.per_document(table(spark, sf_dir, "documents"))


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), percent=80, width=4)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_markup_conversation(table(spark, sf_dir, "conversations")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_html_text": op2_html_text,
    "op3_fingerprints": op3_fingerprints,
    "op4_mix": op4_mix,
    "op5_permutation_index": op5_permutation_index,
    "op6_minhash_join": op6_minhash_join,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_token_shards": op9_token_shards,
    "op10_warc_zip": op10_warc_zip,
    "op11_alignment": op11_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_toxicity": op13_toxicity,
}
ORACLES: dict[str, str] = {"op4_mix": mixing.ORACLE, "op7_chat": chat.ORACLE, "op10_warc_zip": warc_zip.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
