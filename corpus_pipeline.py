"""The corpus pipeline: quality, near-duplicates, mixture, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the
stage before it kept. All but the last return the columns of documents. ``run`` writes each
stage's rows as Parquet in the shared folder and reads them again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import bpe, minhash_join, mixing, quality
from casegrid.llm.common import free_name, smaller_batches, stored, table

#: Documents with a score below this go.
LEAST_QUALITY = 0.7

#: Every source is taken once at least and twice at most, and 1.5 times all words in all.
MIXTURE = {"weights": (3, 1, 2), "epochs": 1.5, "least": 1.0, "most": 2.0, "whole": True}


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is LEAST_QUALITY at least; empty texts score low."""
    smaller_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    name = free_name(docs, "score")
    return quality.score(docs, model, score_col=name).where(F.col(name) >= LEAST_QUALITY).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, 80 %): the one with the smallest id, told apart by id and text; repeated rows once."""
    smaller_batches(spark)
    return minhash_join.representatives(docs, percent=80, width=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in training order, ties by id: all once (those without words last), those of upweighted sources in part twice."""
    name = free_name(docs, "mix")
    return mixing.training_order(mixing.mix(docs, **MIXTURE), name, ties=("doc_id",), wordless=True).drop(name)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of the whole text, their number, and whether decoding them gives the text back."""
    smaller_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "source"], verify_col="decodes")
    return encoded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decodes")


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("mixture", mixture), ("token_ids", token_ids)]

#: The classifier's scores can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
