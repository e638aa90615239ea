"""A training corpus from raw documents: rules, near-copies, repeated passages, benchmark text, pieces."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from centerline.llm import decontaminate, pieces, quality, simhash, suffixes
from centerline.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned cutoffs keep; the others go.

    Null and empty texts go, a null ``lang`` is the stratum ``''``, rows that repeat are judged each, and an empty
    table stays empty.
    """
    return quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of three bits or fewer between fingerprints of three-word shingles make.

    It is the one with the smallest id. Null and empty texts are one group with all others of fingerprint 0; null ids
    count as larger than all others; of rows that repeat the id one stays; an empty table stays empty.
    """
    return simhash.one_of_each(docs, size=3, within=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that also start earlier.

    Null texts stay null, and a text may become empty; ``n_chars`` follows the text. Rows that repeat lose their
    passages but for the first; an empty table stays empty.
    """
    return suffixes.with_repeats_cut(docs, min_words=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages; null and empty texts stay."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sampled segmentation of each document, with the test that it decodes to its text.

    This stage ends the pipeline: it returns ``doc_id``, the pieces' ids, their number and the test, and no texts. A
    null text has no pieces; rows that repeat are segmented each, and alike.
    """
    return pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("repeated passages", passage_dedup),
    ("benchmark decontamination", decontamination),
    ("pieces", segmentation),
]

# Sampled segmentations cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
