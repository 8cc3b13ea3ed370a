"""A corpus through quality rules, line dedup, near-dedup, benchmark decontamination and BPE encoding.

Each stage takes all that its predecessor kept, written as Parquet and read again, and returns the columns of
documents; the last returns the ids. No stage is expressible in SQL as a whole (the first uses boosted trees),
so ORACLE_SQL is None and the tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillmere.llm import byte_bpe, chosen_path, decontam, line_dedup, quality_rules
from quillmere.llm.common import stored, table


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trees are fitted on labelled documents of the input.

    Null and empty texts have no words and go; of equal rows all stay or all go; a probability of just the threshold stays; without labels
    of both kinds only the base rules speak; an empty table gives an empty one.
    """
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; n_chars follows the text.

    A null text stays null and an empty one empty; the smallest id that holds a line is the earlier; rows of one id are one document,
    so each keeps what it holds; rows without an id lose nothing; an empty table gives an empty one.
    """
    return line_dedup.dedup_documents(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 of five-word shingles: that with the smallest id.

    Null and empty texts, and texts without words, are linked with nothing and stay, as do rows without an id; of the rows of one
    id one stays; a similarity of just 0.8 links; an empty table gives an empty one.
    """
    return chosen_path.keep_one(docs, k=5, similarity=(80, 100))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark.

    Null and empty texts have no words and stay; equal texts all stay or all go; just one word hit in 20 is contaminated; items without an
    id count, items without words don't; an empty table gives an empty one, an empty benchmark all documents.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and hashes of them and of what they decode to.

    A null or empty text has no ids; rows without an id stay; repeated rows give a row each; an empty table gives an empty one.
    """
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", stage_quality),
    ("line_dedup", stage_lines),
    ("near_dedup", stage_near),
    ("decontamination", stage_decontaminate),
    ("byte_bpe", stage_encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
