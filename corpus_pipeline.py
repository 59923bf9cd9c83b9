"""Corpus pipeline: the stages that turn ``documents`` into tokenised training data.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns
the columns of ``documents``; the last one returns the token digests of each document of
the mix. Nulls, empty texts, repeated rows and extra columns are handled as each
operator's module states; an empty table passes through as an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from callgrid.llm import bpe, mixing, neardup, quality, suffix
from callgrid.llm.common import passing, ship_code, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    ship_code(spark)
    return neardup.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat an earlier place."""
    ship_code(spark)
    return suffix.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources repeats it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of each document of the mix."""
    ship_code(spark)
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("mixing", mix_sources),
    ("token ids", encode),
]

#: The stages as a whole are not plain SQL (hashed n-gram ratios, token ids); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back, the other tables of its stage are deleted."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with passing(f"stage{i}"):
            docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
