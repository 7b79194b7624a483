"""A corpus pipeline of five stages; each works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import contamination, lines, near_copies, pieces, quality
from tillwright.llm.common import read_table, settle


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's limits reject go."""
    return quality.keep_good(docs)


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats, or nearly, go; so does a document left without any."""
    return lines.drop_repeated(docs)


def _near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link stays, the one with the least id."""
    return near_copies.keep_one(docs, words=3, distance=2)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are half benchmark or more go."""
    return contamination.remove_passages(docs, read_table(spark, sf_dir, "benchmark"))


def _sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, in order, and whether they decode to its text."""
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.summarize(docs, vocabulary)


STAGES = [
    ("quality_rules", _quality_rules),
    ("line_dedup", _line_dedup),
    ("simhash_near_dedup", _near_copies),
    ("decontamination", _decontamination),
    ("sentencepiece", _sentencepiece),
]
# Thresholds, components and best paths are not SQL; tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's rows are written before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
