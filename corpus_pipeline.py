"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept, applies one operator to all
of them, and its decision takes effect. ``run`` writes every stage's result to the
shared folder and rereads it as the next stage's documents, so a lost executor
repeats work of one stage at most.

Defined results: as in the operators; a stage that receives no documents returns
none; columns beyond those of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from alertflow.llm import exact, mixing, packing, quality, simhash
from alertflow.llm.common import table, written
from alertflow.llm.queries import MAX_BITS, SEQUENCE, SHINGLE, SOURCE_WEIGHTS, VOCAB, host, path

# The classifier, the seeded mix and the packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"), host(), path())


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest id."""
    return exact.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id."""
    return simhash.drop_near_copies(docs, SHINGLE, MAX_BITS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs, SOURCE_WEIGHTS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix with their sequences."""
    return packing.pack(docs, public_tokenizers.path(VOCAB), SEQUENCE, end_id=0)


STAGES = [("quality_classifier", quality_stage), ("exact_dedup", exact_stage), ("simhash_near_dedup", near_stage),
          ("mix_sources", mix_stage), ("best_fit_packing", pack_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
