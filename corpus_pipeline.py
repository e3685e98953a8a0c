"""From raw documents to token digests: STAGES, each of which works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmark.llm import exact_dedup, mixing, near_dedup, quality_classifier, scratch, sentencepiece_codec
from leafmark.llm.queries import read, tokenizer_path

#: The part of each domain's tokens that mixing keeps; clean text keeps all.
KEEP = {"toxic": 0.02, "junk": 0.02}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.accepted(docs, quality_classifier.fit(docs, read(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest doc_id stays."""
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 or more over five-word shingles), one document stays."""
    return near_dedup.without_near_duplicates(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic and low-quality domains keep the part of their tokens that KEEP names."""
    return mixing.mixed_documents(docs, read(spark, sf_dir, "labels"), KEEP)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return sentencepiece_codec.digested(docs, sentencepiece_codec.read_model(spark, tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mix),
    ("encoding", tokens),
]

#: SQL cannot express training, hashing and merges of these stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.written(docs, f"stage{k}")
    return docs
