"""One query for each operator, over its whole table, and their SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fertility_rules, html_extraction, license_scan, line_dedup, mixing, near_dedup, quality_classifier, sentencepiece_codec, sharding

#: Wanted shares of the mixture's tokens.
MIX = {"clean": 0.97, "junk": 0.02, "toxic": 0.01}


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    return quality_classifier.scores(docs, model).withColumn("held_out", quality_classifier.held_out(F.col("doc_id")))


def op2_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, ranks = (sentencepiece_codec.read_model(spark, tokenizer_path(name)) for name in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"))
    return fertility_rules.rules(read(spark, sf_dir, "documents"), pieces, ranks, byte_pattern())


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(read(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"), shards=8)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    proto = sentencepiece_codec.read_model(spark, tokenizer_path())
    return sentencepiece_codec.digested(read(spark, sf_dir, "documents"), proto)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.fuzzy_lines(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), MIX)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op8_license_scan": license_scan.oracle(),
        "op10_exact_dedup": r"""
            WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS norm FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM n WINDOW w AS (PARTITION BY norm)""",
    }
