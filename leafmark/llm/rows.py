"""Identity of rows, so that decisions fall on rows and not on ids, which may be null or repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

PLACE = "__place"
#: Places of rows to drop are broadcast up to this many bytes; beyond, Spark plans the join.
BROADCAST = 16 << 20


def in_files(docs: DataFrame) -> bool:
    """Whether rows come straight from files, with a path and an index each."""
    return "_metadata" not in docs.columns and "_metadata" in docs._jdf.queryExecution().analyzed().metadataOutput().mkString(" ")


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with PLACE, the file of a row and its index there: the same at each reading.  Other rows are written first."""
    if not in_files(docs):
        own = docs.withColumnRenamed("_metadata", "__metadata") if "_metadata" in docs.columns else docs
        docs = scratch.written(own, "rows")
    return docs.withColumn(PLACE, F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index")))


def without(docs: DataFrame, drop: DataFrame) -> DataFrame:
    """``docs`` (with PLACE) less the rows whose places are in ``drop`` (its only column)."""
    drop = scratch.written(drop.toDF(PLACE), "drop")
    size = drop.agg(F.sum(F.length(PLACE) + 16)).first()[0] or 0
    kept = docs.join(F.broadcast(drop) if size <= BROADCAST else drop, PLACE, "left_anti").drop(PLACE)
    return kept.withColumnRenamed("__metadata", "_metadata") if "__metadata" in kept.columns else kept
