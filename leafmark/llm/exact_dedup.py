"""Exact dedup as a stateful stream with disk-backed keyed state (RocksDB), without expiry.

Arrivals are appended to a log of (digest, doc_id, content locator); a stream over the log keeps, for every digest ever seen,
the stable identifier (smallest doc_id), the locator of its content and the group's size.  The stream's checkpoint and the
group log lie in the shared folder, so a stream that is stopped, or loses executors, goes on where it was, and later calls of
:meth:`StreamingExactDedup.ingest` meet the state of earlier ones.  State is pre-aggregated in each task before the shuffle: a
group that holds a third of all rows sends one row a task.

A digest alone never decides: of all groups with a hit the full texts are compared (the smallest and the largest text of a
digest must be the same bytes), and digests shared by different texts are grouped by text instead.  Texts of single rows are
not moved for that while the digests that were hit are few enough to be broadcast (their size is measured).
Which row of a group stays is told by its locator, so rows that repeat an id are told apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rows as R
from . import scratch

#: Each run of these is one space; a single space stays as it is, so the pattern leaves it alone.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_ARRIVAL = "digest binary, doc_id long, place string"
_GROUP = "digest binary, keep struct<doc_id:long,place:string>, size long, batch long"
#: Digests of groups with a hit are broadcast up to this number (of 32 bytes each).
HITS = 500_000
_LAST = 2**63 - 1
#: Many small stores: no space is allocated ahead of need, and a batch uploads its changes instead of whole snapshots.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def _digest(norm: Column, bits: int) -> Column:
    return F.substring(F.unhex(F.sha2(norm, 256)), 1, bits // 8)


class StreamingExactDedup:
    """``bits``: leading bits of the SHA-256 digest that key the state (256; tests take few to force collisions)."""

    def __init__(self, spark: SparkSession, root: str | None = None, bits: int = 256):
        self.spark, self.bits = spark, bits
        self.root = root or scratch.new_dir(spark, "dedup")

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Appends ``docs`` to the arrivals and runs the stream over what is new.  Rows that come from no file have no locator."""
        if R.PLACE not in docs.columns:
            docs = R.placed(docs) if R.in_files(docs) else docs.withColumn(R.PLACE, F.lit(None).cast("string"))
        digest = _digest(normalised(F.col(text_col)), self.bits)
        arrivals = docs.select(digest.alias("digest"), F.col(id_col).cast("long").alias("doc_id"), F.col(R.PLACE).alias("place"))
        arrivals.write.mode("append").parquet(f"{self.root}/arrivals")

        before = {k: self.spark.conf.get(k, None) for k in _STORE}
        try:
            for k, v in _STORE.items():
                self.spark.conf.set(k, v)
            arrivals = self.spark.readStream.schema(_ARRIVAL).parquet(f"{self.root}/arrivals")
            keyed = arrivals.groupBy("digest").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "place")).alias("keep"), F.count("*").alias("size"))
            query = keyed.writeStream.outputMode("update").option("checkpointLocation", f"{self.root}/state").trigger(availableNow=True).foreachBatch(self._append()).start()
            query.awaitTermination()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def _append(self) -> Callable[[DataFrame, int], None]:
        path = f"{self.root}/groups"

        def put(batch: DataFrame, number: int) -> None:  # a batch that is run again overwrites its own folder
            batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/n={number}")

        return put

    def groups(self) -> DataFrame:
        """The state: digest, keep (doc_id, place), size.  The newest row of each digest counts."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/groups")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):  # nothing has arrived
            return self.spark.createDataFrame([], _GROUP).select("digest", "keep", "size")
        log = self.spark.read.schema(_GROUP).parquet(f"{self.root}/groups")
        return log.groupBy("digest").agg(F.max_by(F.struct("keep", "size"), "batch").alias("g")).select("digest", "g.keep", "g.size")

    def clashes(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Digests that different texts of ``docs`` share: the full bytes of every group of two rows or more are compared."""
        texts = docs.select(normalised(F.col(text_col)).alias("norm")).select(_digest(F.col("norm"), self.bits).alias("digest"), "norm")
        hits = self.groups().where("size > 1").select("digest")
        hits = scratch.written(hits, "hits")
        if hits.count() <= HITS:
            texts = texts.join(F.broadcast(hits), "digest", "left_semi")
        # one row a task and digest is shuffled, whatever the group's size
        seen = texts.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
        clash = scratch.written(seen.where("lo <> hi").select("digest"), "clash")
        scratch.dropped(hits)
        return clash

    def decided(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row for each row of ``docs`` (all that was ingested): doc_id, keep_id, group_size, kept, text_sha256.

        Texts are equal when identical after each run of space and U+0009 to U+000D became one space; null counts as empty.
        Of equal texts the smallest doc_id stays.  Rows that repeat both doc_id and text are one document: each counts in
        group_size and has its kept.  A missing doc_id sorts last; a group without any has keep_id null and is kept.
        An empty table gives an empty result; other columns are not read.
        """
        norm = normalised(F.col(text_col))
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
        slim = rows.select("doc_id", F.sha2("norm", 256).alias("text_sha256")).withColumn("digest", F.expr(f"substring(unhex(text_sha256), 1, {self.bits // 8})"))
        groups = self.groups().select("digest", F.nullif(F.col("keep.doc_id"), F.lit(_LAST)).alias("keep_id"), F.col("size").alias("group_size"))
        out = slim.join(groups, "digest")
        clash = self.clashes(docs, text_col)
        if not clash.isEmpty():
            split = rows.withColumn("digest", _digest(F.col("norm"), self.bits)).join(clash, "digest", "left_semi")
            by_text = split.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            exact = split.join(by_text, "norm").select("doc_id", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"))
            out = out.join(clash, "digest", "left_anti").select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(exact)
        return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")

    def dropped(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Places of the rows of ``docs`` (with PLACE, all that was ingested) that go: all of a group but the one its state locates."""
        arrivals = self.spark.read.schema(_ARRIVAL).parquet(f"{self.root}/arrivals")
        out = arrivals.join(self.groups(), "digest").where("place <> keep.place").select("place")
        clash = self.clashes(docs, text_col)
        if not clash.isEmpty():
            out = arrivals.join(self.groups(), "digest").join(clash, "digest", "left_anti").where("place <> keep.place").select("place")
            rows = docs.select(F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc_id"), F.col(R.PLACE).alias("place")).alias("own"), normalised(F.col(text_col)).alias("norm"))
            split = rows.withColumn("digest", _digest(F.col("norm"), self.bits)).join(clash, "digest", "left_semi")
            by_text = split.groupBy("norm").agg(F.min("own").alias("keep"))
            out = out.unionByName(split.join(by_text, "norm").where("own <> keep").select("own.place"))
        return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256) -> DataFrame:
    """The whole table as one stream; see :meth:`StreamingExactDedup.decided`.  Empty tables give empty results."""
    stream = StreamingExactDedup(docs.sparkSession, bits=bits)
    stream.ingest(docs, id_col, text_col)
    return stream.decided(docs, id_col, text_col)


def without_duplicates(docs: DataFrame, bits: int = 256) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest doc_id (null last; ties by place), all columns kept."""
    docs = R.placed(docs)
    stream = StreamingExactDedup(docs.sparkSession, bits=bits)
    stream.ingest(docs)
    return R.without(docs, stream.dropped(docs))
