"""Written tables that cut lineage: they live in the folder the cluster shares.  Passes of Python over rows, in bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Bytes of an Arrow batch: the JVM and Python each hold several at once.  The row that passes the bound is the last of its batch.
BATCH = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a session in one process (tests) may leave it unset and gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not os.path.isdir(_OWN.get("root", "")):
            _OWN["root"] = tempfile.mkdtemp(prefix="leafmark-")
        root = _OWN["root"]
    return root.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/leafmark-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: an executor that is lost costs no recomputation."""
    spark = df.sparkSession
    path = where or new_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes tables that :func:`written` made, once nothing that is still to run reads them."""
    for table in tables:
        if path := getattr(table, "__dict__", {}).get("scratch_path"):
            removed(table.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder through Hadoop's file system, whatever its scheme."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextlib.contextmanager
def unshuffled(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when the query that wrote them ends; else they stay until the driver happens to collect its garbage.

    For tables that are written at once.  What is returned lazily is built outside, as a frame that is run twice would lose its shuffles.
    """
    old = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, old)


def passed(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of BATCH bytes; at a task's end its worker, which waits for others, returns memory.

    The bound is read when the query is run, so it stays set for the session; a smaller one that is set is left alone.
    """
    conf = df.sparkSession.conf
    now = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(_BATCH))
    if not 0 < now <= BATCH:
        conf.set(_BATCH, str(BATCH))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        returned()

    return df.mapInArrow(own, schema)


def returned() -> None:
    """Gives what Arrow and the C library hold unused back to the system, where the library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
