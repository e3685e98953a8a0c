"""The ledger and resumable jobs as streams."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def spend_windows(ledger: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Calls and spend by window and engine; rows later than ``late`` behind the newest are not counted."""
    keyed = ledger.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "engine")
    return keyed.agg(F.count("*").alias("calls"), F.sum("usd").alias("usd")).select(F.col("w.start").alias("start"), "engine", "calls", "usd")


def enforced(requests: DataFrame, cap: float) -> DataFrame:
    """Each request (ts, id, usd) with the month's total and whether it was allowed; a refused one is not charged.

    The month's total is state: it outlives a restart, and requests of one batch are decided in order of time.
    """

    def decide(key, frames, state: GroupState):
        spent = state.get[0] if state.exists else 0.0
        rows = pd.concat(list(frames)).sort_values(["ts", "id"])
        out = []
        for r in rows.itertuples():
            good = spent + r.usd <= cap + 1e-9
            spent += r.usd if good else 0.0
            out.append((key[0], r.id, r.usd, good, round(spent, 6)))
        state.update((spent,))
        yield pd.DataFrame(out, columns=["month", "id", "usd", "allowed", "spent"])

    rows = requests.select(F.date_format("ts", "yyyy-MM").alias("month"), "ts", "id", "usd")
    return rows.groupBy("month").applyInPandasWithState(decide, "month string, id long, usd double, allowed boolean, spent double", "spent double", "append", GroupStateTimeout.NoTimeout)


def resumed(todo: DataFrame, key: str, job: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Runs ``job`` on arrivals that the sink lacks; a batch that is repeated after a failure writes nothing twice."""
    spark = todo.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
        fresh = batch.dropDuplicates([key])
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            fresh = fresh.join(spark.read.parquet(sink).select(key), key, "left_anti")
        job(fresh).write.mode("append").parquet(sink)

    return todo.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_memory(frame: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """The result of a stream over what is there now, through a memory table: for reports of bounded size."""
    spark = frame.sparkSession
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(_STORE[0]) if before is None else spark.conf.set(_STORE[0], before)
    return spark.table(name)
