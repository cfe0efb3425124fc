"""Micro-batch sinks: upsert by key, first-seen filter, snapshot delta (L1-L3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forumlens.operators.delta import snapshot_delta
from forumlens.operators.posts import first_unseen
from forumlens.sources.ledger import append_ledger, read_ledger
from forumlens.sources.tables import folders, remove

#: State kept on disk, which may outgrow the memory of the executors; keyed processors need it.
ON_DISK = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
BatchSink = Callable[[DataFrame, int], None]


def versioned(path: str, run: str = "0") -> BatchSink:
    """Every micro-batch under its run and number: a replayed batch overwrites itself.

    Micro-batches are numbered from 0 by each checkpoint, so a query that starts with a new one needs
    another ``run``; runs are named in their order.
    """

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/epoch={number}")

    return sink


def newest_versions(table: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted row per key of a table written by ``versioned``."""
    rest = [c for c in table.columns if c not in (*keys, "run", "epoch")]
    last = F.max(F.struct("run", "epoch", *rest)).alias("_row")
    return table.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_seen(out: str, ledger: str, key: str = "id", run: str = "0") -> BatchSink:
    """Rows whose id no earlier micro-batch had (L2).

    The ledger lives in a table, not in streaming state, so it may outgrow executor memory. Ids
    of this very batch are left out when reading it, which makes a replay give the same rows.
    Micro-batches are numbered from 0 by each checkpoint, so a query that starts with a new one
    needs another ``run``; outputs and ids are kept by run and number.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = f"{run}-{number}"
        seen = read_ledger(spark, ledger, (name,))
        target = f"{out}/run={run}/epoch={number}"
        first_unseen(batch, seen, key).write.mode("overwrite").parquet(target)
        append_ledger(spark.read.parquet(target).select(F.col(key).alias("id")), ledger, name)

    return sink


def stream_delta(out: str, state: str, keys: list[str], time: str = "extracted_at", run: str = "0") -> BatchSink:
    """Rows of one time are a snapshot; write the change of each against the one before (L3).

    A micro-batch may hold several snapshots and a snapshot may come in several micro-batches in
    a row. The two newest snapshots are kept, so an id that skips one is new in the next. Snapshots come in
    the order of their times. A query that starts with a new checkpoint needs another ``run``: its output
    stands beside the others', and it goes on from the snapshots they kept. ``keyed.snapshot_changes``
    keeps one row per id instead of whole snapshots.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = lambda n: f"{state}/run={run}/epoch={n}"
        fresh = f"{state}-fresh"
        batch.write.mode("overwrite").parquet(fresh)
        rows = spark.read.schema(batch.schema).parquet(fresh)
        kept = [place(number - 1)] if number else [p for r in folders(spark, state) if r != f"{state}/run={run}" for p in folders(spark, r)]
        known = spark.read.schema(batch.schema).parquet(*kept) if kept else rows.limit(0)
        both = known.unionByName(rows)
        # one row per snapshot in the state and the batch
        times = both.select(time).distinct().withColumn("_before", F.lag(time).over(Window.orderBy(time)))
        now = rows.join(F.broadcast(times), time).withColumnRenamed("_before", "_snapshot")
        old = both.withColumn("_snapshot", F.col(time))
        changes = snapshot_delta(old, now, [*keys, "_snapshot"], time)
        changes.drop("_snapshot").write.mode("overwrite").parquet(f"{out}/run={run}/epoch={number}")
        newest = times.orderBy(F.desc(time)).limit(2).select(time)
        both.join(F.broadcast(newest), time, "left_semi").select(*batch.columns).distinct().write.mode("overwrite").parquet(place(number))
        remove(spark, place(number - 2))  # a replay needs the one before only

    return sink


def run_available(
    stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "append", state: dict[str, str] | None = None
) -> StreamingQuery:
    """Process what the source holds now and stop; ``state`` are settings of the state store, such as ``ON_DISK``."""
    conf, before = stream.sparkSession.conf, {}
    for name, value in (state or {}).items():  # read when the query starts
        before[name] = conf.get(name, None)
        conf.set(name, value)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(sink)
            .start()
        )
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    query.awaitTermination()
    return query
