"""Snapshot changes with keyed state: one value per id instead of whole snapshots (L3)."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from forumlens.operators.delta import counter_change


class LastSnapshot(StatefulProcessor):
    """Puts each row of an id beside the one of the snapshot before.

    The state is the time and the counters, as text, of the newest row. A row that is not newer is late or a
    repeat and passes nothing on. A timer drops the state of an id that the next snapshot did not have.
    """

    def __init__(self, apart: int):
        self.apart = apart

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, counters string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get() if self.last.exists() else None
        # of rows repeated within a snapshot the greatest counts, as text
        fresh = sorted({(int(at), counters) for part in rows for at, counters in zip(part["snapshot_at"], part["snapshot_counters"])})
        newest = {at: counters for at, counters in fresh if known is None or at > known[0]}
        out = []
        for at, counters in newest.items():
            old = known[1] if known is not None and at - known[0] <= self.apart else None
            out.append((key[0], at, counters, old))
            known = (at, counters)
        if out:
            self.last.update(known)
            self.handle.registerTimer((known[0] + self.apart) // 1000 + 1)
            yield pd.DataFrame(out, columns=["snapshot_key", "snapshot_at", "snapshot_counters", "old"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists() and (self.last.get()[0] + self.apart) // 1000 < expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def snapshot_changes(stream: DataFrame, keys: list[str], apart: timedelta, late: str = "1 second", time: str = "extracted_at") -> DataFrame:
    """The change of every counter of a stream of snapshots against the snapshot before, prefixed ``v_``.

    Rows of one time are a snapshot, and two in a row are at most ``apart`` from each other: an id whose last row
    is older was not in the one before and counts in full. State is one row per id and goes when the watermark
    says that the id skipped a snapshot. Snapshots ``late`` or more behind the newest one of earlier
    micro-batches are dropped (so it must not be zero, or a snapshot could not come in several of them), and so are rows that are not newer than the last of their id.

    Keys and counters travel as JSON text, so their types and nulls stay as they are and the change is a column
    expression.
    """
    counters = [f for f in stream.schema if f.name not in (*keys, time)]
    identity, held = T.StructType([stream.schema[k] for k in keys]), T.StructType(counters)
    instant = F.col(time).cast("timestamp")
    rows = stream.select(
        F.to_json(F.struct(*keys)).alias("snapshot_key"), instant.alias("snapshot_time"), F.unix_micros(instant).alias("snapshot_at"),
        F.to_json(F.struct(*[f.name for f in counters])).alias("snapshot_counters"),
    ).withWatermark("snapshot_time", late)
    micros = int(apart / timedelta(microseconds=1))
    schema = "snapshot_key string, snapshot_at long, snapshot_counters string, old string"
    moved = rows.groupBy("snapshot_key").transformWithStateInPandas(LastSnapshot(micros), schema, "Append", "eventTime")
    read = moved.select(
        F.from_json("snapshot_key", identity).alias("_key"), F.timestamp_micros("snapshot_at").cast(stream.schema[time].dataType).alias("_time"),
        F.from_json("snapshot_counters", held).alias("_new"), F.from_json("old", held).alias("_old"),
    )
    changes = [counter_change(F.col(f"_old.{f.name}"), F.col(f"_new.{f.name}")).alias(f"v_{f.name}") for f in counters]
    return read.select(*[F.col(f"_key.{k}").alias(k) for k in keys], F.col("_time").alias(time), *changes)
