"""The ordered list of batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.dates import batch_number, iso_text, shift, to_local


def batch_identity(time: Column, zone: str = "Asia/Seoul", look_back_hours: int = 24) -> list[Column]:
    """``date, time, batch, start_datetime, end_datetime`` of a UTC run time."""
    local = to_local(time, zone)
    return [
        F.substring(iso_text(local), 1, 10).alias("date"),
        F.substring(iso_text(local), 12, 8).alias("time"),
        batch_number(time, zone).alias("batch"),
        shift(local, hours=-look_back_hours).alias("start_datetime"),
        local.alias("end_datetime"),
    ]


def previous_batch(batches: DataFrame) -> DataFrame:
    """Every batch with the one before it (E5).

    A global order over the batch list: one short row per run, 48 a day, so years of them fit one
    task. Days are linked by the last batch of the day before, which keeps each window to a day.
    """
    day = Window.partitionBy("date").orderBy("batch")
    days = Window.orderBy("date")
    last_of_day = batches.groupBy("date").agg(F.max("batch").alias("_last"))
    day_before = last_of_day.select(
        "date",
        F.lag("date").over(days).alias("_date_before"),
        F.lag("_last").over(days).alias("_batch_before"),
    )
    same_day = F.lag("batch").over(day)
    linked = batches.withColumn("_same_day", same_day).join(day_before, "date")
    return linked.select(
        *batches.columns,
        F.when(F.col("_same_day").isNotNull(), F.col("date")).otherwise(F.col("_date_before")).alias("prev_date"),
        F.coalesce("_same_day", "_batch_before").alias("prev_batch"),
    )


def current_and_previous(ledger: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The batch ``current`` of the ledger, by default the newest, with its predecessor.

    A batch that ran several times counts once, with the earliest of its times. A rerun of an older
    batch finds that batch and the one before it, whatever ran since.
    """
    ledger = ledger.groupBy("date", "batch").agg(F.min("time").alias("time")).select("date", "time", "batch")
    if current is None:
        current = ledger.agg(F.max(F.struct("date", "batch")).alias("_now")).select("_now.*")
    return previous_batch(ledger).join(F.broadcast(current.select("date", "batch").distinct()), ["date", "batch"])  # one row
