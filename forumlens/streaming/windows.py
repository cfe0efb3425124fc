"""Sliding windows over a stream of deltas (L1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_means(
    deltas: DataFrame,
    width: str = "3 hours",
    step: str = "30 minutes",
    late: str = "3 hours",
    anchor: str = "0 seconds",
) -> DataFrame:
    """Mean view change per (bucket end, id) over windows ``(end - width, end]``.

    Spark's windows are closed at the start and open at the end, on a grid from the epoch. Moving
    the times back by a microsecond turns the ends round; ``anchor`` shifts the grid. Event time
    must be an instant, so naive times are read in the session's zone and written back in it.
    State is one row per open window and id, and the watermark lets it go.
    """
    inside = F.timestamp_add("MICROSECOND", F.lit(-1), F.col("extracted_at").cast("timestamp"))
    return (
        deltas.withColumn("_inside", inside)
        .withWatermark("_inside", late)
        .groupBy(F.window("_inside", width, step, anchor).alias("_window"), "id")
        .agg(F.count("v_view_count").alias("deltas"), F.avg("v_view_count").alias("mean_view"))
        .select(F.col("_window.end").cast("timestamp_ntz").alias("bucket_end"), "id", "deltas", "mean_view")
    )


def slot_means(
    deltas: DataFrame,
    width: str = "3 hours",
    step: str = "30 minutes",
    slot: str = "30 minutes",
    late: str = "3 hours",
    anchor: str = "0 seconds",
) -> DataFrame:
    """``sliding_means`` as two aggregations in one stream: deltas to slots, closed slots to windows (L1).

    A slot must divide the width and the step. However many deltas an id has, a slot keeps one row
    for it, and a window takes in slots, not deltas. A row behind the watermark is dropped. The
    output is appended: a window comes once, when the watermark has passed its end.
    """
    inside = F.timestamp_add("MICROSECOND", F.lit(-1), F.col("extracted_at").cast("timestamp"))
    slots = (
        deltas.withColumn("_inside", inside)
        .withWatermark("_inside", late)
        .groupBy(F.window("_inside", slot, startTime=anchor).alias("_slot"), "id")
        .agg(F.count("v_view_count").alias("_deltas"), F.sum("v_view_count").alias("_views"))
    )
    return (
        slots.groupBy(F.window(F.window_time("_slot"), width, step, anchor).alias("_window"), "id")
        .agg(F.sum("_deltas").alias("deltas"), (F.sum("_views") / F.nullif(F.sum("_deltas"), F.lit(0))).alias("mean_view"))
        .select(F.col("_window.end").cast("timestamp_ntz").alias("bucket_end"), "id", "deltas", "mean_view")
    )


def first_seen_within(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """First row per key inside the watermark (L2).

    State is one key per row of the last ``late``. Ids that must stay known forever belong in the
    ledger instead: see ``sinks.first_seen``.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.dropDuplicatesWithinWatermark([key]).withColumn(time, F.col(time).cast("timestamp_ntz"))
