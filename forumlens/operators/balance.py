"""Running sums over a global order, and length-balanced partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.runtime import materialize

_RANGE, _LOCAL, _BEFORE, _TOTAL, _TIE = "_range", "_local", "_before", "_total", "_tie"

#: Tasks at most unless the caller or the session asks for more: each sends the driver its report, whatever it holds.
MOST_TASKS = 1000


@F.pandas_udf(T.LongType())
def _running_in_partition(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    total = 0
    for values in batches:
        sums = values.fillna(0).astype("int64").cumsum() + total
        if len(sums):
            total = int(sums.iloc[-1])
        yield sums


def _ranges(df: DataFrame, order_by: list[str], value: Column, ranges: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their range number, the running sum inside it, and each range's offset; the sum of each range.

    A window over the whole table would run in one task. Here every range keeps its own running
    sum right after the range exchange, in the same stage; only the length column visits Python.
    The ranges are sampled, so they are fixed by writing them once before their totals are read.
    Rows that tie on ``order_by`` are ordered by a hash and a row number, which also lets one hot
    key spread over several ranges.
    """
    tied = df.withColumn("_value", value.cast("bigint")).withColumn(
        _TIE, F.struct(F.xxhash64(*order_by, "_value"), F.monotonically_increasing_id())
    )
    order = [*order_by, _TIE]
    # without a number, adaptive execution merges neighbouring ranges of a small table
    ranged = tied.repartitionByRange(ranges, *order) if ranges else tied.repartitionByRange(*order)
    local = (
        ranged
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .select("*", F.spark_partition_id().alias(_RANGE), _running_in_partition("_value").alias(_LOCAL))
    )
    fixed = materialize(local, "ranges")
    # one row per range, at most spark.sql.shuffle.partitions of them whatever the size of the table
    totals = fixed.groupBy(_RANGE).agg(F.sum("_value").alias("_sum"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _RANGE,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(_BEFORE),
        F.sum("_sum").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(_TOTAL),
    )
    return fixed.join(F.broadcast(offsets), _RANGE), totals


def prefix_sum(
    df: DataFrame, order_by: list[str], value: Column, out: str = "cumulative", ranges: int | None = None
) -> DataFrame:
    """Running sum of ``value`` over the whole table in ``order_by`` order."""
    ranged, _ = _ranges(df, order_by, value, ranges)
    return ranged.select(*df.columns, (F.col(_LOCAL) + F.col(_BEFORE)).alias(out))


def bucket(cumulative: Column, size: int) -> Column:
    """Whole buckets of ``size`` below the running sum."""
    return F.floor(cumulative / F.lit(size)).cast("int")


def balance_by_length(
    df: DataFrame,
    text: str,
    order_by: list[str],
    limit: int = 100_000,
    tasks: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``partition_id``, the running length over ``limit``, and spread rows by length.

    ``partition_id`` is a logical number that grows with the data. The rows go to ``tasks``
    partitions that hold the same number of characters each, up to one row. By default there is
    one per ``limit`` characters, so a task holds less than ``limit`` characters and one row more,
    up to ``MOST_TASKS`` of them, or as many as the session's shuffle partitions if those are more:
    beyond, a task holds its equal share of several limits. Give ``tasks`` to choose another number.
    """
    ranged, totals = _ranges(df, order_by, F.length(text), ranges)
    if tasks is None:
        most = max(MOST_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        tasks = min((totals.agg(F.sum("_sum")).first()[0] or 0) // limit + 1, most)
    cumulative = F.col(_LOCAL) + F.col(_BEFORE)
    start = cumulative - F.coalesce(F.col("_value"), F.lit(0))
    task = F.least(F.floor(start * tasks / F.greatest(F.col(_TOTAL), F.lit(1))), F.lit(tasks - 1))
    placed = ranged.select(
        *df.columns, bucket(cumulative, limit).alias("partition_id"), task.cast("int").alias("_task")
    )
    return placed.repartitionById(tasks, "_task").drop("_task")
