"""Counter movement between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shared_columns(before: DataFrame, after: DataFrame, skip: list[str]) -> list[str]:
    """Columns of both snapshots in the order of the newer one."""
    return [c for c in after.columns if c in before.columns and c not in skip]


def counter_change(old: Column, new: Column) -> Column:
    """A counter without an old value counts in full."""
    return F.when(old.isNull(), new).otherwise(new - old)


def latest_per_key(df: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """One row per key, the newest; ties go to the largest counters.

    Collapsing on the map side keeps a repeated id from multiplying in the join, and the join
    below reuses this hash partitioning.
    """
    rest = [c for c in df.columns if c not in keys and c != stamp]
    newest = F.max(F.struct(stamp, *rest))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def snapshot_delta(
    before: DataFrame | None,
    after: DataFrame,
    keys: list[str] | None = None,
    stamp: str = "extracted_at",
) -> DataFrame:
    """Change of every shared counter, prefixed ``v_``; ids absent from ``after`` are dropped.

    Without ``before`` (the first batch) the counters themselves are the change.
    """
    keys = keys or ["id"]
    fixed = [*keys, stamp]
    if before is None:
        return after.select(*fixed, *[F.col(c).alias(f"v_{c}") for c in after.columns if c not in fixed])
    counters = shared_columns(before, after, fixed)
    new = latest_per_key(after.select(*fixed, *counters), keys, stamp).alias("new")
    old = latest_per_key(before.select(*fixed, *counters), keys, stamp).alias("old")
    return new.join(old, keys, "left").select(
        *keys,
        F.col(f"new.{stamp}").alias(stamp),
        *[counter_change(F.col(f"old.{c}"), F.col(f"new.{c}")).alias(f"v_{c}") for c in counters],
    )
