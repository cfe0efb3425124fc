"""Sliding-window trend per (bucket, car, category) and its alerts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.dates import micros_between

# output column -> delta column it averages
MEASURES = {
    "total_view": "v_view_count",
    "total_comment": "v_comment_count",
    "total_upvote": "v_upvote_count",
    "total_downvote": "v_downvote_count",
}


@dataclass(frozen=True)
class TrendWindow:
    """Buckets end at the newest delta and step back over ``horizon``; each looks back ``width``."""

    horizon: timedelta = timedelta(hours=6)
    step: timedelta = timedelta(minutes=30)
    width: timedelta = timedelta(hours=3)

    @property
    def buckets(self) -> int:
        return self.horizon // self.step + 1

    @property
    def slot(self) -> timedelta:
        """The longest span that divides both step and width, so windows are whole slots."""
        micro = timedelta(microseconds=1)
        return gcd(self.step // micro, self.width // micro) * micro


def _micros(span: timedelta) -> Column:
    return F.lit(span // timedelta(microseconds=1)).cast("bigint")


def _minus(time: Column, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", -micros, time)


def latest(df: DataFrame, column: str) -> Column:
    """The largest value as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def latest_value(df: DataFrame, column: str) -> datetime | None:
    """The largest value itself: one row to the driver.

    A filter on a known value reaches the Parquet scan, one on a subquery does not; over a long
    history that is the difference between hours and years of rows.
    """
    return df.agg(F.max(column)).first()[0]


def _time(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest batch."""
    return df.where(F.col(column) == latest(df, column))


def time_buckets(deltas: DataFrame, window: TrendWindow = TrendWindow(), column: str = "extracted_at") -> DataFrame:
    """``bucket_end, window_start``: the newest time, stepping back, both ends included."""
    newest = deltas.agg(F.max(column).alias("newest")).where("newest IS NOT NULL")
    steps = F.explode(F.sequence(F.lit(0), F.lit(window.buckets - 1))).alias("i")
    return newest.select("newest", steps).select(
        _minus(F.col("newest"), F.col("i") * _micros(window.step)).alias("bucket_end"),
        _minus(F.col("newest"), _micros(window.horizon)).alias("window_start"),
    )


def target_posts(post_static: DataFrame, post_car: DataFrame) -> DataFrame:
    """``car_id, post_id, weight``: cars of each stored post.

    ``weight`` is how often the plain join would repeat the pair. Counting repeats instead of
    joining them keeps copies of one id from multiplying.
    """
    posts = post_static.groupBy(F.col("id").alias("post_id")).agg(F.count(F.lit(1)).alias("_posts"))
    cars = post_car.groupBy("post_id", "car_id").agg(F.count(F.lit(1)).alias("_cars"))
    return cars.join(posts, "post_id").select(
        "car_id", "post_id", (F.col("_posts") * F.col("_cars")).alias("weight")
    )


def post_category_count(sentence: DataFrame, keyword_category: DataFrame) -> DataFrame:
    """Keyword tags per (post, category) over post sentences, repeats counted.

    Both sides are counted down to one row per key before they meet.
    """
    sentences = (
        sentence.where("from_post")
        .groupBy(F.col("id").alias("sentence_id"), F.col("source_id").alias("post_id"))
        .agg(F.count(F.lit(1)).alias("_sentences"))
    )
    tags = keyword_category.groupBy("sentence_id", "category").agg(F.count("category").alias("_tags"))
    return (
        tags.join(sentences, "sentence_id")
        .groupBy("post_id", "category")
        .agg(F.sum(F.col("_sentences") * F.col("_tags")).alias("category_count"))
    )


def top_category(counts: DataFrame) -> DataFrame:
    """The category with most tags per post, ties to the first name."""
    best = F.min(F.struct((-F.col("category_count")).alias("_order"), "category"))
    return counts.groupBy("post_id").agg(best.alias("_best")).select("post_id", "_best.category")


def category_posts(top: DataFrame, targets: DataFrame) -> DataFrame:
    """``car_id, post_id, category, weight`` (C4)."""
    return targets.join(top, "post_id").select("car_id", "post_id", "category", "weight")


def _slots(deltas: DataFrame, newest: datetime, window: TrendWindow, *extra: Column) -> DataFrame:
    """Sums and counts per (id, slot); slot 0 ends at the newest time, ends included.

    A delta falls into one slot and every window is a run of slots, so deltas are summed once, on
    the map side first: an id with most of the deltas leaves each task as one row per slot. Deltas
    kept by ``day`` are read from the days that the windows reach.
    """
    earliest = newest - (window.horizon // window.step * window.step + window.width)
    recent = deltas.where(F.col("extracted_at") > _time(earliest))
    if "day" in deltas.columns:
        recent = recent.where(F.col("day") >= F.lit(earliest.date()))
    slot = F.floor(micros_between(F.col("extracted_at"), _time(newest)) / _micros(window.slot)).cast("int")
    measures = list(extra)
    for column in MEASURES.values():
        measures += [F.sum(column).alias(f"s_{column}"), F.count(column).alias(f"n_{column}")]
    return recent.groupBy("id", slot.alias("slot")).agg(*measures)


def _covers(bucket: Column, window: TrendWindow) -> Column:
    """Whether the window of ``bucket`` holds the row's slot."""
    step, width = window.step // window.slot, window.width // window.slot
    return F.col("slot").between(bucket * step, bucket * step + (width - 1))


def _each_bucket(window: TrendWindow) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(window.buckets - 1))).alias("bucket")


def _bucket_end(newest: Column, window: TrendWindow) -> Column:
    return _minus(newest, F.col("bucket") * _micros(window.step))


def interval_sums(deltas: DataFrame, newest: datetime, window: TrendWindow = TrendWindow()) -> DataFrame:
    """Deltas and view sum per (bucket, id) for ids with any delta in the bucket's window."""
    slots = _slots(deltas, newest, window, F.count(F.lit(1)).alias("_deltas"))
    covered = slots.select("*", _each_bucket(window)).where(_covers(F.col("bucket"), window))
    sums = covered.groupBy("bucket", "id").agg(
        F.sum("_deltas").alias("deltas"), F.coalesce(F.sum("s_v_view_count"), F.lit(0)).alias("views")
    )
    return sums.select(_bucket_end(_time(newest), window).alias("bucket_end"), "id", "deltas", "views")


def trend(
    deltas: DataFrame, posts: DataFrame, newest: datetime, window: TrendWindow = TrendWindow()
) -> DataFrame:
    """Mean change per (bucket, car, category); every pair appears in every bucket.

    ``posts`` is ``car_id, post_id, category, weight``, ``newest`` the end of the last bucket. One
    pass: posts meet the slot sums of their id, the result shrinks to (car, category, slot), and
    only that is copied to all buckets. A post without deltas keeps its pair in the grid.
    """
    slots = _slots(deltas, newest, window).withColumnRenamed("id", "post_id")
    columns = [f"{kind}_{column}" for column in MEASURES.values() for kind in ("s", "n")]
    per_slot = posts.join(slots, "post_id", "left").groupBy("car_id", "category", "slot").agg(
        *[F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns]
    )
    grid = per_slot.select("*", _each_bucket(window))
    inside = {c: F.sum(F.when(_covers(F.col("bucket"), window), F.col(c))) for c in columns}
    means = [
        F.coalesce(inside[f"s_{c}"] / F.nullif(inside[f"n_{c}"], F.lit(0)), F.lit(0.0)).alias(name)
        for name, c in MEASURES.items()
    ]
    return grid.groupBy("bucket", "car_id", "category").agg(*means).select(
        _bucket_end(_time(newest), window).alias("batch_time"), "car_id", "category", *MEASURES
    )


def dedupe_trend(trend_rows: DataFrame) -> DataFrame:
    """One row per (batch_time, car, category), the one with the largest view mean.

    Ties go to the larger of the other measures, so a rerun picks the same row.
    """
    keys = ["batch_time", "car_id", "category"]
    best = F.max(F.struct(*MEASURES)).alias("_best")
    return trend_rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def view_change(trend_rows: DataFrame) -> DataFrame:
    """Change of the view mean against the previous bucket of the pair."""
    pair = Window.partitionBy("car_id", "category").orderBy("batch_time")
    return trend_rows.withColumn("view_change", F.col("total_view") - F.lag("total_view").over(pair))


def change_threshold(changes: DataFrame, k: float = 2.0) -> DataFrame:
    """Mean, sample deviation and threshold of all changes (D3); one change gives a null threshold."""
    stats = changes.agg(F.avg("view_change").alias("mean"), F.stddev_samp("view_change").alias("std"))
    return stats.withColumn("threshold", F.col("mean") + F.lit(k) * F.col("std"))


def peak_change(changes: DataFrame) -> DataFrame:
    """Largest change and view mean per (car, category)."""
    return changes.groupBy("car_id", "category").agg(
        F.max("view_change").alias("view_change"), F.max("total_view").alias("total_view")
    )


def alerts(trend_rows: DataFrame, k: float = 2.0) -> DataFrame:
    """Pairs of the newest bucket whose change lies above the threshold of all changes."""
    changes = view_change(trend_rows)
    threshold = change_threshold(changes, k).select("threshold").scalar()
    return peak_change(latest_rows(changes, "batch_time")).where(F.col("view_change") > threshold)
