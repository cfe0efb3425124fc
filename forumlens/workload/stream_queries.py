"""The three stream-shaped behaviours, run over what the source holds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from forumlens.runtime import new_path
from forumlens.streaming import keyed, progress, sinks, windows
from forumlens.workload import bindings as B
from forumlens.workload.bindings import with_views
from forumlens.workload.registry import query


def _feed(parts, path, sink, transform=None, mode="append", state=None):
    """Each part of the table is added to the source folder and processed by a run of its own."""
    spark = parts[0].sparkSession
    offsets = new_path(spark, "offsets")
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(part.schema).parquet(path)
        sinks.run_available(transform(stream) if transform else stream, sink, offsets, mode, state)


@query("L1", with_views(
    """SELECT bucket_end, id, count(v_view_count) AS deltas, round(avg(v_view_count), 6) AS mean_view
    FROM deltas, (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 30 MINUTE)) AS bucket_end) b
    WHERE extracted_at <= bucket_end AND extracted_at > bucket_end - INTERVAL 3 HOUR GROUP BY 1, 2""", "deltas"))
def stream_sliding_means(spark, sf):
    """Earlier days first, then the rest: windows across the cut are updated."""
    out, rows = new_path(spark, "means"), B.deltas(spark, sf)
    early = F.col("extracted_at") < B.ts(B.BEFORE_TIME)
    _feed(
        [rows.where(early), rows.where(~early)], new_path(spark, "delta_stream"), sinks.versioned(out),
        lambda stream: windows.sliding_means(stream, late="3 hours"), "update",
    )
    return sinks.newest_versions(spark.read.parquet(out), ["bucket_end", "id"]).withColumn("mean_view", F.round("mean_view", 6))


@query("L1", with_views(
    """SELECT bucket_end, id, count(v_view_count) AS deltas, round(avg(v_view_count), 6) AS mean_view
    FROM deltas, (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 30 MINUTE)) AS bucket_end) b
    WHERE extracted_at <= bucket_end AND extracted_at > bucket_end - INTERVAL 3 HOUR GROUP BY 1, 2""", "deltas"))
def stream_slot_means(spark, sf):
    """Earlier days, then the rest, then a row of another month that closes all windows, then late copies of all rows, which are dropped."""
    out, rows = new_path(spark, "slots"), B.deltas(spark, sf).select("id", "extracted_at", "v_view_count")
    early = F.col("extracted_at") < B.ts(B.BEFORE_TIME)
    closing = rows.agg(F.lit("closing").alias("id"), (F.max("extracted_at") + F.expr("INTERVAL 60 DAYS")).alias("extracted_at"), F.lit(0).cast(rows.schema["v_view_count"].dataType).alias("v_view_count"))
    _feed([rows.where(early), rows.where(~early), closing, rows], new_path(spark, "slot_stream"), sinks.versioned(out), windows.slot_means)
    return spark.read.parquet(out).where("id != 'closing'").select("bucket_end", "id", "deltas", F.round("mean_view", 6).alias("mean_view"))


@query("L2", "SELECT source AS id FROM documents GROUP BY 1")
def stream_first_seen(spark, sf):
    """The same sources come in every part; each is passed on once."""
    out, ledger = new_path(spark, "first"), new_path(spark, "ledger")
    docs = B.table(spark, sf, "documents").select(F.col("source").alias("id"), "lang")
    english = F.col("lang").eqNullSafe("en")
    _feed([docs.where(english), docs.where(~english)], new_path(spark, "posts"), sinks.first_seen(out, ledger))
    return spark.read.parquet(out).select("id")


@query("D12 L1 L2 L3", with_views(
    """SELECT 'documents' AS stream, count(*) AS rows_in FROM documents UNION ALL SELECT 'deltas', count(*) FROM deltas
    UNION ALL SELECT 'snapshots', (SELECT count(*) FROM before) + (SELECT count(*) FROM after)""", "deltas", "before", "after"))
def stream_row_counts(spark, sf):
    """The rows that each of the three streams took in, as their micro-batches reported them."""
    docs = B.table(spark, sf, "documents").select(F.col("source").alias("id"), "lang")
    snapshots = [B.snapshot(spark, sf, time) for time in (B.BEFORE_TIME, B.BATCH_TIME)]
    with progress.row_counts(spark) as counts:
        _feed([docs], new_path(spark, "posts"), sinks.first_seen(new_path(spark, "first"), new_path(spark, "ledger")), lambda s: progress.counted(s, "documents"))
        _feed(
            [B.deltas(spark, sf)], new_path(spark, "delta_stream"), sinks.versioned(new_path(spark, "means")),
            lambda s: windows.sliding_means(progress.counted(s, "deltas")), "update",
        )
        _feed(
            snapshots, new_path(spark, "snapshots"), sinks.stream_delta(new_path(spark, "moves"), new_path(spark, "state"), ["id"]),
            lambda s: progress.counted(s, "snapshots"),
        )
    return spark.createDataFrame(sorted(counts.rows.items()), "stream string, rows_in long")


@query("L3", with_views(
    """SELECT id, extracted_at, view_count AS v_view_count FROM before UNION ALL
    SELECT a.id, a.extracted_at, a.view_count - coalesce(b.view_count, 0) FROM after a LEFT JOIN before b USING (id)""", "before", "after"))
def stream_delta(spark, sf):
    """Two snapshots arrive as two micro-batches."""
    out = new_path(spark, "moves")
    snapshots = [B.snapshot(spark, sf, time) for time in (B.BEFORE_TIME, B.BATCH_TIME)]
    _feed(snapshots, new_path(spark, "snapshots"), sinks.stream_delta(out, new_path(spark, "state"), ["id"]))
    return spark.read.parquet(out).select("id", "extracted_at", "v_view_count")


_COUNTERS = ["view_count", "upvote_count", "downvote_count", "comment_count"]


def _change(counter: str) -> str:
    return f"CASE WHEN b.{counter} IS NULL THEN a.{counter} ELSE a.{counter} - b.{counter} END AS v_{counter}"


@query("L3", with_views(
    f"""SELECT id, extracted_at, {", ".join(f"{c} AS v_{c}" for c in _COUNTERS)} FROM before UNION ALL
    SELECT a.id, a.extracted_at, {", ".join(map(_change, _COUNTERS))} FROM after a LEFT JOIN before b USING (id)""", "before", "after"))
def stream_delta_state(spark, sf):
    """Two snapshots a day apart, each in a run of its own that starts again from the checkpoint; the newer one comes twice."""
    out = new_path(spark, "moves")
    before, after = (B.snapshot(spark, sf, time) for time in (B.BEFORE_TIME, B.BATCH_TIME))
    _feed(
        [before, after, after], new_path(spark, "snapshots"), sinks.versioned(out),
        lambda stream: keyed.snapshot_changes(stream, ["id"], timedelta(days=1)), state=sinks.ON_DISK,
    )
    return spark.read.parquet(out).select("id", "extracted_at", *[f"v_{c}" for c in _COUNTERS])
