from datetime import datetime, timedelta

from forumlens.streaming import keyed, progress, sinks, windows

T = [datetime(2025, 2, d) for d in (10, 11, 12)]


def feed(spark, folder, batches, columns, sink, transform=lambda stream: stream, state=None):
    for rows in batches:
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(columns).parquet(f"{folder}/in")
        sinks.run_available(transform(stream), sink, f"{folder}/offsets", state=state)


def test_first_seen_passes_each_id_once(spark, folder):
    sink = sinks.first_seen(f"{folder}/out", f"{folder}/ledger")
    feed(spark, folder, [[("a", 1), ("a", 2), ("b", 1)], [("b", 5), ("c", 1)]], "id string, n int", sink)
    got = sorted((r.id, r.n) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [("a", 1), ("b", 1), ("c", 1)]


def test_slots_then_windows_give_each_window_once(spark, folder):
    at = [datetime(2025, 2, 10, h, m) for h, m in ((1, 0), (1, 10), (1, 30), (4, 0))]
    end = datetime(2025, 2, 20)
    batches = [
        [("a", at[0], 4), ("a", at[1], 8), ("b", at[2], None)],
        [("a", at[3], 1), ("a", at[0], 2)],  # the second one is within the watermark's three hours
        [("z", end, 0)],
        [("a", at[0], 1000)],  # late
    ]
    feed(spark, folder, batches, "id string, extracted_at timestamp_ntz, v_view_count int", sinks.versioned(f"{folder}/out"), windows.slot_means)
    rows = [r for r in spark.read.parquet(f"{folder}/out").collect() if r.id != "z"]
    got = {(r.bucket_end, r.id): (r.deltas, r.mean_view) for r in rows}
    assert len(got) == len(rows)
    want = {}
    values = [("a", at[0], 4), ("a", at[1], 8), ("b", at[2], None), ("a", at[3], 1), ("a", at[0], 2)]
    for n in range(2, 16):
        bucket = datetime(2025, 2, 10) + timedelta(minutes=30 * n)
        for key in "ab":
            inside = [v for i, t, v in values if i == key and bucket - timedelta(hours=3) < t <= bucket]
            known = [v for v in inside if v is not None]
            if inside:
                want[bucket, key] = (len(known), sum(known) / len(known) if known else None)
    assert got == want


def test_rows_of_streams_are_counted_by_their_micro_batches(spark, folder):
    batches = [[("a", 1), ("a", 2)], [("b", 1)], [("c", 1), ("c", 2), ("c", 3)]]
    with progress.row_counts(spark) as counts:
        feed(spark, folder, batches, "id string, n int", sinks.versioned(f"{folder}/out"), lambda s: progress.counted(s, "all").where("n > 1"))
    assert counts.rows == {"all": 6} and sorted(counts.inputs.values()) == [1, 2, 3]
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_replayed_batch_gives_the_same_rows(spark, folder):
    sink = sinks.first_seen(f"{folder}/out", f"{folder}/ledger")
    batch = spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int")
    for _ in range(2):
        sink(batch, 0)
    assert spark.read.parquet(f"{folder}/out").count() == 2
    assert spark.read.parquet(f"{folder}/ledger").count() == 2


def test_delta_forgets_ids_that_skip_a_batch(spark, folder):
    sink = sinks.stream_delta(f"{folder}/out", f"{folder}/state", ["id"])
    batches = [[("a", T[0], 5), ("b", T[0], 1)], [("b", T[1], 4)], [("a", T[2], 9), ("b", T[2], 4)]]
    feed(spark, folder, batches, "id string, extracted_at timestamp_ntz, view_count int", sink)
    got = sorted((r.extracted_at, r.id, r.v_view_count) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [(T[0], "a", 5), (T[0], "b", 1), (T[1], "b", 3), (T[2], "a", 9), (T[2], "b", 0)]


def test_first_seen_within_watermark(spark, folder):
    batches = [[("a", T[0]), ("a", T[0]), ("b", T[0])], [("b", T[0]), ("c", T[1])]]
    transform = lambda stream: windows.first_seen_within(stream, "id", "at", "1 hour")
    feed(spark, folder, batches, "id string, at timestamp_ntz", sinks.versioned(f"{folder}/out"), transform)
    got = sorted((r.id, r["at"]) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [("a", T[0]), ("b", T[0]), ("c", T[1])]


def test_closed_windows_are_emitted_once_and_late_rows_dropped(spark, folder):
    at = [datetime(2025, 2, 10, 12), datetime(2025, 2, 10, 12, 0, 0, 1), datetime(2025, 2, 12)]
    batches = [[("a", at[0], 4), ("a", at[1], 8)], [("b", at[2], 1)], [("a", at[0], 100), ("b", at[2], 1)], [("c", at[2], 1)]]
    transform = lambda stream: windows.sliding_means(stream, late="1 hour")
    feed(spark, folder, batches, "id string, extracted_at timestamp_ntz, v_view_count int", sinks.versioned(f"{folder}/out"), transform)
    got = {r.bucket_end: (r.deltas, r.mean_view) for r in spark.read.parquet(f"{folder}/out").where("id = 'a'").collect()}
    # noon belongs to the buckets ending at noon up to 14:30, a microsecond later to 12:30 up to 15:00
    assert got[at[0]] == (1, 4.0) and got[datetime(2025, 2, 10, 12, 30)] == (2, 6.0)
    assert got[datetime(2025, 2, 10, 15)] == (1, 8.0) and len(got) == 7


def test_a_new_run_keeps_the_outputs_of_the_others_and_goes_on_from_them(spark, folder):
    columns = "id string, extracted_at timestamp_ntz, view_count int"
    for run, batches in (("1", [[("a", T[0], 5)], [("a", T[1], 7)]]), ("2", [[("a", T[2], 20)]])):
        sink = sinks.stream_delta(f"{folder}/out", f"{folder}/state", ["id"], run=run)
        for number, rows in enumerate(batches):
            sink(spark.createDataFrame(rows, columns), number)
    got = sorted((r.extracted_at, r.v_view_count) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [(T[0], 5), (T[1], 2), (T[2], 13)]
    means = "bucket_end timestamp_ntz, id string, deltas long"
    for run, deltas in (("1", 4), ("2", 9)):
        sinks.versioned(f"{folder}/means", run)(spark.createDataFrame([(T[0], "a", deltas)], means), 0)
    table = spark.read.parquet(f"{folder}/means")
    assert table.count() == 2 and sinks.newest_versions(table, ["bucket_end", "id"]).collect()[0].deltas == 9


SNAPSHOT = "id string, extracted_at timestamp_ntz, view_count int, likes long"


def changes(spark, folder, batches, late="1 second"):
    transform = lambda stream: keyed.snapshot_changes(stream, ["id"], timedelta(days=1), late)
    feed(spark, folder, batches, SNAPSHOT, sinks.versioned(f"{folder}/out"), transform, sinks.ON_DISK)
    return sorted(((r.extracted_at, r.id, r.v_view_count, r.v_likes) for r in spark.read.parquet(f"{folder}/out").collect()), key=str)


def test_keyed_changes_start_again_from_the_checkpoint(spark, folder):
    """Each batch is a query of its own; an id that skips a snapshot is new in the next, nulls stay as they are."""
    large = 1 << 60
    batches = [[("a", T[0], 5, large), ("b", T[0], 1, None)], [("b", T[1], 4, 2)], [("a", T[2], 9, large + 1), ("b", T[2], None, 5), (None, T[2], 1, 1)]]
    got = changes(spark, folder, batches)
    assert got == sorted([
        (T[0], "a", 5, large), (T[0], "b", 1, None), (T[1], "b", 3, 2), (T[2], "a", 9, large + 1), (T[2], "b", None, 3), (T[2], None, 1, 1),
    ], key=str)


def test_keyed_changes_of_several_snapshots_in_one_batch_and_one_over_several(spark, folder):
    batches = [[("a", T[1], 7, 1), ("a", T[0], 5, 1), ("a", T[1], 7, 1)], [("b", T[1], 2, 0)], [("a", T[2], 8, 1), ("b", T[2], 2, 0)]]
    got = changes(spark, folder, batches, "2 days")
    assert got == [(T[0], "a", 5, 1), (T[1], "a", 2, 0), (T[1], "b", 2, 0), (T[2], "a", 1, 0), (T[2], "b", 0, 0)]


def test_late_snapshots_and_repeats_change_nothing(spark, folder):
    batches = [[("a", T[1], 7, 0)], [("a", T[0], 5, 0), ("b", T[0], 5, 0)], [("a", T[1], 7, 0)], [("a", T[2], 8, 0)]]
    got = changes(spark, folder, batches, "5 days")
    # within the watermark the late row of another id counts; behind its own newest row nothing does
    assert got == [(T[0], "b", 5, 0), (T[1], "a", 7, 0), (T[2], "a", 1, 0)]
    assert changes(spark, f"{folder}/strict", [[("a", T[1], 7, 0)], [("c", T[2], 1, 0)], [("b", T[0], 5, 0)], [("a", T[2], 8, 0)]]) == [
        (T[1], "a", 7, 0), (T[2], "a", 1, 0), (T[2], "c", 1, 0),
    ]


def test_state_goes_when_an_id_skips_a_snapshot(spark, folder):
    far = datetime(2025, 3, 1)
    batches = [[("a", T[0], 5, 0), ("b", T[0], 5, 0)], [("b", T[1], 6, 0)], [("b", far, 1, 0)], [("b", far + timedelta(days=1), 1, 0)]]
    changes(spark, folder, batches)
    left = spark.read.format("statestore").option("stateVarName", "last").load(f"{folder}/offsets")
    assert [r.key[0] for r in left.collect()] == ['{"id":"b"}']
