from datetime import datetime

from forumlens.operators import batches
from forumlens.operators import report as R
from forumlens.plans import jobs
from pyspark.sql import functions as F

RESULTS = "car_id string, community string, attempted_posts_count long, extracted_posts_count long"


def test_report_lines(spark):
    rows = [("x", "alpha", 1500, 1500), ("y", "alpha", None, None), ("x", "beta", 0, 0), ("x", "gamma", 10, 8), ("x", "delta", 10, 6)]
    got = {r.community: r for r in jobs.extraction_report(spark.createDataFrame(rows, RESULTS)).collect()}
    assert {c: (r.success_rate, r.band) for c, r in got.items()} == {
        "alpha": (100.0, "green"), "beta": (0.0, "red"), "gamma": (80.0, "yellow"), "delta": (60.0, "red"),
    }
    assert got["alpha"].line == "*ALPHA*\n시도: `1,500건` | 성공: `1,500건` | 🟢 성공률: `100.0%`"


def test_totals_cover_configured_communities(spark):
    listed = spark.createDataFrame([("alpha",), ("none",)], "community string")
    got = R.community_totals(spark.createDataFrame([("x", "alpha", 3, None)], RESULTS), listed).collect()
    assert sorted(map(tuple, got)) == [("alpha", 3, 0), ("none", 0, 0)]


def test_status_rollup(spark):
    cars = spark.createDataFrame([("x",), ("y",)], "car_id string")
    results = [
        ("x", "alpha", '{"body": {"success": true, "attempted_posts_count": 3, "extracted_posts_count": 2}}'),
        ("x", "beta", '{"body": {"success": false, "error": "boom", "attempted_posts_count": 1}}'),
        ("y", "alpha", "oops"), ("y", "beta", None),
    ]
    df = spark.createDataFrame(results, "car_id string, community string, result string")
    got = sorted(map(tuple, R.status_rollup(cars, ["alpha", "beta"], df).collect()))
    assert got == [
        ("x", "alpha", True, None, 3, 2), ("x", "beta", False, "boom", None, None),
        ("y", "alpha", True, None, None, None), ("y", "beta", False, "No data returned from task", None, None),
    ]


def test_statistics_of_a_run(spark):
    one = {"success": True, "error": None, "attempted_posts_count": 2, "extracted_posts_count": 1}
    failed = {"success": False, "error": "x", "attempted_posts_count": None, "extracted_posts_count": None}
    schema = "statistics map<string, map<string, struct<success:boolean, error:string, attempted_posts_count:long, extracted_posts_count:long>>>"
    df = spark.createDataFrame([({"x": {"alpha": one, "beta": failed}, "y": {"alpha": one}},)], schema)
    got = sorted(map(tuple, R.community_totals(R.explode_statistics(df)).collect()))
    assert got == [("alpha", 4, 2), ("beta", 0, 0)]


def test_attempt_accounting(spark):
    rows = [("r", "failed"), ("r", "skipped"), ("r", "saved"), ("r", "saved"), ("s", "skipped")]
    got = R.attempt_accounting(spark.createDataFrame(rows, "run string, status string"), ["run"])
    assert sorted(map(tuple, got.collect())) == [("r", 3, 2), ("s", 0, 0)]


def test_last_attempt_wins(spark):
    rows = [("p", 1, "old"), ("p", 2, "new"), ("q", 1, "only")]
    got = R.last_attempt(spark.createDataFrame(rows, "id string, attempt int, url string"), ["id"], "attempt")
    assert sorted(map(tuple, got.collect())) == [("p", 2, "new"), ("q", 1, "only")]


def test_previous_batch_across_days(spark):
    rows = [("2025-02-10", 1410), ("2025-02-11", 0), ("2025-02-11", 30), ("2025-02-20", 90)]
    got = batches.previous_batch(spark.createDataFrame(rows, "date string, batch int"))
    assert sorted(map(tuple, got.collect())) == [
        ("2025-02-10", 1410, None, None), ("2025-02-11", 0, "2025-02-10", 1410),
        ("2025-02-11", 30, "2025-02-11", 0), ("2025-02-20", 90, "2025-02-11", 30),
    ]


def test_ledger_of_first_and_repeated_runs(spark, folder):
    def run(time):
        now = F.lit(time).cast("timestamp_ntz")
        current = spark.range(1).select(*batches.batch_identity(now))
        return tuple(jobs.batch_ledger(spark, f"{folder}/batches", current).select("date", "batch", "prev_date", "prev_batch").first())

    assert run("2025-02-10 14:30:00") == ("2025-02-10", 1410, None, None)
    assert run("2025-02-10 15:00:00") == ("2025-02-11", 0, "2025-02-10", 1410)
    assert run("2025-02-10 15:00:00") == ("2025-02-11", 0, "2025-02-10", 1410)


def test_batch_identity(spark):
    now = F.lit("2025-02-10 15:30:00").cast("timestamp_ntz")
    row = spark.range(1).select(*batches.batch_identity(now)).first()
    assert tuple(row) == ("2025-02-11", "00:30:00", 30, datetime(2025, 2, 10, 0, 30), datetime(2025, 2, 11, 0, 30))


def test_page_date_span(spark):
    rows = [(1, "2025-02-10"), (1, "2025-02-01"), (2, "2025-01-01")]
    got = R.date_span(spark.createDataFrame(rows, "page int, day string"), ["page"], "day")
    assert sorted(map(tuple, got.collect())) == [(1, "2025-02-01", "2025-02-10"), (2, "2025-01-01", "2025-01-01")]
