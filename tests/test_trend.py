import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forumlens.operators import trend as W
from forumlens.plans import jobs

END = datetime(2025, 2, 10, 12)
DELTA = "id string, extracted_at timestamp_ntz, v_view_count int, v_upvote_count int, v_downvote_count int, v_comment_count int"


def tables(spark, sentences, tags, posts, cars, deltas):
    return {
        "sentence": spark.createDataFrame(sentences, "id string, source_id string, from_post boolean"),
        "keyword_category": spark.createDataFrame(tags, "sentence_id string, category string, keyword string"),
        "post_static": spark.createDataFrame([(p,) for p in posts], "id string"),
        "post_car": spark.createDataFrame(cars, "post_id string, car_id string"),
        "deltas": spark.createDataFrame(deltas, DELTA),
    }


def brute(sentences, tags, posts, cars, deltas, window):
    """The joins row by row."""
    newest = max(d[1] for d in deltas)
    counts = {}
    for sid, source, from_post in sentences:
        for tag_sid, category, _ in tags:
            if sid == tag_sid and from_post:
                counts[(source, category)] = counts.get((source, category), 0) + 1
    top = {}
    for (post, category), n in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0][1])):
        top.setdefault(post, category)
    pairs = [(car, post, top[post]) for post in posts for p, car in cars if p == post and post in top]
    out = {}
    for i in range(window.horizon // window.step + 1):
        end = newest - i * window.step
        for car, post, category in pairs:
            values = out.setdefault((end, car, category), [[], [], [], []])
            for d in deltas:
                if d[0] == post and end - window.width < d[1] <= end:
                    for column, index in zip(values, (2, 5, 3, 4)):
                        if d[index] is not None:
                            column.append(d[index])
    return {k: tuple(round(sum(v) / len(v), 9) if v else 0.0 for v in vs) for k, vs in out.items()}


def collected(df):
    return {(r.batch_time, r.car_id, r.category): tuple(round(r[c], 9) for c in W.MEASURES) for r in df.collect()}


SMALL = (
    [("p1_0", "p1", True), ("p1_1", "p1", True), ("p2_0", "p2", True), ("p3_0", "p3", False), ("p4_0", "p4", True)],
    [("p1_0", "b", "x"), ("p1_1", "a", "y"), ("p2_0", "a", "x"), ("p2_0", "a", "x"), ("p2_0", "c", "z"), ("p3_0", "a", "x"), ("p4_0", "d", "x")],
    ["p1", "p2", "p3", "p4"],
    [("p1", "car1"), ("p1", "car2"), ("p2", "car1"), ("p3", "car1"), ("p4", "car2")],
    [
        ("p1", END, 10, 1, None, None), ("p1", END - timedelta(hours=3), 20, None, 2, None),
        ("p2", END - timedelta(hours=3) + timedelta(microseconds=1), 7, 0, 0, 0), ("p3", END, 99, 9, 9, 9),
        ("p2", END - timedelta(hours=9, microseconds=-1), 5, None, None, 1), ("p2", END - timedelta(hours=9), 1000, 1, 1, 1),
    ],
)


def test_trend_edges(spark):
    got = collected(jobs.trend_from_tables(**tables(spark, *SMALL)))
    assert got == brute(*SMALL, W.TrendWindow())
    # the delta exactly three hours before the end is out, one microsecond later is in
    assert got[(END, "car1", "a")][0] == pytest.approx((10 + 7) / 2)
    # no deltas: dense zeros; an untitled post has no category
    assert got[(END, "car2", "d")] == (0.0, 0.0, 0.0, 0.0)
    assert len(got) == 13 * 3


@pytest.mark.parametrize("window", [
    W.TrendWindow(),
    W.TrendWindow(timedelta(hours=5), timedelta(minutes=50), timedelta(minutes=70)),
    W.TrendWindow(timedelta(hours=4), timedelta(hours=1), timedelta(minutes=20)),
])
def test_trend_equals_brute_force_with_copies(spark, window):
    rng = random.Random(7)
    posts = [f"p{i}" for i in range(8)] + ["p1", "p1"]
    sentences = [(f"p{i}_{j}", f"p{i}", rng.random() < 0.8) for i in range(8) for j in range(3)] + [("p1_0", "p1", True)] * 3
    tags = [(f"p{rng.randrange(8)}_{rng.randrange(3)}", rng.choice("abc"), "k") for _ in range(40)] + [("p1_0", "a", "k")] * 4
    cars = [(f"p{i}", f"car{rng.randrange(3)}") for i in range(8) for _ in range(2)]
    deltas = [
        (f"p{rng.randrange(9)}", END - timedelta(minutes=10 * rng.randrange(60)), rng.randrange(50), None, rng.randrange(3), rng.choice([None, 4]))
        for _ in range(300)
    ]
    data = (sentences, tags, posts, cars, deltas)
    assert collected(jobs.trend_from_tables(**tables(spark, *data), window=window)) == brute(*data, window)


def test_no_deltas_no_trend(spark):
    assert jobs.trend_from_tables(**tables(spark, *SMALL[:4], [])).count() == 0


def test_time_filter_reaches_the_scan(spark, folder):
    made = tables(spark, *SMALL)
    made["deltas"].write.parquet(f"{folder}/deltas")
    trend = jobs.trend_from_tables(**{**made, "deltas": spark.read.parquet(f"{folder}/deltas")})
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(extracted_at,2025-02-10T03:00)" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def trend_rows(spark, views):
    rows = [(END - timedelta(minutes=30 * (len(views) - 1 - i)), "car", "a", float(v), 0.0, 0.0, 0.0) for i, v in enumerate(views)]
    return spark.createDataFrame(rows, "batch_time timestamp_ntz, car_id string, category string, total_view double, total_comment double, total_upvote double, total_downvote double")


def test_alert_on_a_jump(spark):
    rows = trend_rows(spark, [10, 10, 10, 10, 10, 10, 10, 100])
    got = W.alerts(rows).collect()
    assert [(r.car_id, r.view_change, r.total_view) for r in got] == [("car", 90.0, 100.0)]


def test_no_alert_from_one_bucket_or_at_the_threshold(spark):
    assert W.alerts(trend_rows(spark, [10, 100])).count() == 0  # one change: no deviation
    assert W.alerts(trend_rows(spark, [10, 20, 30])).count() == 0  # change equals the threshold
    assert W.alerts(trend_rows(spark, [10])).count() == 0


def test_dedupe_keeps_largest(spark):
    rows = trend_rows(spark, [10]).unionByName(trend_rows(spark, [30])).unionByName(trend_rows(spark, [30]))
    assert [r.total_view for r in W.dedupe_trend(rows).collect()] == [30.0]


def test_run_trend_end_to_end(spark, folder):
    for name, df in tables(spark, *SMALL).items():
        df.write.parquet(f"{folder}/{'v_post_dynamic' if name == 'deltas' else name}")
    now = F.lit("2025-02-10 21:00:00").cast("timestamp_ntz")
    for _ in range(2):
        alerts = jobs.run_trend(spark, folder, now, k=-9.0, footer="the board")
        found = alerts.collect()
    assert spark.read.parquet(f"{folder}/v_total_trend").count() == 39
    message = json.loads(found[0].payload)
    blocks = message["attachments"][0]["blocks"]
    assert [b["type"] for b in blocks] == ["header", "divider", "section", "context"]
    assert "2025-02-10 21:00:00" in blocks[2]["fields"][0]["text"] and "text" not in blocks[1]
