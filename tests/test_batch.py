"""Three batches end to end, from raw JSON to alerts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.operators.sentiment import word_scorer
from forumlens.plans.batch import Folders, Settings, run_batch
from forumlens.sources import raw

START = datetime(2025, 2, 10, 0, 0)


def post(spark, number, car, views, batch, date):
    comment = {
        "comment_id": number * 10, "content": f"comment of {number} is good", "is_reply": "0",
        "created_at": "2025-02-10T01:00:00", "upvote_count": views, "downvote_count": 0,
    }
    row = (
        str(number), f"https://x/{number}", "The led lamp failed", f"Body text {number} with gas. mail me@x.co now",
        "2025-02-10T00:30:00Z", views, 1, None, 1, [comment], "alpha", car, date, batch,
    )
    columns = schemas.RAW_POST.simpleString()[7:-1] + ",community:string,car_id:string,date:string,batch:int"
    return spark.createDataFrame([row], columns)


def test_three_batches(spark, folder):
    folders = Folders(*[f"{folder}/{n}" for n in ("raw", "work", "warehouse", "ledger", "batches")])
    settings = Settings({"design": ["LED", "LAMP"], "fault": ["FAILED", "GAS"]}, word_scorer(["good"], ["failed"]), threshold=0.5)
    views = {1: [10, 15, 95], 2: [3, 4, 4]}
    for step in range(3):
        time = START + timedelta(minutes=30 * step)
        local = time + timedelta(hours=9)
        date, batch = local.strftime("%Y-%m-%d"), local.hour * 60 + local.minute
        for number, counts in views.items():
            for car in ("ev", "suv") if number == 1 else ("suv",):
                raw.write_raw_posts(post(spark, number, car, counts[step], batch, date), folders.raw)
        alerts = run_batch(spark, folders, time, settings).collect()

    def table(name):
        return spark.read.parquet(f"{folders.warehouse}/{name}")

    assert sorted(r.id for r in table("post_static").collect()) == ["alpha_post_1", "alpha_post_2"]
    assert table("post_static").where("id = 'alpha_post_1'").first().content == "Body text 1 with gas. mail <EMAIL> now"
    assert table("comment_static").count() == 2
    assert sorted(map(tuple, table("post_car").collect())) == [("alpha_post_1", "ev"), ("alpha_post_1", "suv"), ("alpha_post_2", "suv")]
    assert table("post_dynamic").count() == 6
    moves = {(r.id, r.extracted_at): r.v_view_count for r in table("v_post_dynamic").collect()}
    first = START + timedelta(hours=9)
    assert [moves[("alpha_post_1", first + timedelta(minutes=30 * i))] for i in range(3)] == [10, 5, 80]
    assert [moves[("alpha_post_2", first + timedelta(minutes=30 * i))] for i in range(3)] == [3, 1, 0]
    sentences = {r.id: (r.sentence, r.from_post, r.sentiment) for r in table("sentence").collect()}
    assert sentences["alpha_post_1_0"] == ("The led lamp failed", True, -1)
    assert sentences["alpha_comment_10_0"] == ("comment of 1 is good", False, 1)
    tags = sorted((r.sentence_id, r.keyword) for r in table("keyword_category").collect())
    assert ("alpha_post_1_0", "LAMP") in tags and ("alpha_post_1_1", "GAS") in tags
    trend = table("v_total_trend")
    # 13 buckets for the first batch, one more for each later one; the window of three runs covers all
    assert trend.count() == trend.select("batch_time", "car_id", "category").distinct().count()
    last = first + timedelta(minutes=60)
    newest = {r.car_id: r.total_view for r in trend.where(F.col("batch_time") == F.lit(str(last)).cast("timestamp_ntz")).collect()}
    assert newest == {"ev": (10 + 5 + 80) / 3, "suv": (10 + 5 + 80 + 3 + 1 + 0) / 6}
    assert {r.car_id for r in alerts} == {"ev", "suv"}
