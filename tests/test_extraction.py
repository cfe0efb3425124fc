"""Saved pages to raw posts, run results and the report message."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forumlens import __main__ as entry
from forumlens.plans import extraction
from forumlens.plans.batch import Folders, Settings, run_batch
from forumlens.sources import raw

PAGES = "car_id string, community string, post_id string, url string, html string, created_at string"
RUN = datetime(2025, 2, 10, 2, 0)  # 11:00 local


def stacked(date, title="A ship", body="It sails well."):
    return f"""<div class="content_view"><h3 class="post_subject"><span>c</span><span>{title}</span></h3><span class="view_count date">{date} edited</span>
    <span class="view_count"><strong>1,204</strong></span><div class="post_article">{body}</div>
    <div class="comment_row" data-comment-sn="9"><span class="timestamp">2025-02-10 09:00:00</span><div class="comment_view">Nice one.</div></div></div>"""


GALLERY = """<span class="title_subject">T</span><div class="write_div">b</div>"""


@pytest.fixture
def saved(spark):
    rows = [
        ("a", "s", "1", "u/1", stacked("2025-02-10 08:00:00"), None),
        ("a", "s", "2", "u/2", stacked("2025-02-08 08:00:00"), None),  # before the range
        ("a", "s", "3", "u/3", stacked("no date"), None),
        ("a", "s", "4", "u/4", None, None),
        ("b", "g", "5", "u/5", GALLERY, "02.09 23:00:00"),  # dated by the listing
        ("b", "g", "6", "u/6", "", "02.09 23:00:00"),
        ("b", "unknown", "7", "u/7", GALLERY, "2025-02-10 08:00:00"),
    ]
    return spark.createDataFrame(rows, PAGES)


LAYOUTS = {"s": extraction.KINDS["stacked"], "g": extraction.KINDS["gallery"]}


def test_pages_become_raw_posts_and_results(spark, saved, folder):
    for _ in range(2):  # a rerun replaces
        extraction.run_extract(spark, saved, f"{folder}/raw", f"{folder}/results", LAYOUTS, RUN)
    posts, rejects = raw.read_raw_posts(spark, f"{folder}/raw", one_per_file=False)
    got = {r.post_id: r for r in posts.collect()}
    assert set(got) == {"1", "5"} and rejects.count() == 0
    assert (got["1"].car_id, got["1"].community, got["1"].view_count, got["1"].comments[0].content) == ("a", "s", 1204, "Nice one.")
    assert got["5"].created_at == "2025-02-09T23:00:00"
    assert {(r.date, r.batch) for r in posts.select(F.col("date").cast("string").alias("date"), "batch").collect()} == {("2025-02-10", 660)}
    counts = {(r.car_id, r.community): (r.attempted_posts_count, r.extracted_posts_count) for r in spark.read.parquet(f"{folder}/results").collect()}
    assert counts == {("a", "s"): (3, 1), ("b", "g"): (2, 1)}


def test_no_pages(spark, saved, folder):
    extraction.run_extract(spark, saved.limit(0), f"{folder}/raw", f"{folder}/results", LAYOUTS, RUN)
    assert spark.read.parquet(f"{folder}/results").count() == 0


def test_from_pages_to_the_warehouse(spark, saved, folder):
    """What the extraction writes is what a batch reads."""
    extraction.run_extract(spark, saved, f"{folder}/raw", f"{folder}/results", LAYOUTS, RUN)
    folders = Folders(*[f"{folder}/{n}" for n in ("raw", "work", "warehouse", "ledger", "batches")])
    run_batch(spark, folders, RUN, Settings({"d": ["SAIL"]}, lambda: lambda texts: [1] * len(texts))).collect()
    posts = {r.id for r in spark.read.parquet(f"{folder}/warehouse/post_static").collect()}
    assert posts == {"s_post_1", "g_post_5"}
    assert {r.keyword for r in spark.read.parquet(f"{folder}/warehouse/keyword_category").collect()} == {"SAIL"}


def message(spark, rows, communities, footer=extraction.REPORT_FOOTER):
    results = spark.createDataFrame(rows, "car_id string, community string, attempted_posts_count long, extracted_posts_count long")
    times = [F.lit(t).cast("timestamp_ntz") for t in ("2025-02-10 02:00:00", "2025-02-10 02:00:05.4", "2025-02-10 03:02:07.1")]
    return json.loads(extraction.report_message(results, communities, *times, footer=footer).first().payload)["blocks"]


def test_whole_message(spark):
    cars = [("e", 1, 0, 1), ("i", 1, 0, 2), ("p", 1, 0, 17)]
    rows = [(car, name, n, n) for car, *counts in cars for name, n in zip("xyz", counts)] + [("e", "w", 1500, 1200), ("i", "w", None, None), ("e", "other", 5, 5)]
    blocks = message(spark, rows, ["x", "y", "z", "w", "v"])
    assert [b["type"] for b in blocks] == ["header", "divider", *["section"] * 8, "divider", "context"]
    assert blocks[0]["text"] == {"type": "plain_text", "text": "📊 데이터 수집 리포트", "emoji": True}
    assert blocks[1] == {"type": "divider"}
    assert [f["text"] for f in blocks[2]["fields"]] == ["*Logical Date:*\n2025-02-10", "*Logical Time:*\n11:00:00", "*Batch:*\n#660"]
    assert [f["text"] for f in blocks[3]["fields"]] == ["*시작 시간:*\n2025-02-10 11:00:05", "*소요 시간:*\n01:02:01"]
    assert [b["text"]["text"].split("\n")[0] for b in blocks[5:10]] == ["*X*", "*Y*", "*Z*", "*W*", "*V*"]
    assert [b["text"]["text"].split("\n")[1] for b in blocks[5:10]] == [
        "시도: `3건` | 성공: `3건` | 🟢 성공률: `100.0%`", "시도: `0건` | 성공: `0건` | 🔴 성공률: `0.0%`", "시도: `20건` | 성공: `20건` | 🟢 성공률: `100.0%`",
        "시도: `1,500건` | 성공: `1,200건` | 🟡 성공률: `80.0%`", "시도: `0건` | 성공: `0건` | 🔴 성공률: `0.0%`",
    ]
    assert blocks[5]["text"].keys() == {"type", "text"} and blocks[-1]["elements"][0]["type"] == "mrkdwn"


def test_message_without_results_or_footer(spark):
    blocks = message(spark, [], ["x"], footer=None)
    assert blocks[-1] == {"type": "divider"} and "`0건`" in blocks[-2]["text"]["text"]



def test_jobs_by_command(spark, saved, folder, monkeypatch):
    monkeypatch.setattr(entry, "_named", lambda name: lambda: lambda texts: [1] * len(texts))
    main, day = entry.main, "2025-02-10T02:00:00"
    saved.write.parquet(f"{folder}/pages")
    main(["extract", "--pages", f"{folder}/pages", "--out", f"{folder}/raw", "--results", f"{folder}/results", "--layout", "s=stacked", "--layout", "g=gallery", "--time", day])
    main(["report", "--results", f"{folder}/results", "--out", f"{folder}/report", "--communities", "s", "g", "--time", day, "--started", day, "--ended", "2025-02-10T02:00:09"])
    (line,) = spark.read.text(f"{folder}/report").collect()
    assert "00:00:09" in line.value and "*G*" in line.value
    main(["combine", "--raw", f"{folder}/raw", "--ledger", f"{folder}/ledger", "--out", f"{folder}/flat", "--batch", "b", "--time", day, "--lines"])
    assert spark.read.parquet(f"{folder}/flat/post_static").count() == 2 and spark.read.parquet(f"{folder}/ledger").count() == 3
    spark.sql("SELECT 's' AS id, 'p' AS source_id, true AS from_post, 'good' AS sentence, TIMESTAMP_NTZ '2025-02-10' AS created_at").write.parquet(f"{folder}/sentence")
    main(["sentiment", "--source", f"{folder}/sentence", "--target", f"{folder}/scored", "--scorer", "models:score"])
    assert spark.read.parquet(f"{folder}/scored").first().sentiment == 1
