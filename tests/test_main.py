"""The submittable jobs, with their arguments."""

import json

from forumlens import __main__ as entry
from forumlens.runtime import _written


def test_names_are_resolved():
    assert entry._named("json:loads") is json.loads


def test_transform_and_delta_jobs(spark, folder, monkeypatch):
    main = entry.main
    monkeypatch.setattr(entry, "_named", lambda name: lambda: lambda text: text.split("|"))  # executors cannot import tests
    spark.sql("SELECT 'c' AS id, 'The led lamp|mail a@b.co now' AS content, TIMESTAMP_NTZ '2025-02-10' AS created_at").write.parquet(f"{folder}/comments")
    with open(f"{folder}/lexicon.json", "w") as out:
        json.dump({"d": ["LED", "LED"]}, out)
    main(["transform", "--comments", f"{folder}/comments", "--out", f"{folder}/out", "--lexicon", f"{folder}/lexicon.json",
          "--splitter", "models:split", "--distinct", "--balance-chars", "5"])
    assert sorted(r.sentence for r in spark.read.parquet(f"{folder}/out/sentence").collect()) == ["The led lamp", "mail <EMAIL> now"]
    assert spark.read.parquet(f"{folder}/out/keyword_category").count() == 1
    for name, views in (("old", 3), ("new", 8)):
        spark.sql(f"SELECT 'a' AS id, TIMESTAMP_NTZ '2025-02-10' AS extracted_at, {views} AS view_count").write.parquet(f"{folder}/{name}")
    main(["delta", "--before", f"{folder}/old", "--after", f"{folder}/new", "--out", f"{folder}/moves"])
    assert [r.v_view_count for r in spark.read.parquet(f"{folder}/moves").collect()] == [5]
    assert not _written.get(spark.sparkContext.applicationId)
