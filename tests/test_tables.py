from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from forumlens import runtime, schemas
from forumlens.operators import posts as P
from forumlens.plans import jobs
from forumlens.sources import config, ledger, raw, tables

T0, T1 = datetime(2025, 2, 10), datetime(2025, 2, 11)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_read_optional_only_forgives_missing_paths(spark, folder):
    assert tables.read_optional(spark, f"{folder}/none") is None
    spark.range(3).write.parquet(f"{folder}/some")
    assert tables.read_optional(spark, f"{folder}/some").count() == 3
    with pytest.raises(AnalysisException):
        tables.read_optional(spark, f"{folder}/some").select("missing")


def test_required_columns(spark, folder):
    good = [("a", "u", "t", "c", T0)]
    columns = "id string, url string, title string, content string, created_at timestamp_ntz"
    tables.write_table(spark.createDataFrame(good, columns), f"{folder}/p", schemas.POST_STATIC)
    bad = spark.createDataFrame([("a", "u", None, "c", T0)], columns)
    kept, broken = P.split_required(bad, schemas.POST_STATIC)
    assert kept.count() == 0 and broken.count() == 1
    with pytest.raises(Exception, match="null in required column title"):
        tables.write_table(bad, f"{folder}/q", schemas.POST_STATIC)
    with pytest.raises(ValueError, match="missing columns: title"):
        tables.write_table(bad.drop("title"), f"{folder}/r", schemas.POST_STATIC)


def test_upsert_replaces_and_dedupes(spark, folder):
    columns = "id string, extracted_at timestamp_ntz, upvote_count int, downvote_count int"
    tables.load(spark.createDataFrame([("a", T0, 1, 1), ("b", T0, 2, 2)], columns), folder, "comment_dynamic")
    again = spark.createDataFrame([("b", T0, 5, 5), ("b", T0, 4, 9), ("c", T0, None, None)], columns)
    tables.load(again, folder, "comment_dynamic")
    assert rows(spark.read.parquet(f"{folder}/comment_dynamic")) == [("a", T0, 1, 1), ("b", T0, 5, 5), ("c", T0, None, None)]


def test_upsert_of_a_table_that_is_all_key(spark, folder):
    pairs = spark.createDataFrame([("p", "x"), ("p", "y"), ("p", "x")], "post_id string, car_id string")
    tables.load(pairs, folder, "post_car")
    tables.load(pairs, folder, "post_car")
    assert rows(spark.read.parquet(f"{folder}/post_car")) == [("p", "x"), ("p", "y")]


def test_partitioned_upsert_leaves_other_days_untouched(spark, folder):
    columns = "id string, extracted_at timestamp_ntz, upvote_count int, downvote_count int"
    path, keys = f"{folder}/t", ["id", "extracted_at"]

    def load(data):
        df = spark.createDataFrame(data, columns).withColumn("day", F.to_date("extracted_at"))
        tables.upsert_load(df, path, schemas.COMMENT_DYNAMIC, keys, "day")

    load([("a", T0, 1, 1), ("a", T1, 2, 2)])
    files = {r[0] for r in spark.read.parquet(path).where("day = '2025-02-10'").select("_metadata.file_path").collect()}
    load([("a", T1, 3, 3), ("b", T1, 4, 4)])
    table = spark.read.parquet(path)
    assert rows(table.select("id", "extracted_at", "upvote_count")) == [("a", T0, 1), ("a", T1, 3), ("b", T1, 4)]
    assert files == {r[0] for r in table.where("day = '2025-02-10'").select("_metadata.file_path").collect()}


def test_rebuild_swaps(spark, folder):
    spark.range(5).write.parquet(f"{folder}/t")
    tables.rebuild(spark, f"{folder}/t", lambda df: df.where("id < 2"))
    assert spark.read.parquet(f"{folder}/t").count() == 2
    assert not tables.exists(spark, f"{folder}/t.staged") and not tables.exists(spark, f"{folder}/.t.replaced")


def test_swap_recovers_a_table_left_aside(spark, folder):
    spark.range(5).write.parquet(f"{folder}/.t.replaced")
    spark.range(3).write.parquet(f"{folder}/t.staged")
    tables.swap(spark, f"{folder}/t.staged", f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3 and not tables.exists(spark, f"{folder}/.t.replaced")


def test_chunks_exclude_other_tables(spark, folder):
    for name, n in (("post_0", 2), ("post_1", 3), ("post_car", 7)):
        spark.range(n).write.parquet(f"{folder}/{name}")
    assert tables.read_chunks(spark, folder, "post").count() == 5
    assert tables.read_chunks(spark, folder, "comment") is None


def test_rewrite_prefix_isolates_damaged_files(spark, folder):
    spark.range(4).coalesce(1).write.parquet(f"{folder}/in/a")
    with open(f"{folder}/in/a/broken.parquet", "w") as out:
        out.write("not parquet")
    tables.rewrite_prefix(spark, f"{folder}/in", f"{folder}/out", lambda df: df.withColumn("x", F.lit(1)), spark.range(1).schema)
    assert spark.read.parquet(f"{folder}/out").count() == 4


RAW = """{"post_id": %s, "post_url": "u", "title": "t", "content": "c", "created_at": "2025-02-10T01:00:00%s",
"view_count": 3, "comments": [{"comment_id": 1, "content": "x", "is_reply": %s, "created_at": "2025-02-10T02:00:00"},
{"comment_id": 1, "content": "x", "is_reply": %s, "created_at": "2025-02-10T02:00:00"}]}"""


@pytest.fixture
def raw_folder(tmp_path):
    base = tmp_path / "extracted" / "car" / "2025-02-10" / "30" / "raw"
    files = {
        "alpha/1.json": RAW % ('"1"', "", "0", "1"), "alpha/2.json": RAW % ("2", "Z", "true", "false"),
        "beta/1.json": '{"post_id": 1, "post_url": "u", "title": "t", "content": "c", "created_at": "2025-02-10T01:00:00"}',
        "beta/2.json": "null", "beta/3.json": '{"post_id": 3,', "beta/notes.txt": "skip me",
    }
    for name, body in files.items():
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(body)
    (tmp_path / "extracted" / "stray.json").write_text('{"post_id": 9}')
    return str(tmp_path / "extracted")


def test_raw_posts_and_rejects(spark, raw_folder):
    posts, rejects = raw.read_raw_posts(spark, raw_folder)
    got = {(r.community, r.post_id): r for r in posts.collect()}
    assert set(got) == {("alpha", "1"), ("alpha", "2"), ("beta", "1")}
    assert got[("beta", "1")].comments is None and got[("alpha", "1")].upvote_count is None
    assert sorted(r.path.split("/")[-1] for r in rejects.collect()) == ["2.json", "3.json", "stray.json"]


def test_combine_writes_tables_and_ledger(spark, raw_folder, folder):
    posts, _ = raw.read_raw_posts(spark, raw_folder)
    assert {r.car_id for r in posts.collect()} == {"car"}
    both = posts.withColumn("car_id", F.explode(F.array(F.lit("x"), F.lit("y"))))
    raw.write_raw_posts(both.drop("path").withColumns({"date": F.lit("2025-02-10"), "batch": F.lit(30)}), f"{folder}/raw.out")
    for number in (1, 1, 2):
        out = f"{folder}/combined-{number}"
        read = f"{folder}/raw.out"
        counts = jobs.run_combine(spark, read, f"{folder}/ledger", out, str(number), F.lit("2025-02-10 00:30:00").cast("timestamp_ntz"), one_per_file=False)
        assert counts == {name: spark.read.parquet(f"{out}/{name}").count() for name in counts} and len(counts) == 11
    first, second = f"{folder}/combined-1", f"{folder}/combined-2"
    assert rows(spark.read.parquet(f"{first}/post_static").select("id")) == [("alpha_post_1",), ("alpha_post_2",), ("beta_post_1",)]
    assert rows(spark.read.parquet(f"{first}/comment_static").select("id")) == [("alpha_comment_1",)]
    assert spark.read.parquet(f"{first}/post_dynamic").count() == 6
    assert spark.read.parquet(f"{first}/post_car").count() == 6
    assert spark.read.parquet(f"{second}/post_static").count() == 0
    assert spark.read.parquet(f"{second}/post_dynamic").count() == 6
    assert ledger.read_ledger(spark, f"{folder}/ledger").count() == 4


def test_keep_repeats(spark):
    columns = "id string, title string"
    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "1")], columns)
    seen = spark.createDataFrame([("b",)], "id string")
    assert rows(P.first_unseen(df, seen)) == [("a", "1")]
    assert rows(P.first_unseen(df, seen, keep_repeats=True)) == [("a", "1"), ("a", "2")]


def test_ledger_text_and_absent(spark, folder):
    with open(f"{folder}/ids.txt", "w") as out:
        out.write("a\n\n  b \na\n   \n")
    assert rows(ledger.import_text_ledger(spark, f"{folder}/ids.txt")) == [("a",), ("b",)]
    assert ledger.read_ledger(spark, f"{folder}/none").count() == 0


def test_configuration(spark, folder):
    with open(f"{folder}/cars.json", "w") as out:
        out.write('[{"car_id": "x", "keywords": ["k1", "k2"]}, {"car_id": "y", "keywords": []}]')
    with open(f"{folder}/communities.json", "w") as out:
        out.write('["alpha", "beta"]')
    assert rows(config.car_keywords(config.read_cars(spark, f"{folder}/cars.json"))) == [("x", "k1"), ("x", "k2")]
    assert config.read_communities(spark, f"{folder}/communities.json") == ["alpha", "beta"]


def test_observed_row_counts(spark, folder):
    df = spark.range(7)
    counts = tables.write_counted(df, f"{folder}/counted", "posts")
    assert counts == 7 and spark.read.parquet(f"{folder}/counted").count() == 7


def test_static_job_with_one_side_missing(spark, folder):
    columns = "id string, content string, created_at timestamp_ntz"
    spark.createDataFrame([("c", "The led lamp. mail a@b.co", T0)], columns).write.parquet(f"{folder}/comments")
    assert not jobs.run_transform_static(spark, [f"{folder}/no"], [f"{folder}/none"], f"{folder}/x", {"d": ["LED"]})
    for name, limit in (("plain", None), ("balanced", 10)):
        out = f"{folder}/{name}"
        assert jobs.run_transform_static(spark, [f"{folder}/no"], [f"{folder}/comments"], out, {"d": ["LED"]}, limit)
        assert rows(spark.read.parquet(f"{out}/sentence").select("id", "sentence")) == [("c_0", "The led lamp."), ("c_1", "mail <EMAIL>")]
        assert rows(spark.read.parquet(f"{out}/keyword_category")) == [("c_0", "d", "LED")]
        assert tables.read_optional(spark, f"{out}/post_static") is None


def test_materialized_tables_can_be_dropped(spark):
    kept = runtime.materialize(spark.range(3), "t")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert kept.count() == 3 and tables.exists(spark, path)
    runtime.drop_materialized(spark)
    assert not tables.exists(spark, path)


def test_rows_that_break_the_contract_are_set_aside(spark):
    comment = "array<struct<comment_id:bigint,content:string,is_reply:string,created_at:string,upvote_count:int,downvote_count:int>>"
    columns = f"community string, car_id string, post_id string, post_url string, title string, content string, created_at string, view_count int, upvote_count int, downvote_count int, comment_count int, comments {comment}"
    good, bad = (1, "x", "0", "2025-02-10T00:00:00", None, None), (2, None, "0", "2025-02-10T00:00:00", None, None)
    rows = [
        ("a", "x", "1", "u", "t", "c", "2025-02-10T00:00:00", 1, 1, 1, 1, [good, bad]),
        ("a", "x", "2", "u", "t", "c", "someday", 1, 1, 1, 1, []),
    ]
    seen = spark.createDataFrame([], "id string")
    made = jobs.combine_batch(spark.createDataFrame(rows, columns), seen, F.lit("2025-02-10").cast("timestamp_ntz"))
    assert {name: [r[0] for r in df.collect()] for name, df in made.items() if name not in ("post_car",)} == {
        "post_static": ["a_post_1"], "comment_static": ["a_comment_1"], "new_ids": ["a_post_1", "a_comment_1"],
        "post_rejects": ["a_post_2"], "comment_rejects": ["a_comment_2"],
        "post_dynamic": ["a_post_1", "a_post_2"], "comment_dynamic": ["a_comment_1", "a_comment_2"],
        "post_dynamic_rejects": [], "comment_dynamic_rejects": [], "post_car_rejects": [],
    }
