"""The ledger of ids by bucket: pruning, compaction, reruns."""

import pytest
from pyspark.sql import functions as F

from forumlens.plans import jobs
from forumlens.sources import ledger


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def ids(df):
    return sorted((r.id for r in df.collect()), key=str)


def add(spark, path, **batches):
    for name, held in batches.items():
        ledger.append_ledger(frame(spark, *held), path, name)


def test_a_batch_reads_its_buckets_only(spark, folder):
    path, many = f"{folder}/ledger", [f"id{i}" for i in range(300)]
    add(spark, path, a=many)
    wanted = frame(spark, "id7", "new")
    read = ledger.read_ledger(spark, path, only=wanted)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    numbers = {r[0] for r in wanted.select(ledger.bucket_of(F.col("id"))).collect()}
    inside = [r.id for r in frame(spark, *many).withColumn("b", ledger.bucket_of(F.col("id"))).where(F.col("b").isin(*numbers)).collect()]
    assert ids(read) == sorted(inside) and "id7" in inside and len(inside) < 150
    assert ids(ledger.read_ledger(spark, path, only=wanted.limit(0))) == []


def test_reads_are_equal_before_and_after_compaction(spark, folder):
    path = f"{folder}/ledger"
    add(spark, path, a=["1", "2", "x"], b=["3", None], c=["4"])
    reads = lambda: [ids(ledger.read_ledger(spark, path, w)) for w in ((), ("a",), ("a", "c"), ("none",))]
    before = reads()
    ledger.compact(spark, path, ["a", "b"])
    assert reads() == before
    ledger.compact(spark, path, ["a", "b"])  # again, and another
    ledger.compact(spark, path, ["c"])
    assert reads() == before
    parts = {p.rsplit("part=", 1)[1].split("/")[0] for p in spark.read.parquet(path).inputFiles()}
    assert parts == {ledger.FOLDED}


def test_a_folded_batch_runs_again(spark, folder):
    path = f"{folder}/ledger"
    add(spark, path, a=["1", "2"], b=["3"])
    ledger.compact(spark, path, ["a", "b"])
    add(spark, path, a=["2", "5"])
    assert ids(ledger.read_ledger(spark, path)) == ["2", "3", "5"]
    ledger.compact(spark, path, ["a"])
    assert ids(ledger.read_ledger(spark, path)) == ["2", "3", "5"]
    assert ids(ledger.read_ledger(spark, path, ("a",))) == ["3"]


def test_a_rerun_with_fewer_ids_leaves_none_behind(spark, folder):
    path = f"{folder}/ledger"
    add(spark, path, a=[f"id{i}" for i in range(100)])
    add(spark, path, a=["id1"])
    assert ids(ledger.read_ledger(spark, path)) == ["id1"]
    add(spark, path, a=[])
    assert ids(ledger.read_ledger(spark, path)) == []


def test_compaction_of_nothing(spark, folder):
    ledger.compact(spark, f"{folder}/none", ["a"])
    assert ledger.read_ledger(spark, f"{folder}/none").count() == 0


def test_one_persisted_frame_feeds_both_outputs(spark, folder):
    spark.sql("SELECT 'p' AS id, 'LED lamps glow bright.' AS title, 'Some LED text here.' AS content, TIMESTAMP_NTZ '2025-02-10' AS created_at").write.parquet(f"{folder}/posts")
    posts = spark.read.parquet(f"{folder}/posts")
    with jobs.persisted(posts.select("id")) as (kept,):
        assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
        assert "InMemoryTableScan" in kept.where("id <> ''")._jdf.queryExecution().executedPlan().toString()
    assert not kept.storageLevel.useDisk
    jobs.run_tags(posts, None, f"{folder}/out", {"d": ["LED"]})
    assert spark.read.parquet(f"{folder}/out/sentence").count() == 2 and spark.read.parquet(f"{folder}/out/keyword_category").count() == 2


def test_persisted_frames_are_released_on_failure(spark):
    with pytest.raises(RuntimeError), jobs.persisted(spark.range(3)) as (kept,):
        raise RuntimeError
    assert not kept.storageLevel.useDisk
