from collections import Counter

from pyspark.sql import functions as F

from forumlens.operators.balance import MOST_TASKS, balance_by_length, prefix_sum
from forumlens.plans import jobs


def test_prefix_sum_over_ranges(spark):
    rows = [(f"k{i:04d}", (i * 37) % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, n int").repartition(7)
    got = {r.id: r.cumulative for r in prefix_sum(df, ["id"], F.col("n"), ranges=16).collect()}
    total, want = 0, {}
    for key, n in rows:
        total += n
        want[key] = total
    assert got == want


def test_prefix_sum_plan_has_no_single_partition_over_rows(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(100)], "id string, n int")
    out = prefix_sum(df, ["id"], F.col("n"), ranges=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # only the one-row-per-range offsets meet in one task
    before_window = plan.split("Exchange SinglePartition")[1]
    assert "HashAggregate(keys=[_range" in before_window


def test_hot_key_spreads_over_ranges(spark):
    rows = [("hot", 1)] * 4000 + [(f"k{i}", 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, n int").repartition(8)
    out = prefix_sum(df, ["id"], F.col("n"), ranges=8)
    sums = sorted(r.cumulative for r in out.collect())
    assert sums == list(range(1, 6001))


def test_balance_by_length(spark):
    rows = [(f"k{i:04d}", "x" * (5000 if i == 700 else 1 + (i * 13) % 40)) for i in range(1500)] + [("k9999", None)]
    df = spark.createDataFrame(rows, "id string, content string")
    out = balance_by_length(df, "content", ["id"], limit=1000, tasks=6, ranges=5)
    assert out.rdd.getNumPartitions() == 6
    placed = out.withColumn("task", F.spark_partition_id()).collect()
    assert len(placed) == len(rows)
    total, want = 0, {}
    for key, text in rows:
        total += len(text or "")
        want[key] = total // 1000
    assert {r.id: r.partition_id for r in placed} == want
    load = Counter()
    for r in placed:
        load[r.task] += len(r.content or "")
    assert max(load.values()) <= total / 6 + 5000
    others = [v for v in load.values()]
    assert len(others) == 6


def test_balance_of_copies(spark):
    df = spark.createDataFrame([("same", "x" * 10)] * 1000, "id string, content string").repartition(4)
    out = balance_by_length(df, "content", ["id"], limit=500, tasks=4, ranges=4)
    counts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(counts) == [250] * 4
    assert out.count() == 1000


def test_tasks_do_not_grow_with_the_limits_of_a_large_table(spark):
    # 3,000 limits: a report of every task goes to the driver
    df = spark.createDataFrame([(f"k{i:05d}", "x" * 10) for i in range(6000)], "id string, content string")
    out = balance_by_length(df, "content", ["id"], limit=20, ranges=4)
    assert out.rdd.getNumPartitions() == MOST_TASKS
    placed = out.withColumn("task", F.spark_partition_id()).collect()
    load = Counter(r.task for r in placed)
    assert len(placed) == 6000 and set(load.values()) == {6}
    assert {r.id: r.partition_id for r in placed} == {f"k{i:05d}": (i + 1) * 10 // 20 for i in range(6000)}


def test_balanced_sentences_of_many_limits(spark):
    """The sentences of a table of thousands of limits come from a bounded number of tasks, none lost."""
    rows = spark.range(1500).select(F.concat(F.lit("p"), "id").alias("id"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("title"),
                                    F.lit("One sentence here. Another sentence.").alias("content"), F.lit("2025-02-10").cast("timestamp_ntz").alias("created_at"))
    sentence = jobs.transform_static(rows, None, {"one": ["SENT"]}, balance_chars=20)["sentence"]
    assert sentence.rdd.getNumPartitions() == MOST_TASKS
    assert sentence.count() == sentence.select("id").distinct().count() == 3000
