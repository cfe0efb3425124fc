"""Files that can't be read stop no others and give none of their rows."""

import os

import pytest
from pyspark.sql import functions as F

from forumlens.sources import isolated, tables

SCHEMA = "id long, name string, at timestamp_ntz, tags array<string>, more int"


@pytest.fixture
def written(spark, folder):
    rows = spark.range(3000).select(
        "id", F.concat(F.lit("n"), F.sha2(F.col("id").cast("string"), 256)).alias("name"), F.lit("2025-02-10 01:02:03.000004").cast("timestamp_ntz").alias("at"),
        F.array(F.lit("a"), F.lit(None).cast("string")).alias("tags"),
    )
    for part in range(3):
        rows.where(f"id % 3 = {part}").coalesce(1).write.parquet(f"{folder}/in/p{part}")
    return sorted(f"{root}/{name}" for root, _, names in os.walk(f"{folder}/in") for name in names if name.endswith(".parquet"))


def change(path, edit):
    with open(path, "rb") as file:
        content = file.read()
    with open(path, "wb") as file:
        file.write(edit(content))


def frame(spark, folder):
    return isolated.read_isolated(spark, f"{folder}/in", spark.createDataFrame([], SCHEMA).schema)


def test_whole_files_are_read_as_by_spark(spark, folder, written):
    got = frame(spark, folder)
    assert got.where("_error is not null").count() == 0 and got.select("_file").distinct().count() == 3
    want = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/in").withColumn("more", F.lit(None).cast("int"))
    assert got.drop("_file", "_error").exceptAll(want).count() == 0 and got.count() == want.count() == 3000
    assert got.rdd.getNumPartitions() == 3


@pytest.mark.parametrize("edit", [
    lambda c: c[: len(c) // 2], lambda c: b"", lambda c: b"not parquet", lambda c: c[:-8] + b"\xff\xff\xff\x7f" + c[-4:],
    lambda c: c[:300] + bytes(b ^ 255 for b in c[300:340]) + c[340:],
])
@pytest.mark.parametrize("held", [isolated.HELD, 0])
def test_a_damaged_file_gives_one_error_and_no_rows(spark, folder, written, edit, held, monkeypatch):
    change(written[1], edit)
    reader = isolated.IsolatedReader(f"{folder}/in", spark.createDataFrame([], SCHEMA).schema)
    monkeypatch.setattr(isolated, "HELD", held)
    batches = {p.path: list(reader.read(p)) for p in reader.partitions()}
    rows = {path: sum(b.num_rows for b in found) for path, found in batches.items()}
    assert [rows[path] for path in written] == [1000, 1, 1000]
    assert batches[written[1]][0].column("_error")[0].as_py()


def test_every_unreadable_file_is_listed_and_each_other_has_an_output(spark, folder, written):
    change(written[0], lambda c: c[:300] + bytes(b ^ 255 for b in c[300:340]) + c[340:])
    spark.range(0).withColumn("name", F.lit("x")).coalesce(1).write.parquet(f"{folder}/in/none")
    os.makedirs(f"{folder}/in/cut")
    with open(f"{folder}/in/cut/a file=1.parquet", "wb") as out:
        out.write(b"PAR1")
    schema = spark.createDataFrame([], SCHEMA).schema
    skipped = tables.rewrite_prefix(spark, f"{folder}/in", f"{folder}/out", lambda df: df.withColumn("x", F.col("id") + 1), schema)
    listed = {r.path: r.reason for r in spark.read.parquet(f"{folder}/out.skipped").collect()}
    assert skipped == len(listed) == 3 and written[0] in listed and f"{folder}/in/cut/a file=1.parquet" in listed
    assert [r for p, r in listed.items() if "/none/" in p] == [isolated.NO_ROWS]
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == 2000 and out.where("x != id + 1 or id % 3 = 0").count() == 0
    assert out.select(F.input_file_name()).distinct().count() == 2


def test_files_of_other_types_are_listed_and_columns_told_without_a_schema(spark, folder, written):
    spark.createDataFrame([("text",)], "id string").coalesce(1).write.parquet(f"{folder}/in/text")
    assert tables.rewrite_prefix(spark, f"{folder}/in", f"{folder}/out", lambda df: df, spark.range(1).schema) == 1
    assert spark.read.parquet(f"{folder}/out").count() == 3000
    change(written[2], lambda c: c[:40])
    assert tables.rewrite_prefix(spark, f"{folder}/in/p1", f"{folder}/out", lambda df: df) == 0
    assert spark.read.parquet(f"{folder}/out").columns == ["id", "name", "at", "tags"]
