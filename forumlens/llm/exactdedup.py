"""Exact deduplication as a stream with disk-backed keyed state.

The state holds, for each digest and without expiry, the smallest document id, where that document's
content lies (file and row) and a count; texts are never kept in it. Digest hits are then checked on
their full bytes, so a digest may collide without merging different texts.

Cases: a null text counts as empty, and equals a text that is empty; texts of white space only equal one
space. A null ``doc_id`` comes after all others. Rows repeated with one ``doc_id`` form a group of which the
row that lies first (file, row) stays. Other columns, whatever their names, are not looked at. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.common import locator, single_spaced
from forumlens.runtime import materialize, new_path

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each small store holds megabytes of empty disk
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",  # of all stores of an executor
}
SALT_ROWS = 256  # rows compared with one copy of the kept text



def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def fingerprints(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id``, content locator and digest of each row; ``docs`` must be read from Parquet files."""
    return docs.select("doc_id", *locator("file", "row"), digest(single_spaced(F.col("text"))).alias("digest"))


@contextmanager
def disk_backed(spark: SparkSession) -> Iterator[None]:
    """The session with its state on disk."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keyed_state(spark: SparkSession, folder: str, least: int = 1, files_per_trigger: int = 1000) -> DataFrame:
    """Stream the fingerprints in ``folder`` through the keyed state; the groups of at least ``least`` rows it holds.

    ``digest``, ``keep`` (the row that stays: id, then locator) and ``group_size``. The checkpoint lies in
    the shared folder, so a lost executor's partitions are loaded again from there.
    """
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))
    state = stream.groupBy("digest").agg(first.alias("keep"), F.count("*").alias("group_size"))
    checkpoint = new_path(spark, "exact-state")
    with disk_backed(spark):
        state.writeStream.outputMode("update").format("noop").trigger(availableNow=True).option(
            "checkpointLocation", checkpoint
        ).start().awaitTermination()
        held = spark.read.format("statestore").load(checkpoint)
        keep, size = held.schema["value"].dataType.names[-2:]
        held = held.select("key.digest", F.col("value")[keep].alias("keep"), F.col("value")[size].alias("group_size"))
        return materialize(held.where(F.col("group_size") >= least), "exact-groups")


def classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_trigger: int = 1000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``file``, ``row``, ``digest``, ``keep_id``, ``group_size``, ``kept``."""
    spark = docs.sparkSession
    prints = materialize(fingerprints(docs, digest), "exact-prints")
    if prints.isEmpty():
        return prints.select("*", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    several = keyed_state(spark, prints.inputFiles()[0].rsplit("/", 1)[0], 2, files_per_trigger)
    # one row per digest on the right; a hot digest on the left is split by the adaptive skew join
    rows = prints.join(several, "digest", "left")
    alone = F.col("keep").isNull()
    here = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    rows = materialize(
        rows.select(
            "doc_id", "file", "row", "digest",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            (alone | here).alias("kept"),
        ),
        "exact-classes",
    )
    unequal = materialize(_unequal(docs, rows), "exact-unequal")
    return rows if unequal.isEmpty() else _regrouped(rows, unequal)


def _unequal(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Members of a digest whose bytes differ from the kept text, found with full texts.

    Members are dealt over salts of some hundred rows and the kept text is copied to each salt.
    """
    members = rows.where("group_size > 1").drop("keep_id")
    texts = docs.select(*locator("file", "row"), "text").join(members, ["file", "row"])
    salts = F.ceil(F.col("group_size") / SALT_ROWS).cast("int")
    own = F.pmod(F.xxhash64("file", "row"), salts).cast("int")
    dealt = texts.select(
        "doc_id", "file", "row", "digest", "kept", single_spaced(F.col("text")).alias("norm"),
        F.explode(F.when(F.col("kept"), F.sequence(F.lit(0), salts - 1)).otherwise(F.array(own))).alias("salt"),
    )
    kept = dealt.where("kept").select("digest", "salt", F.col("norm").alias("kept_norm"))
    return dealt.where("not kept").join(kept, ["digest", "salt"]).where("norm != kept_norm").drop("salt", "kept", "kept_norm")


def _regrouped(rows: DataFrame, unequal: DataFrame) -> DataFrame:
    """Groups when a digest stood for several texts: the odd ones are grouped by their text."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))
    own = unequal.groupBy("digest", "norm").agg(first.alias("keep"), F.count("*").alias("size"))
    odd = unequal.join(own, ["digest", "norm"]).select("file", "row", "keep", "size")
    fewer = unequal.groupBy("digest").agg(F.count("*").alias("odd"))
    return (
        rows.join(odd, ["file", "row"], "left").join(fewer, "digest", "left")
        .select(
            "doc_id", "file", "row", "digest",
            F.when(F.col("keep").isNull(), F.col("keep_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("size", F.col("group_size") - F.coalesce("odd", F.lit(0))).alias("group_size"),
            F.when(F.col("keep").isNull(), F.col("kept"))
            .otherwise((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept"),
        )
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    dropped = classes(docs).where("not kept").select(F.col("file").alias("_llm_file"), F.col("row").alias("_llm_row"))
    placed = docs.select("*", *locator("_llm_file", "_llm_row"))
    return placed.join(dropped, ["_llm_file", "_llm_row"], "left_anti").drop("_llm_file", "_llm_row")
