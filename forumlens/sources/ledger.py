"""The ledger of ids seen in earlier batches (A4, A5).

Ids lie in buckets by their hash, and in each bucket apart by the batch that brought them. A reader that knows its
ids opens their buckets only; ``compact`` folds the many small batches of a bucket into one part. The batch of an id
stays beside it, so that a batch can be run again before and after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.sources.tables import exists, folders, remove, swap

BUCKETS = 16
#: The part of a bucket that compaction writes.
FOLDED = "folded"
_SCHEMA = T.StructType([T.StructField("id", T.StringType())])
_LAYOUT = "id string, batch string, bucket int, part string"


def import_text_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file: trimmed, blank lines dropped, each once."""
    lines = spark.read.text(path).select(F.btrim("value").alias("id"))
    return lines.where("id <> ''").distinct()


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_ledger(spark: SparkSession, path: str, without: tuple[str, ...] = (), only: DataFrame | None = None) -> DataFrame:
    """Every id seen so far; an absent ledger is empty.

    ``without`` leaves out the ids of batches that are being run again, so that a rerun finds the same rows new as the
    first run did. With ``only`` (a frame with ``id``) just the buckets that may hold one of its ids are read; their
    numbers, ``BUCKETS`` at most, come to the driver.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    ledger = spark.read.schema(_LAYOUT).option("pathGlobFilter", "*.parquet").parquet(path)
    if only is not None:
        wanted = [r["bucket"] for r in only.select(bucket_of(F.col("id")).alias("bucket")).distinct().collect()]
        ledger = ledger.where(F.col("bucket").isin(wanted))
    return ledger.where(~F.col("batch").isin(*without)).select("id") if without else ledger.select("id")


def _buckets(spark: SparkSession, path: str) -> list[str]:
    return [f for f in folders(spark, path) if f.rsplit("/", 1)[1].startswith("bucket=")]


def _folded(spark: SparkSession, path: str) -> list[str]:
    """The batches that compaction has folded; one short name for each."""
    where = f"{path}/_folded"
    return [r["batch"] for r in spark.read.schema("batch string").parquet(where).collect()] if exists(spark, where) else []


def append_ledger(new_ids: DataFrame, path: str, batch: str) -> None:
    """Add a batch's new ids as their own parts, so a rerun of the batch replaces them.

    The ledger grows by what is new; it is rewritten only when a batch runs again that was folded already.
    """
    spark = new_ids.sparkSession
    folded = _folded(spark, path)
    if batch in folded:
        _fold(spark, path, [], [b for b in folded if b != batch])
    for bucket in _buckets(spark, path):
        remove(spark, f"{bucket}/part={batch}")  # a bucket may get no id this time
    ids = new_ids.select("id").distinct().withColumns({"batch": F.lit(batch), "bucket": bucket_of(F.col("id")), "part": F.lit(batch)})
    ids.repartition("bucket").write.partitionBy("bucket", "part").mode("append").parquet(path)


def compact(spark: SparkSession, path: str, batches: list[str]) -> None:
    """Fold the parts of ``batches``, each bucket into one part; ids and their batches stay what they are."""
    if exists(spark, path):
        folded = _folded(spark, path)
        _fold(spark, path, [b for b in batches if b not in folded], sorted({*folded, *batches}))


def _fold(spark: SparkSession, path: str, parts: list[str], batches: list[str]) -> None:
    """Write the folded parts anew, of ``batches``, from those there are and from ``parts``.

    They are staged beside the ledger and moved in one by one, and the parts that went in are removed last: a failure in
    between leaves some ids twice, which no reader minds, and never loses one.
    """
    ledger = spark.read.schema(_LAYOUT).option("pathGlobFilter", "*.parquet").parquet(path)
    chosen = ledger.where(F.col("part").isin(FOLDED, *parts) & F.col("batch").isin(*batches)).dropDuplicates(["id", "batch", "bucket"])
    staged = f"{path}.folding"
    chosen.withColumn("part", F.lit(FOLDED)).repartition("bucket").sortWithinPartitions("id").write.mode("overwrite").partitionBy("bucket", "part").parquet(staged)
    written = {f.rsplit("/", 1)[1] for f in folders(spark, staged)}
    for bucket in _buckets(spark, path):
        name = bucket.rsplit("/", 1)[1]
        if name in written:
            swap(spark, f"{staged}/{name}/part={FOLDED}", f"{bucket}/part={FOLDED}")
        else:
            remove(spark, f"{bucket}/part={FOLDED}")
    spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_folded")
    for bucket in _buckets(spark, path):
        for part in parts:
            remove(spark, f"{bucket}/part={part}")
    remove(spark, staged)
