"""Small helpers the operators share: words, tables, global ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumlens.runtime import materialize

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_MAP_BITS = 32768  # of the bitmap functions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def locator(file: str, row: str) -> tuple[Column, Column]:
    """Where a row of a frame that is read from Parquet files lies; the same in every scan, unlike a row number."""
    return F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)


def probably_in(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` occur in ``chosen``, and one in seventeen of the others at most, found without moving ``rows``.

    Each key is one of 16 bits for every row of ``chosen``, which is counted first. The bits go to all tasks in maps of
    4 KB, two bytes for every row of ``chosen``. What is left can then be joined at the cost of its own size.
    """
    maps = max(1, -(-chosen.count() * 16 // _MAP_BITS))

    def bit(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_bit", F.pmod(F.xxhash64(*keys), F.lit(maps * _MAP_BITS)) + 1)  # maps count from 1

    map_of, place = F.bitmap_bucket_number("_bit"), F.bitmap_bit_position("_bit")
    held = bit(chosen.select(*keys)).groupBy(map_of.alias("_map")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    byte = F.col("_bits").substr((F.floor(place / 8) + 1).cast("int"), F.lit(1))
    is_set = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_bit) % 8 as int))")) != 0
    found = bit(rows).withColumn("_map", map_of).join(F.broadcast(held), "_map").where(is_set)
    return found.select(*rows.columns)


def ranked(rows: DataFrame, keys: list, name: str, index: str) -> DataFrame:
    """``rows`` with a dense zero-based position in the order of ``keys``, without a single-task sort.

    Rows are range-partitioned and sorted; the row number inside each range is written once, because
    range bounds are sampled, and the ranges before it are added from a table of one row per range.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        rows.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    placed = materialize(placed, name)
    part = F.shiftright("_mid", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.col("_mid").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per task of the line above
        .withColumn(index, F.col("_before") + local)
        .drop("_mid", "_part", "_before")
    )
