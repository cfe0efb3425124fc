"""Raw nested post JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.schemas import RAW_POST

# Where community and car stand in a path of one file per post.
COMMUNITY_IN_PATH = r"raw/([^/]+)/[^/]+\.json$"
CAR_IN_PATH = r"([^/]+)/[^/]+/[^/]+/raw/[^/]+/[^/]+\.json$"
LAYOUT = ["car_id", "date", "batch", "community"]


def community_from_path(path: Column) -> Column:
    """The community folder of a raw file path; null when the path has another form (A3)."""
    return F.nullif(F.regexp_extract(path, COMMUNITY_IN_PATH, 1), F.lit(""))


def car_from_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, CAR_IN_PATH, 1), F.lit(""))


def scan_raw_posts(
    spark: SparkSession,
    path: str | list[str],
    one_per_file: bool = True,
    glob: str = "*.json",
    base: str | None = None,
) -> DataFrame:
    """Every document of the files matching ``glob`` below ``path``, good or not (A1, A2).

    A post carries its car and community, from the path or from partition folders; with ``base``
    the partitions above a globbed path count as well. A document is one VARIANT, an array of posts several.
    Fields are taken out as text and cast one by one, so a counter or comment id of another type is null and the
    rest of its post stays, whichever columns a query reads. The same holds for a comment: one that is no object
    is set aside and its neighbours stay. What is no post is kept as text with the reason.
    """
    reader = spark.read.format("text").option("wholetext", one_per_file).option("pathGlobFilter", glob)
    if base:
        reader = reader.option("basePath", base)
    read = reader.load(path)
    file = F.col("_metadata.file_path")
    if "community" not in read.columns:
        flat = reader.option("recursiveFileLookup", True).load(path)
        read = flat.withColumns({"community": community_from_path(file), "car_id": car_from_path(file)})
    lines = read.withColumn("path", file)
    return _typed(lines if one_per_file else lines.where(F.trim("value") != ""))


def _is(value: Column, kind: str) -> Column:
    """Whether a variant is of that kind, ``OBJECT`` or ``ARRAY``."""
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _fields(value: Column, schema: T.StructType) -> list[Column]:
    """The fields of an object in their types; a value of another type is null."""
    return [F.try_variant_get(value, f"$.{f.name}", "string").try_cast(f.dataType).alias(f.name) for f in schema]


def _typed(read: DataFrame) -> DataFrame:
    """Documents in the types of a raw post, with ``_reason`` and ``_corrupt`` of what is none, and the ``_odd`` comments as text."""
    parsed = F.try_parse_json("value")
    several = F.when(_is(parsed, "ARRAY"), F.try_variant_get(parsed, "$", "array<variant>")).otherwise(F.array(parsed))
    each = read.withColumn("_doc", F.explode_outer(several))
    doc, all_comments = F.col("_doc"), F.col("_all")
    found = F.try_variant_get(doc, "$.comments", "variant")
    each = each.withColumn("_all", F.when(_is(found, "ARRAY"), F.try_variant_get(found, "$", "array<variant>")))
    comment = RAW_POST["comments"].dataType.elementType
    typed = F.transform(F.filter(all_comments, lambda c: _is(c, "OBJECT")), lambda c: F.struct(*_fields(c, comment)))
    no_list = found.isNotNull() & ~F.is_variant_null(found) & all_comments.isNull()
    odd = F.when(no_list, F.array(_text(found))).otherwise(F.transform(F.filter(all_comments, lambda c: ~_is(c, "OBJECT")), _text))
    post_id = F.try_variant_get(doc, "$.post_id", "string")
    reason = (
        F.when(doc.isNull(), F.when(F.trim("value") == "", "empty").when(_is(parsed, "ARRAY"), "empty").otherwise("malformed"))
        .when(~_is(doc, "OBJECT"), "no object")
        .when(post_id.isNull(), "no post_id")
        .when(F.col("community").isNull(), "unknown folder")
    )
    posts = T.StructType([f for f in RAW_POST if f.name != "comments"])
    corrupt = F.when(reason.isNotNull(), F.coalesce(_text(doc), F.col("value")))
    rest = [c for c in read.columns if c != "value"]
    return each.select(*_fields(doc, posts), typed.alias("comments"), *rest, reason.alias("_reason"), corrupt.alias("_corrupt"), odd.alias("_odd"))


def _text(value: Column) -> Column:
    return F.to_json(value)


def split_rejects(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts, rejects): each reject has its ``path``, ``reason``, the ``document`` or comment as text, and ``post_id`` of a comment's post.

    JSON ``null``, malformed text, objects without an id and files off any known path are rejects; of a good post,
    comments that are no objects are, each by itself (``comment``), and a value in their place that is no list (``comments``).
    """
    good = F.col("_reason").isNull()
    whole = scanned.where(~good).select("path", F.col("_reason").alias("reason"), F.col("_corrupt").alias("document"), F.lit(None).cast("string").alias("post_id"))
    kind = F.when(F.col("comments").isNull(), "comments").otherwise("comment")
    odd = scanned.where(good).select("path", kind.alias("reason"), F.explode("_odd").alias("document"), "post_id")
    return scanned.where(good).drop("_reason", "_corrupt", "_odd"), whole.unionByName(odd)


def read_raw_posts(spark: SparkSession, path: str | list[str], **options) -> tuple[DataFrame, DataFrame]:
    """(posts, rejects) of ``scan_raw_posts``, lazily: each side parses the files for itself."""
    return split_rejects(scan_raw_posts(spark, path, **options))


def write_raw_posts(raw: DataFrame, path: str, mode: str = "append", dynamic: bool = False) -> None:
    """Posts as JSON lines under ``car_id=/date=/batch=/community=``.

    Rows are rebalanced by folder to keep files few; adaptive execution splits a folder that gets
    most of the posts over several tasks. ``dynamic`` overwrites only the folders that get posts.
    """
    writer = raw.hint("rebalance", *LAYOUT).write.partitionBy(*LAYOUT).mode(mode).option("ignoreNullFields", True)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.json(path)
