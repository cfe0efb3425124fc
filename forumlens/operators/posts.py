"""Raw nested posts to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions.dates import parse_iso
from forumlens.functions.fields import entity_id, to_flag


def _post_id() -> Column:
    return entity_id(F.col("community"), "post", F.col("post_id"))


#: Where a row came from: the file, then the place in it.
PLACE = ["_path", "_position"]


def _path(raw: DataFrame) -> Column:
    return F.col("path") if "path" in raw.columns else F.lit(None).cast("string")


def post_static(raw: DataFrame, placed: bool = False) -> DataFrame:
    """One row per raw post; with ``placed`` also where it came from."""
    return raw.select(
        *([_path(raw).alias("_path"), F.lit(0).cast("long").alias("_position")] if placed else []),
        _post_id().alias("id"),
        F.col("post_url").alias("url"),
        "title",
        "content",
        parse_iso(F.col("created_at")).alias("created_at"),
    )


def post_dynamic(raw: DataFrame, batch_time: Column) -> DataFrame:
    return raw.select(
        _post_id().alias("id"),
        batch_time.alias("extracted_at"),
        "view_count",
        "upvote_count",
        "downvote_count",
        "comment_count",
    )


def post_car(raw: DataFrame) -> DataFrame:
    return raw.select(_post_id().alias("post_id"), "car_id")


def _comments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "community", _post_id().alias("post_id"), _path(raw).alias("_path"),
        F.posexplode("comments").alias("_position", "comment"),
    )


def _comment_id() -> Column:
    return entity_id(F.col("community"), "comment", F.col("comment.comment_id"))


def comment_static(raw: DataFrame, placed: bool = False) -> DataFrame:
    """One row per raw comment; with ``placed`` also where it came from."""
    return _comments(raw).select(
        *(["_path", F.col("_position").cast("long").alias("_position")] if placed else []),
        _comment_id().alias("id"),
        "post_id",
        "comment.content",
        to_flag(F.col("comment.is_reply")).alias("is_reply"),
        parse_iso(F.col("comment.created_at")).alias("created_at"),
    )


def comment_dynamic(raw: DataFrame, batch_time: Column) -> DataFrame:
    return _comments(raw).select(
        _comment_id().alias("id"),
        batch_time.alias("extracted_at"),
        "comment.upvote_count",
        "comment.downvote_count",
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``min`` of a struct keeps one candidate per key on the map side, so a key that fills a third
    of the input reaches its reducer as one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest))
    return df.groupBy(*keys).agg(packed.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def unseen(df: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id the ledger does not hold."""
    return df.join(seen.select(key), key, "left_anti")


def first_unseen(
    df: DataFrame, seen: DataFrame, key: str = "id", order: list[str] | None = None, keep_repeats: bool = False
) -> DataFrame:
    """Static rows to add: unseen ids, one row each unless ``keep_repeats``, the first in ``order``.

    Known ids go first, since most are known. The repeats of the others then collapse in the same
    hash partitioning by id, so the text crosses the network once.
    """
    new = unseen(df, seen, key)
    return new if keep_repeats else first_per_key(new, [key], order or [c for c in df.columns if c != key])


def split_required(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the not-null contract, rows that break it)."""
    ok = F.lit(True)
    for field in schema.fields:
        if not field.nullable:
            ok = ok & F.col(field.name).isNotNull()
    return df.where(ok), df.where(~ok)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema`` by name; a missing column fails at plan time."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
