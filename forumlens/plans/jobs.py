"""Composed jobs (M1-M12): operators chained into the tables of one batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.functions.dates import iso_text
from forumlens.functions.lexicon import Lexicon
from forumlens.functions.messages import alert_payload, community_line
from forumlens.functions.text import split_sentences
from forumlens.operators import posts as P
from forumlens.operators import report as R
from forumlens.operators import trend as W
from forumlens.operators.balance import balance_by_length
from forumlens.operators.batches import current_and_previous
from forumlens.operators.delta import snapshot_delta
from forumlens.operators.sentences import clean_columns, explode_sentences, keyword_rows, union_sources
from forumlens.operators.sentiment import ScorerFactory, score_sentiment
from forumlens.runtime import materialize
from forumlens.sources import ledger, pages, raw, tables

log = logging.getLogger(__name__)


def combine_batch(
    posts: DataFrame, seen: DataFrame, batch_time: Column, keep_repeats: bool = False
) -> dict[str, DataFrame]:
    """Raw posts of one batch, all cars, to the five flat tables, the new ids and rejects.

    Every table is split by its contract, so one row without an id stops nothing. Of repeated ids
    the first by path and place counts.
    """
    made = {
        "post_static": P.post_static(posts, placed=True),
        "comment_static": P.comment_static(posts, placed=True),
        "post_dynamic": P.post_dynamic(posts, batch_time),
        "comment_dynamic": P.comment_dynamic(posts, batch_time),
        "post_car": P.post_car(posts).distinct(),
    }
    good, bad = {}, {}
    for name, rows in made.items():
        good[name], bad[name] = P.split_required(rows, schemas.LOAD_KEYS[name][0])
    for name in ("post_static", "comment_static"):
        good[name] = P.first_unseen(good[name], seen, order=P.PLACE, keep_repeats=keep_repeats).drop(*P.PLACE)
        bad[name] = bad[name].drop(*P.PLACE)
    return {
        **good,
        "new_ids": good["post_static"].select("id").unionByName(good["comment_static"].select("id")),
        "post_rejects": bad["post_static"],
        "comment_rejects": bad["comment_static"],
        "post_dynamic_rejects": bad["post_dynamic"],
        "comment_dynamic_rejects": bad["comment_dynamic"],
        "post_car_rejects": bad["post_car"],
    }


def run_combine(
    spark: SparkSession,
    raw_path: str,
    ledger_path: str,
    out: str,
    batch: str,
    batch_time: Column,
    one_per_file: bool = True,
    base: str | None = None,
    keep_repeats: bool = False,
) -> dict[str, int]:
    """Read, combine and write one batch; the ledger grows only after the statics are written.

    The JSON is parsed once; the five tables read the columns they need from the written posts.
    Running a batch again replaces its outputs and its part of the ledger. Returns the rows of every
    output, rejects too, counted while they are written.
    """
    scanned = materialize(raw.scan_raw_posts(spark, raw_path, one_per_file, base=base), "raw")
    posts, rejects = raw.split_rejects(scanned)
    counts = {"rejects": tables.write_counted(rejects, f"{out}/rejects", "rejects", "overwrite")}
    statics = {name: f"{batch}-{name}" for name in ("post_static", "comment_static")}
    ids = [made.select("id") for made in (P.post_static(posts), P.comment_static(posts))]
    seen = ledger.read_ledger(spark, ledger_path, tuple(statics.values()), ids[0].unionByName(ids[1]))
    made = combine_batch(posts, seen, batch_time, keep_repeats)
    for name in (*statics, "post_dynamic", "comment_dynamic", "post_car"):
        schema, _ = schemas.LOAD_KEYS[name]
        counts[name] = tables.write_table(made[name], f"{out}/{name}", schema, mode="overwrite")
    for name in (n for n in made if n.endswith("_rejects")):
        counts[name] = tables.write_counted(made[name], f"{out}/{name}", name, "overwrite")
    for name, rows in counts.items():
        log.info("%s: %d rows", name, rows)
    for name, part in statics.items():
        ledger.append_ledger(spark.read.parquet(f"{out}/{name}"), ledger_path, part)
    return counts


def transform_static(
    posts: DataFrame | None,
    comments: DataFrame | None,
    lexicon: Lexicon,
    balance_chars: int | None = None,
    splitter: Callable[[Column], Column] = split_sentences,
) -> dict[str, DataFrame]:
    """Masked statics, sentences and keyword tags, lazily (M2, M3 with ``balance_chars``)."""
    posts = None if posts is None else clean_columns(posts)
    comments = None if comments is None else clean_columns(comments)
    source = union_sources(posts, comments)
    if balance_chars:
        source = balance_by_length(source, "content", ["source_id"], balance_chars)
    sentence = explode_sentences(source, splitter)
    made = {"sentence": sentence, "keyword_category": keyword_rows(sentence, lexicon)}
    if posts is not None:
        made["post_static"] = posts
    if comments is not None:
        made["comment_static"] = comments
    return made


def run_transform_static(
    spark: SparkSession,
    post_paths: list[str],
    comment_paths: list[str],
    out: str,
    lexicon: Lexicon,
    balance_chars: int | None = None,
    splitter: Callable[[Column], Column] = split_sentences,
    strict: bool = False,
    distinct: bool = False,
) -> bool:
    """Write the four outputs; False when neither input exists.

    Every output is derived from the one written before it: text is masked once, split once and
    tagged once, with nothing held in executor memory.
    """
    cleaned = {}
    for name, paths in (("post_static", post_paths), ("comment_static", comment_paths)):
        table = tables.read_optional(spark, *paths)
        if table is not None:
            clean_columns(table, strict=strict).write.mode("overwrite").parquet(f"{out}/{name}")
            cleaned[name] = spark.read.parquet(f"{out}/{name}")
    if not cleaned:
        return False
    source = union_sources(cleaned.get("post_static"), cleaned.get("comment_static"))
    if balance_chars:
        source = balance_by_length(source, "content", ["source_id"], balance_chars)
    explode_sentences(source, splitter).write.mode("overwrite").parquet(f"{out}/sentence")
    sentence = spark.read.parquet(f"{out}/sentence")
    keyword_rows(sentence, lexicon, distinct).write.mode("overwrite").parquet(f"{out}/keyword_category")
    return True


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Frames that several outputs read, kept on the executors' disks and given back in any case.

    The alternative to a written table where the frame is cheap to make again: a lost executor costs a recomputation
    of its blocks, and nothing is left in the shared folder.
    """
    kept = tuple(f.persist(StorageLevel.DISK_ONLY) for f in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()


def run_tags(posts: DataFrame | None, comments: DataFrame | None, out: str, lexicon: Lexicon, distinct: bool = False) -> None:
    """Sentences and keyword tags of statics that are clean already, both written from one persisted frame."""
    with persisted(explode_sentences(union_sources(posts, comments))) as (sentence,):
        sentence.write.mode("overwrite").parquet(f"{out}/sentence")
        keyword_rows(sentence, lexicon, distinct).write.mode("overwrite").parquet(f"{out}/keyword_category")


def run_delta(spark: SparkSession, before: str | None, after: str, out: str, keys: list[str]) -> bool:
    """Delta of one table for all cars at once; False when there is no newer snapshot (M4, A10)."""
    new = tables.read_optional(spark, after)
    if new is None:
        return False
    old = tables.read_optional(spark, before) if before else None
    snapshot_delta(old, new, keys).write.mode("overwrite").parquet(out)
    return True


def run_sentiment(spark: SparkSession, source: str, target: str, factory: ScorerFactory) -> int:
    """Score every sentence file below a prefix (M5); how many files gave no row.

    The output tells by ``scored`` a neutral sentence from one whose request failed.
    """
    return tables.rewrite_prefix(spark, source, target, lambda df: score_sentiment(df, factory, keep_flag=True), schemas.SENTENCE)


def trend_from_tables(
    sentence: DataFrame,
    keyword_category: DataFrame,
    post_static: DataFrame,
    post_car: DataFrame,
    deltas: DataFrame,
    window: W.TrendWindow = W.TrendWindow(),
) -> DataFrame:
    """Trend of the newest window from the five warehouse tables (M7); no rows without deltas."""
    top = post_categories(sentence, keyword_category)
    return trend_of(top, post_static, post_car, deltas, W.latest_value(deltas, "extracted_at"), window)


def trend_of(
    top: DataFrame,
    post_static: DataFrame,
    post_car: DataFrame,
    deltas: DataFrame,
    newest: datetime | None,
    window: W.TrendWindow = W.TrendWindow(),
) -> DataFrame:
    """Trend up to ``newest`` for posts whose top category is known (M7)."""
    if newest is None:
        return deltas.sparkSession.createDataFrame([], schemas.TREND)
    return W.trend(deltas, W.category_posts(top, W.target_posts(post_static, post_car)), newest, window)


def post_categories(sentence: DataFrame, keyword_category: DataFrame) -> DataFrame:
    """``post_id, category``: the top category of each post, which does not change once a post is stored."""
    return W.top_category(W.post_category_count(sentence, keyword_category))


def run_trend(
    spark: SparkSession,
    folder: str,
    now: Column,
    window: W.TrendWindow = W.TrendWindow(),
    k: float = 2.0,
    footer: str | None = None,
) -> DataFrame:
    """Append the newest trend, drop repeats from the table, and return alert rows with payload (M7-M9).

    The fresh trend is written first: the table, the statistics and the alerts read it from there.
    Of deltas kept by day only the newest day is read for the newest time, and the days of the
    windows for the rest. Top categories come from ``post_category`` where batches have stored them,
    else from all sentences and tags.
    """
    for name in ("post_category", "post_static", "post_car", "v_post_dynamic"):
        tables.recover(spark, f"{folder}/{name}")
    read = {name: spark.read.parquet(f"{folder}/{name}") for name in ("post_static", "post_car")}
    if tables.exists(spark, f"{folder}/post_category"):
        top = spark.read.parquet(f"{folder}/post_category").select("post_id", "category")
    else:
        top = post_categories(*(spark.read.parquet(f"{folder}/{n}") for n in ("sentence", "keyword_category")))
    deltas = spark.read.parquet(f"{folder}/v_post_dynamic")
    day = tables.newest_partition(spark, f"{folder}/v_post_dynamic", "day")
    newest = W.latest_value(deltas.where(F.col("day") == F.lit(day).cast("date")) if day else deltas, "extracted_at")
    made = trend_of(top, **read, deltas=deltas, newest=newest, window=window)
    fresh = materialize(made, "trend")
    tables.append_load(fresh, f"{folder}/v_total_trend", schemas.TREND)
    tables.rebuild(spark, f"{folder}/v_total_trend", W.dedupe_trend)
    return W.alerts(fresh, k).withColumn("payload", alert_payload(now, footer))


def extraction_report(results: DataFrame, communities: DataFrame | None = None) -> DataFrame:
    """Per community: totals, success rate, band and report line.

    With the configured ``communities`` one without results is reported too, at a rate of 0.
    """
    rated = R.with_rates(R.community_totals(results, communities))
    line = community_line(*[F.col(c) for c in ("community", "attempted", "extracted", "success_rate", "band")])
    return rated.withColumn("line", line)


def page_posts(
    saved: DataFrame,
    layout: pages.PageLayout,
    dates: Callable[[Column], Column],
    start: Column | None = None,
    end: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Saved pages (``post_id, url, html`` and those to ``keep``) as raw posts with their ``status``.

    ``saved`` if the date lies in the range, or there is none; ``skipped`` outside of it; ``failed`` without text or, given
    a range, without a date.
    """
    cut = pages.page_fields(saved, layout)
    columns = cut.columns

    def raw_text(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast("string")

    def number(name: str) -> Column:
        digits = F.regexp_extract(F.replace(raw_text(name), F.lit(","), F.lit("")), r"(\d+)\D*$", 1)
        return digits.try_cast("int").alias(name)

    posted = cut.withColumn("_posted", dates(raw_text("created_at")))
    within = F.lit(True) if start is None or end is None else F.col("_posted").between(start, end)
    status = F.when(~F.coalesce("parsed", F.lit(False)) | within.isNull(), "failed").when(within, "saved").otherwise("skipped")
    clean_title = F.trim(F.split_part(raw_text("title"), F.lit("["), F.lit(1)))
    return posted.select(
        *keep,
        F.col("post_id").cast("string").alias("post_id"),
        F.col("url").alias("post_url"),
        clean_title.alias("title"),
        pages.normalize_text(raw_text("content")).alias("content"),
        iso_text(F.col("_posted")).alias("created_at"),
        *[number(n) for n in ("view_count", "upvote_count", "downvote_count", "comment_count")],
        pages.typed_comments(F.col("comments"), dates).alias("comments"),
        status.alias("status"),
    )


def extract_pages(
    saved: DataFrame,
    layout: pages.PageLayout,
    dates: Callable[[Column], Column],
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Saved pages (``post_id, url, html``) to raw posts whose date lies in the range."""
    return page_posts(saved, layout, dates, start, end).where("status = 'saved'").drop("status")


def batch_ledger(spark: SparkSession, path: str, current: DataFrame) -> DataFrame:
    """Append the current batch to the list and return it with its predecessor.

    The first run finds no list and has no predecessor; a rerun finds the predecessor it had.
    """
    current = current.select("date", "time", "batch")
    current.write.mode("append").parquet(path)
    return current_and_previous(spark.read.parquet(path), current)

