"""One batch from raw posts to alerts: the jobs in order, each reading what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.functions.dates import to_local
from forumlens.functions.lexicon import Lexicon
from forumlens.functions.text import split_sentences
from forumlens.operators.batches import batch_identity
from forumlens.operators.sentiment import ScorerFactory
from forumlens.operators.trend import TrendWindow
from forumlens.plans import jobs
from forumlens.sources import tables


@dataclass(frozen=True)
class Folders:
    """Where a deployment keeps its raw posts, batch outputs, warehouse tables and bookkeeping."""

    raw: str
    work: str
    warehouse: str
    ledger: str
    batches: str


@dataclass(frozen=True)
class Settings:
    lexicon: Lexicon
    scorer: ScorerFactory
    window: TrendWindow = TrendWindow()
    threshold: float = 2.0
    balance_chars: int | None = None
    zone: str = "Asia/Seoul"
    splitter: Callable[[Column], Column] = split_sentences
    strict: bool = False  # the stricter masking rules
    distinct: bool = False  # a keyword listed twice tags once
    keep_repeats: bool = False  # static rows of an id that occurs twice in a batch
    footer: str | None = None  # of an alert


def run_batch(spark: SparkSession, folders: Folders, run_time: datetime, settings: Settings) -> DataFrame:
    """Combine, transform, compare, score and load the batch of ``run_time`` (UTC); return its alerts.

    Raw posts are those below ``car_id=/date=/batch=`` of the batch. The deltas compare with the
    batch before it in the batch list; the first batch counts in full.
    """
    now = F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz")
    current = spark.range(1).select(*batch_identity(now, settings.zone))
    ran = jobs.batch_ledger(spark, folders.batches, current).first()
    here = f"{folders.work}/{ran.date}/{ran.batch}"
    before = f"{folders.work}/{ran.prev_date}/{ran.prev_batch}" if ran.prev_date else None
    local = to_local(now, settings.zone)

    posts = f"{folders.raw}/car_id=*/date={ran.date}/batch={ran.batch}"
    jobs.run_combine(
        spark, posts, folders.ledger, here, f"{ran.date}-{ran.batch}", local, one_per_file=False, base=folders.raw,
        keep_repeats=settings.keep_repeats,
    )
    jobs.run_transform_static(
        spark, [f"{here}/post_static"], [f"{here}/comment_static"], f"{here}/transformed", settings.lexicon,
        settings.balance_chars, settings.splitter, settings.strict, settings.distinct,
    )
    for name in ("post", "comment"):
        old = f"{before}/{name}_dynamic" if before else None
        jobs.run_delta(spark, old, f"{here}/{name}_dynamic", f"{here}/v_{name}_dynamic", ["id"])
    jobs.run_sentiment(spark, f"{here}/transformed/sentence", f"{here}/transformed/sentence_sentiment", settings.scorer)

    sources = {
        "post_static": "transformed/post_static", "comment_static": "transformed/comment_static",
        "sentence": "transformed/sentence_sentiment", "keyword_category": "transformed/keyword_category",
        "post_dynamic": "post_dynamic", "comment_dynamic": "comment_dynamic",
        "v_post_dynamic": "v_post_dynamic", "v_comment_dynamic": "v_comment_dynamic", "post_car": "post_car",
    }
    for table, path in sources.items():
        rows = tables.read_optional(spark, f"{here}/{path}")
        if rows is None:
            continue
        if "extracted_at" in rows.columns:
            tables.load(rows.withColumn("day", F.to_date("extracted_at")), folders.warehouse, table, "day")
        else:
            tables.load(rows, folders.warehouse, table, batch=f"{ran.date}-{ran.batch}")
    transformed = f"{here}/transformed"
    top = jobs.post_categories(*(spark.read.parquet(f"{transformed}/{n}") for n in ("sentence", "keyword_category")))
    tables.append_load(top, f"{folders.warehouse}/post_category", schemas.POST_CATEGORY, f"{ran.date}-{ran.batch}")
    scored = spark.read.parquet(f"{transformed}/sentence_sentiment")
    failed = scored.where("not scored").select(*schemas.SENTENCE.names)
    tables.append_load(failed, f"{folders.warehouse}/sentence_unscored", schemas.SENTENCE, f"{ran.date}-{ran.batch}")
    return jobs.run_trend(spark, folders.warehouse, local, settings.window, settings.threshold, settings.footer)
