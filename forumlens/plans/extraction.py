"""Extraction as jobs: saved pages to raw posts and run results (M11), run results to the report message."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import dates, fields
from forumlens.functions.messages import REPORT_FOOTER, report_payload
from forumlens.operators import report as R
from forumlens.operators.batches import batch_identity
from forumlens.plans import jobs
from forumlens.runtime import materialize
from forumlens.sources import pages, raw

#: A layout and how it writes dates; the second argument is the local run time, for dates without a year.
Kind = tuple[pages.PageLayout, Callable[[Column, Column], Column]]
KINDS: dict[str, Kind] = {
    "stacked": (pages.STACKED, lambda text, now: dates.first_two_words(text).try_cast("timestamp_ntz")),
    "profile": (pages.PROFILE, lambda text, now: dates.parse_dotted(fields.last_field(text))),
    "gallery": (pages.GALLERY, lambda text, now: F.coalesce(dates.parse_month_day(text, now), text.try_cast("timestamp_ntz"))),
}


def _utc(time: datetime) -> Column:
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def extract_communities(saved: DataFrame, layouts: dict[str, Kind], run_time: Column, zone: str = "Asia/Seoul") -> DataFrame:
    """Saved pages (``car_id, community, post_id, url, html``) of all communities to posts with their ``status``.

    A page is ``saved`` when its date lies in the day before the run, ``skipped`` outside of it, and ``failed``
    when it has no text or no readable date. A layout whose pages carry no date takes it from a column
    ``created_at`` of ``saved``, as the listing gave it. Pages of other communities are left out.
    """
    start, end = batch_identity(run_time, zone)[3:]
    made = []
    for community, (layout, parse) in layouts.items():
        held = ["car_id", "community", "post_id", "url", "html"]
        if "created_at" in saved.columns and "created_at" not in layout.fields:
            held.append("created_at")
        here = saved.where(F.col("community") == community).select(*held)
        made.append(jobs.page_posts(here, layout, lambda text, parse=parse: parse(text, end), start, end, keep=("car_id", "community")))
    return reduce(DataFrame.unionByName, made)


def run_extract(
    spark: SparkSession,
    saved: DataFrame,
    out: str,
    results: str,
    layouts: dict[str, Kind],
    run_time: datetime,
    zone: str = "Asia/Seoul",
) -> None:
    """Write the posts below ``car_id=/date=/batch=/community=`` and the counts of each run (car, community).

    Pages are parsed once. A rerun replaces the folders of its batch that get posts again; ``results`` is overwritten.
    """
    parsed = materialize(extract_communities(saved, layouts, _utc(run_time), zone), "extracted")
    date, _, batch = batch_identity(_utc(run_time), zone)[:3]
    posts = parsed.where("status = 'saved'").drop("status").withColumns({"date": date, "batch": batch})
    raw.write_raw_posts(posts, out, mode="overwrite", dynamic=True)
    counted = R.attempt_accounting(parsed, ["car_id", "community"])
    counted.withColumnsRenamed({"attempted": "attempted_posts_count", "extracted": "extracted_posts_count"}).write.mode("overwrite").parquet(results)


def report_message(
    results: DataFrame,
    communities: list[str],
    run_time: Column,
    started: Column,
    ended: Column,
    zone: str = "Asia/Seoul",
    footer: str | None = REPORT_FOOTER,
) -> DataFrame:
    """One row: the whole report of a run as ``payload``.

    ``run_time`` is the scheduled time, ``started`` and ``ended`` the real ones, all UTC. Every configured community has its
    line, in the given order, also one without results; results of other communities are not reported. Lines are
    collected, one per configured community.
    """
    spark = results.sparkSession
    listed = spark.createDataFrame(list(enumerate(communities)), "nth int, community string")
    lines = jobs.extraction_report(results, listed.select("community")).join(F.broadcast(listed), "community")  # given by the caller
    sections = F.transform(F.array_sort(F.collect_list(F.struct("nth", "line"))), lambda x: x["line"]).alias("lines")
    date, time, batch = batch_identity(run_time, zone)[:3]
    began = dates.to_local(F.date_trunc("second", started).cast("timestamp_ntz"), zone)
    payload = report_payload(date, time, batch, began, dates.elapsed(started, ended), F.col("lines"), footer)
    return lines.agg(sections).select(payload.alias("payload"))


def run_report(
    spark: SparkSession,
    results: str,
    out: str,
    communities: list[str],
    run_time: datetime,
    started: datetime,
    ended: datetime,
    zone: str = "Asia/Seoul",
    footer: str | None = REPORT_FOOTER,
) -> None:
    """Write the report message of the run results below ``results`` as one line of text."""
    times = [_utc(t) for t in (run_time, started, ended)]
    report_message(spark.read.parquet(results), communities, *times, zone, footer).write.mode("overwrite").text(out)
