"""Trend, its building blocks, and alerts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.functions.messages import ALERT_BODY, ALERT_HEADER, ALERT_TEXT, alert_payload
from forumlens.operators import sentences as S
from forumlens.operators import trend as W
from forumlens.plans import jobs
from forumlens.runtime import materialize, new_path
from forumlens.sources import tables
from forumlens.workload import bindings as B
from forumlens.workload.bindings import with_views
from forumlens.workload.registry import query

_WIDE = W.TrendWindow(horizon=timedelta(days=10), step=timedelta(hours=12), width=timedelta(days=3))
_WIDE_MINUTES = {"step": 720, "horizon": 14400, "width": 4320}
# the width is no multiple of the step
_UNEVEN = W.TrendWindow(horizon=timedelta(days=4), step=timedelta(hours=10), width=timedelta(hours=36))
_UNEVEN_MINUTES = {"step": 600, "horizon": 5760, "width": 2160}

_MEANS = ", ".join(f"round({c}, 6) AS {c}" for c in W.MEASURES)
_TREND_SQL = f"SELECT batch_time, car_id, category, {_MEANS} FROM trend"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _sentence(spark, sf):
    """Sentences as the transform job leaves them: written once, then tagged and joined from there."""
    source = S.union_sources(S.clean_columns(B.posts(spark, sf)), S.clean_columns(B.comments(spark, sf)))
    sentence = materialize(S.explode_sentences(source), "sentence")
    return {"sentence": sentence, "keyword_category": S.keyword_rows(sentence, B.LEXICON)}


def _counts(spark, sf):
    made = _sentence(spark, sf)
    return W.post_category_count(made["sentence"], made["keyword_category"])


def _trend(spark, sf, window=W.TrendWindow()):
    made = _sentence(spark, sf)
    return jobs.trend_from_tables(
        made["sentence"], made["keyword_category"], B.posts(spark, sf), B.post_car(spark, sf),
        B.deltas(spark, sf), window,
    )


@query("I2 G2 H35", with_views("SELECT bucket_end, window_start FROM buckets", "buckets"))
def time_buckets(spark, sf):
    return W.time_buckets(B.deltas(spark, sf))


@query("C2", with_views("SELECT car_id, post_id FROM target_posts", "target_posts"))
def target_posts(spark, sf):
    return W.target_posts(B.posts(spark, sf), B.post_car(spark, sf)).select("car_id", "post_id")


@query("C3 D1", with_views("SELECT * FROM post_category_count", "post_category_count"))
def post_category_count(spark, sf):
    return _counts(spark, sf)


@query("E1 F2", with_views("SELECT * FROM top_category", "top_category"))
def top_category(spark, sf):
    return W.top_category(_counts(spark, sf))


@query("C4", with_views("SELECT car_id, post_id, category FROM category_posts", "category_posts"))
def category_posts(spark, sf):
    targets = W.target_posts(B.posts(spark, sf), B.post_car(spark, sf))
    return W.category_posts(W.top_category(_counts(spark, sf)), targets).drop("weight")


@query("C5 C6 D2 F1 H36 M7", with_views(_TREND_SQL, "trend"))
def trend(spark, sf):
    keys = ("batch_time", "car_id", "category")
    return _rounded(_trend(spark, sf), *W.MEASURES).orderBy(*keys)


@query("C5 C6 D2 M7", with_views(_TREND_SQL, "trend", **_WIDE_MINUTES))
def trend_wide(spark, sf):
    return _rounded(_trend(spark, sf, _WIDE), *W.MEASURES)


@query("C6 D2", with_views(_TREND_SQL, "trend", **_UNEVEN_MINUTES))
def trend_uneven(spark, sf):
    return _rounded(_trend(spark, sf, _UNEVEN), *W.MEASURES)


@query("C6", with_views(
    """SELECT bucket_end, id, count(*) AS deltas, sum(coalesce(v_view_count, 0))::BIGINT AS views FROM buckets JOIN deltas
    ON extracted_at > bucket_end - to_minutes(4320) AND extracted_at <= bucket_end GROUP BY 1, 2""", "buckets", **_WIDE_MINUTES))
def interval_join(spark, sf):
    deltas = B.deltas(spark, sf)
    return W.interval_sums(deltas, W.latest_value(deltas, "extracted_at"), _WIDE)


def _wide_trend(spark, sf):
    """The trend is small, and read several times below: write it once."""
    return materialize(_trend(spark, sf, _WIDE), "trend")


@query("E3", with_views(
    "SELECT batch_time, car_id, category, round(view_change, 6) AS view_change FROM changes", "changes", **_WIDE_MINUTES))
def view_change(spark, sf):
    changes = W.view_change(_wide_trend(spark, sf))
    return _rounded(changes.select("batch_time", "car_id", "category", "view_change"), "view_change")


@query("D3", with_views(
    "SELECT round(mean, 6) AS mean, round(std, 6) AS std, round(threshold, 6) AS threshold FROM threshold", "threshold", **_WIDE_MINUTES))
def change_threshold(spark, sf):
    return _rounded(W.change_threshold(W.view_change(_wide_trend(spark, sf))), "mean", "std", "threshold")


@query("B20", with_views(
    "SELECT car_id, category, round(total_view, 6) AS total_view FROM trend WHERE batch_time = (SELECT max(batch_time) FROM trend)", "trend", **_WIDE_MINUTES))
def latest_batch(spark, sf):
    return _rounded(W.latest_rows(_wide_trend(spark, sf), "batch_time").select("car_id", "category", "total_view"), "total_view")


@query("D5", "SELECT max(ts) AS newest_event, (SELECT max(o_orderdate) FROM orders) AS newest_order FROM events")
def newest_times(spark, sf):
    return spark.range(1).select(
        W.latest(B.table(spark, sf, "events"), "ts").alias("newest_event"),
        W.latest(B.table(spark, sf, "orders"), "o_orderdate").alias("newest_order"),
    )


@query("D4", with_views("SELECT car_id, category, round(view_change, 6) AS view_change, round(total_view, 6) AS total_view FROM peaks", "peaks", **_WIDE_MINUTES))
def peak_change(spark, sf):
    changes = W.latest_rows(W.view_change(_wide_trend(spark, sf)), "batch_time")
    return _rounded(W.peak_change(changes), "view_change", "total_view")


@query("B21 M9", with_views(
    """SELECT car_id, category, round(view_change, 6) AS view_change, round(total_view, 6) AS total_view FROM peaks
    WHERE view_change > (SELECT mean + 0.1 * std FROM threshold)""", "peaks", "threshold", **_WIDE_MINUTES))
def alerts(spark, sf):
    return _rounded(W.alerts(_wide_trend(spark, sf), k=0.1), "view_change", "total_view")


_BODY_SQL = "'" + ALERT_BODY.replace("\n", "' || chr(10) || '") % (
    "2024-01-16 00:00:00", *(f"' || {c} || '" for c in ("car_id", "category", "floor(view_change)", "floor(total_view)"))
) + "'"


@query("H37 M9", with_views(
    f"""SELECT car_id, category, '{ALERT_TEXT}' AS text, '{ALERT_HEADER}' AS title, {_BODY_SQL} AS body, 'the dashboard' AS note FROM peaks
    WHERE view_change > (SELECT mean + 0.1 * std FROM threshold)""", "peaks", "threshold", **_WIDE_MINUTES))
def alert_messages(spark, sf):
    """The whole message of each alert, its figures in whole numbers."""
    rows = W.alerts(_wide_trend(spark, sf), k=0.1)
    whole = rows.withColumns({c: F.floor(c).cast("double") for c in ("view_change", "total_view")})
    blocks = "$.attachments[0].blocks"
    parts = {"text": "$.text", "title": f"{blocks}[0].text.text", "body": f"{blocks}[2].fields[0].text", "note": f"{blocks}[3].elements[0].text"}
    payload = whole.withColumn("payload", alert_payload(B.ts(B.BATCH_TIME), "the dashboard"))
    return payload.select("car_id", "category", *[F.get_json_object("payload", path).alias(name) for name, path in parts.items()])


_REPEATED_SQL = """SELECT DISTINCT batch_time, car_id, category, round(total_view, 6) + 1 AS total_view FROM trend"""


@query("E2 M8", with_views(_REPEATED_SQL, "trend", **_WIDE_MINUTES))
def trend_dedup(spark, sf):
    rows = _wide_trend(spark, sf)
    higher = rows.withColumn("total_view", F.round("total_view", 6) + 1)
    return W.dedupe_trend(rows.unionByName(higher)).select("batch_time", "car_id", "category", "total_view")


@query("A15 A16 M8", with_views(f"SELECT count(*) AS rows, count(DISTINCT batch_time) AS buckets FROM trend", "trend", **_WIDE_MINUTES))
def trend_append_and_rebuild(spark, sf):
    """The same trend is appended twice and the table rebuilt without repeats."""
    path, rows = new_path(spark, "trend_table"), _wide_trend(spark, sf)
    for _ in range(2):
        tables.append_load(rows, path, schemas.TREND)
    tables.rebuild(spark, path, W.dedupe_trend)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("batch_time").alias("buckets"))


@query("A14", with_views(
    "SELECT car_id, count(*) AS posts FROM target_posts GROUP BY 1", "target_posts"))
def query_result(spark, sf):
    """A report query in SQL over registered tables."""
    B.posts(spark, sf).createOrReplaceTempView("post_static")
    B.post_car(spark, sf).createOrReplaceTempView("post_car")
    return spark.sql(
        "SELECT car_id, count(*) AS posts FROM post_car LEFT SEMI JOIN post_static ON id = post_id GROUP BY car_id"
    )
