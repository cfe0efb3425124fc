"""The driver's Parquet tables as the tables of the pipeline.

Each binding has a DataFrame form here and the same rule as a SQL view in ``SQL``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.operators.trend import MEASURES

# Categories overlap and repeat on purpose: ING is in two, HEIT twice in one.
LEXICON = {
    "design": ["TION", "MENT", "ING"],
    "performance": ["ING", "ED", "ER "],
    "price": ["HEIT", "KEIT", "LICH", "HEIT"],
    "fault": ["AS", "ESC", "CIÓN"],
}
# A lexicon of 5,000 entries by rule: consonants around every vowel, with and without endings.
_CONSONANTS = "BCDFGHLMNPRSTV"
LONG_LEXICON = {
    f"c{vowel}": [a + vowel + end for a in "BCDFHLMNPRST" for end in ("", "N")]
    + [a + vowel + b + end for a in _CONSONANTS for b in _CONSONANTS for end in ("", "A", "E", "I", "O")]
    for vowel in "AEIOU"
}
BATCH_TIME = datetime(2024, 1, 16)
BEFORE_TIME = datetime(2024, 1, 15)
POSITIVE, NEGATIVE = ["ation", "heit", "ment", "ción"], ["ed ", "schaft", "aux", "ada"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ts(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _minutes(base: str, minutes: Column) -> Column:
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        F.concat(F.lit("post_"), "doc_id").alias("id"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), "doc_id").alias("url"),
        F.when(F.col("doc_id") % 5 != 0, F.split_part(text, F.lit("\n"), F.lit(1))).alias("title"),
        text.alias("content"),
        _minutes("2024-01-01 00:00:00", F.col("doc_id")).alias("created_at"),
    )


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat(F.lit("conv_comment_"), "conv_id", F.lit("_"), "turn").alias("id"),
        F.concat(F.lit("conv_post_"), "conv_id").alias("post_id"),
        F.col("text").alias("content"),
        (F.col("turn") > 0).alias("is_reply"),
        _minutes("2024-01-02 00:00:00", F.col("conv_id")).alias("created_at"),
    )


def _cars(number: Column) -> Column:
    """One car per document, two for every seventh."""
    first = F.concat(F.lit("car"), number % 3)
    second = F.concat(F.lit("car"), (number + 1) % 3)
    return F.explode(F.when(number % 7 == 0, F.array(first, second)).otherwise(F.array(first)))


def post_car(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.concat(F.lit("post_"), "doc_id").alias("post_id"), _cars(F.col("doc_id")).alias("car_id")
    )


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a raw post whose later lines are its comments; some under two cars."""
    number = F.col("doc_id")
    lines = F.split("text", "\n")
    comment = F.transform(
        F.slice(lines, 2, F.size(lines)),
        lambda line, i: F.named_struct(
            F.lit("comment_id"), number * 100000 + i,
            F.lit("content"), line,
            F.lit("is_reply"), F.when(i % 2 == 0, "0").otherwise("true"),
            F.lit("created_at"), F.date_format(_minutes("2024-01-01 00:00:00", number + i), "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit("upvote_count"), F.when(i % 3 != 0, i.cast("int")),
            F.lit("downvote_count"), F.lit(0),
        ),
    )
    stamp = F.date_format(_minutes("2024-01-01 00:00:00", number), "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "documents").select(
        F.col("source").alias("community"),
        number.cast("string").alias("post_id"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), number).alias("post_url"),
        F.element_at(lines, 1).alias("title"),
        F.col("text").alias("content"),
        F.when(number % 2 == 1, F.concat(stamp, F.lit("Z"))).otherwise(stamp).alias("created_at"),
        F.col("n_chars").cast("int").alias("view_count"),
        (number % 50).cast("int").alias("upvote_count"),
        F.lit(None).cast("int").alias("downvote_count"),
        F.when(number % 4 != 0, (number % 9).cast("int")).alias("comment_count"),
        comment.alias("comments"),
        _cars(number).alias("car_id"),
    )


def seen_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth post and the first comment of others are known."""
    docs = table(spark, sf, "documents")
    known = docs.where("doc_id % 4 = 0").select(F.concat("source", F.lit("_post_"), "doc_id").alias("id"))
    return known.unionByName(docs.where("doc_id % 4 = 1").select(F.concat("source", F.lit("_comment_"), F.col("doc_id") * 100000).alias("id")))


def snapshot(spark: SparkSession, sf: str, until: datetime) -> DataFrame:
    """Counters per user up to a time; some users have no downvote counter."""

    def counter(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind).cast("int")

    known = F.col("user_id") % 7 != 0
    return (
        table(spark, sf, "events").where(F.col("ts") <= ts(until))
        .groupBy("user_id")
        .agg(
            counter("view").alias("view_count"), counter("purchase").alias("upvote_count"),
            counter("error").alias("_down"), counter("click").alias("comment_count"),
        )
        .select(
            F.concat(F.lit("post_"), "user_id").alias("id"), ts(until).alias("extracted_at"), "view_count",
            "upvote_count", F.when(known, F.col("_down")).alias("downvote_count"), "comment_count",
        )
    )


def deltas(spark: SparkSession, sf: str) -> DataFrame:
    def moved(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.floor("value").cast("int"))

    return table(spark, sf, "events").select(
        F.concat(F.lit("post_"), "user_id").alias("id"), F.col("ts").alias("extracted_at"),
        moved("view").alias("v_view_count"), moved("purchase").alias("v_upvote_count"),
        moved("error").alias("v_downvote_count"), moved("click").alias("v_comment_count"),
    )


def results(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.concat(F.lit("car"), F.col("user_id") % 3).alias("car_id"), F.col("event_type").alias("community"))
        .agg(
            F.count(F.lit(1)).alias("attempted_posts_count"),
            F.count_if(F.col("value") < 100).alias("extracted_posts_count"),
        )
    )


_CARS_SQL = "unnest(CASE WHEN doc_id % 7 = 0 THEN [doc_id % 3, (doc_id + 1) % 3] ELSE [doc_id % 3] END)"

SQL = {
    "posts": """SELECT 'post_' || doc_id AS id, 'https://' || source || '.example/' || doc_id AS url,
        CASE WHEN doc_id % 5 <> 0 THEN split_part(text, chr(10), 1) END AS title, text AS content,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at FROM documents""",
    "comments": """SELECT 'conv_comment_' || conv_id || '_' || turn AS id, 'conv_post_' || conv_id AS post_id,
        text AS content, turn > 0 AS is_reply,
        TIMESTAMP '2024-01-02 00:00:00' + to_minutes(conv_id) AS created_at FROM conversations""",
    "post_car": f"SELECT 'post_' || doc_id AS post_id, 'car' || {_CARS_SQL} AS car_id FROM documents",
    "raw_posts": f"""SELECT source AS community, doc_id, 'https://' || source || '.example/' || doc_id AS post_url,
        split_part(text, chr(10), 1) AS title, text AS content,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at, n_chars::INTEGER AS view_count,
        (doc_id % 50)::INTEGER AS upvote_count, NULL::INTEGER AS downvote_count,
        CASE WHEN doc_id % 4 <> 0 THEN (doc_id % 9)::INTEGER END AS comment_count,
        source || '_post_' || doc_id AS id, 'car' || {_CARS_SQL} AS car_id FROM documents""",
    "raw_comments": """SELECT community || '_comment_' || (doc_id * 100000 + i) AS id, id AS post_id, line AS content,
        i % 2 = 1 AS is_reply, created_at + to_minutes(i) AS created_at,
        CASE WHEN i % 3 <> 0 THEN i::INTEGER END AS upvote_count, 0 AS downvote_count
        FROM (SELECT *, unnest(lines[2:]) AS line, unnest(range(len(lines) - 1)) AS i
              FROM (SELECT *, string_split(content, chr(10)) AS lines FROM raw_posts))""",
    "seen_ids": """SELECT source || '_post_' || doc_id AS id FROM documents WHERE doc_id % 4 = 0
        UNION ALL SELECT source || '_comment_' || doc_id * 100000 FROM documents WHERE doc_id % 4 = 1""",
    "snapshots": """SELECT 'post_' || user_id AS id, t AS extracted_at,
        count(*) FILTER (event_type = 'view')::INTEGER AS view_count,
        count(*) FILTER (event_type = 'purchase')::INTEGER AS upvote_count,
        CASE WHEN user_id % 7 <> 0 THEN count(*) FILTER (event_type = 'error')::INTEGER END AS downvote_count,
        count(*) FILTER (event_type = 'click')::INTEGER AS comment_count
        FROM events JOIN (VALUES (TIMESTAMP '2024-01-15'), (TIMESTAMP '2024-01-16')) v(t) ON ts <= t GROUP BY user_id, t""",
    "before": "SELECT * FROM snapshots WHERE extracted_at = TIMESTAMP '2024-01-15'",
    "after": "SELECT * FROM snapshots WHERE extracted_at = TIMESTAMP '2024-01-16'",
    "deltas": """SELECT 'post_' || user_id AS id, ts AS extracted_at,
        CASE WHEN event_type = 'view' THEN floor(value)::INTEGER END AS v_view_count,
        CASE WHEN event_type = 'purchase' THEN floor(value)::INTEGER END AS v_upvote_count,
        CASE WHEN event_type = 'error' THEN floor(value)::INTEGER END AS v_downvote_count,
        CASE WHEN event_type = 'click' THEN floor(value)::INTEGER END AS v_comment_count FROM events""",
    "results": """SELECT 'car' || (user_id % 3) AS car_id, event_type AS community, count(*) AS attempted_posts_count,
        count(*) FILTER (value < 100) AS extracted_posts_count FROM events GROUP BY 1, 2""",
    # cleaning: the look-behind and look-ahead rules in forms without them
    "clean_posts": "SELECT id, url, title, {clean} AS content, created_at FROM posts",
    "clean_comments": "SELECT id, post_id, {clean} AS content, is_reply, created_at FROM comments",
    "sources": """SELECT id AS source_id, title, content, created_at FROM clean_posts
        UNION ALL SELECT id, NULL, content, created_at FROM clean_comments""",
    "pieces": """SELECT source_id, created_at, coalesce(length(title) > 0, false) AS from_post,
        {split_title} || {split_content} AS sents FROM sources""",
    "all_sentences": """SELECT source_id || '_' || i AS id, source_id, from_post, sentence, created_at
        FROM (SELECT *, unnest(sents) AS sentence, unnest(range(len(sents))) AS i FROM pieces)""",
    "sentence": "SELECT * FROM all_sentences WHERE length(sentence) >= 6",
    "lexicon": "SELECT * FROM (VALUES {lexicon}) l(ord, category, keyword)",
    "keyword_category": """SELECT id AS sentence_id, category, keyword
        FROM sentence JOIN lexicon ON contains(upper(replace(sentence, 'ß', 'SS')), keyword)""",
    # the cars of stored posts
    "target_posts": "SELECT car_id, post_id FROM post_car WHERE post_id IN (SELECT id FROM posts)",
    # tags are counted per sentence, then summed per post
    "tag_counts": "SELECT sentence_id, category, count(*) AS tags FROM keyword_category GROUP BY ALL",
    "post_category_count": """SELECT source_id AS post_id, category, sum(tags)::BIGINT AS category_count
        FROM (FROM sentence WHERE from_post) INNER JOIN tag_counts ON sentence_id = id GROUP BY ALL""",
    "top_category": "SELECT post_id, arg_min(category, (-category_count, category)) AS category FROM post_category_count GROUP BY post_id",
    "category_posts": "SELECT car_id, post_id, category FROM top_category JOIN target_posts USING (post_id)",
    "buckets": """SELECT m - to_minutes(i * {step}) AS bucket_end, m - to_minutes({horizon}) AS window_start
        FROM (SELECT max(extracted_at) AS m FROM deltas), range({horizon} // {step} + 1) r(i)""",
    # every movement of a pair is held against every bucket; a pair without any keeps its rows
    "moves": "SELECT * FROM category_posts LEFT JOIN deltas ON post_id = id",
    "placed": """SELECT *, coalesce(extracted_at BETWEEN bucket_end - to_minutes({width}) + INTERVAL 1 MICROSECOND AND bucket_end, false) AS inside
        FROM moves, buckets""",
    "trend": """SELECT bucket_end AS batch_time, car_id, category, {means} FROM placed GROUP BY ALL""",
    "changes": """SELECT *, total_view - lag(total_view) OVER (PARTITION BY car_id, category ORDER BY batch_time)
        AS view_change FROM trend""",
    "threshold": """SELECT avg(view_change) AS mean, stddev_samp(view_change) AS std,
        avg(view_change) + 2 * stddev_samp(view_change) AS threshold FROM changes""",
    "peaks": """SELECT car_id, category, max(view_change) AS view_change, max(total_view) AS total_view FROM changes
        WHERE batch_time = (SELECT max(batch_time) FROM changes) GROUP BY 1, 2""",
}

# view -> the views it reads
_NEEDS = {
    "raw_comments": ["raw_posts"], "before": ["snapshots"], "after": ["snapshots"], "clean_posts": ["posts"],
    "clean_comments": ["comments"], "sources": ["clean_posts", "clean_comments"], "pieces": ["sources"],
    "all_sentences": ["pieces"], "sentence": ["all_sentences"], "keyword_category": ["sentence", "lexicon"],
    "target_posts": ["posts", "post_car"], "tag_counts": ["keyword_category"], "post_category_count": ["sentence", "tag_counts"],
    "top_category": ["post_category_count"], "category_posts": ["top_category", "target_posts"],
    "buckets": ["deltas"], "moves": ["category_posts", "deltas"], "placed": ["moves", "buckets"], "trend": ["placed"], "changes": ["trend"],
    "threshold": ["changes"], "peaks": ["changes"],
}


def clean_sql(text: str) -> str:
    for pattern, replacement in (
        (r"https?://\S+", "<URL>"),
        (r"(^|\s)@[A-Za-z0-9_가-힣\-]+", r"\1<USER>"),
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>"),
        (r"&nbsp;|\x{00A0}", ""),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    text = rf"regexp_replace(trim({text}, ' '), '[\s\x0B]+', ' ', 'g')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '([가-힣]+[.?!])([가-힣0-9a-zA-Z])', '\1 \2', 'g')"
    return rf"regexp_replace({text}, 'ㅋ{{4,}}', 'ㅋㅋㅋㅋ', 'g')"


def split_sql(text: str) -> str:
    marked = rf"regexp_replace({text}, '([.!?]) +', '\1' || chr(1), 'g')"
    trimmed = f"list_transform(string_split({marked}, chr(1)), lambda s: trim(s, ' '))"
    return f"coalesce(list_filter({trimmed}, lambda s: length(s) > 0), [])"


def lexicon_sql(lexicon: dict[str, list[str]]) -> str:
    entries = [(c, w) for c, words in lexicon.items() for w in words]
    return ", ".join(f"({i}, '{c}', '{w}')" for i, (c, w) in enumerate(entries))


def with_views(query: str, *views: str, step: int = 30, horizon: int = 360, width: int = 180) -> str:
    """``query`` after the views it names and the views those need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for view in views:
        visit(view)
    fill = {
        "{clean}": clean_sql("content"), "{split_title}": split_sql("title"),
        "{split_content}": split_sql("content"), "{lexicon}": lexicon_sql(LEXICON),
        "{means}": ", ".join(f"coalesce(avg({c}) FILTER (inside), 0) AS {name}" for name, c in MEASURES.items()),
        "{step}": str(step), "{horizon}": str(horizon), "{width}": str(width),
    }
    parts = []
    for name in order:
        text = SQL[name]
        for mark, value in fill.items():
            text = text.replace(mark, value)
        parts.append(f"{name} AS ({text})")
    return f"WITH {', '.join(parts)} {query}" if parts else query
