"""Cleaning, splitting, tagging and scoring of text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyarrow.fs import FileSelector
from pyspark.sql import functions as F

from forumlens.functions import fields, lexicon, text
from forumlens.operators import sentences as S
from forumlens.operators import sentiment
from forumlens.plans import jobs
from forumlens.sources import isolated, tables
from forumlens.runtime import new_path
from forumlens.workload import bindings as B
from forumlens.workload.bindings import with_views
from forumlens.workload.registry import query

# The documents hold no URL, handle, Hangul or no-break space, so some are written into each text.
_NOISY_SQL = """replace(text, '. ', '다.') || ' @' || source || '-이 ㅋㅋㅋㅋㅋㅋ see https://' || source || '.example/'
    || doc_id || ' x&nbsp;y' || chr(160) || 'z@' || lang || '.example.org'"""


def _noisy() -> Column:
    return F.concat(
        F.replace("text", F.lit(". "), F.lit("다.")), F.lit(" @"), "source", F.lit("-이 ㅋㅋㅋㅋㅋㅋ see https://"),
        "source", F.lit(".example/"), "doc_id", F.lit(" x&nbsp;y z@"), "lang", F.lit(".example.org"),
    )


def _over_noisy(step: Callable[[Column], Column]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        noisy = B.table(spark, sf, "documents").select("doc_id", _noisy().alias("text"))
        return noisy.select("doc_id", step(F.col("text")).alias("content"))

    return run


def _noisy_sql(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS content FROM (SELECT doc_id, {_NOISY_SQL} AS text FROM documents)"


def _register(name: str, covers: str, step: Callable[[Column], Column], expression: str) -> None:
    run = _over_noisy(step)
    run.__name__ = name
    query(covers, _noisy_sql(expression))(run)


_register("mask_urls", "H1", text.mask_urls, r"regexp_replace(text, 'https?://\S+', '<URL>', 'g')")
_register("mask_handles", "H2", text.mask_handles, r"regexp_replace(text, '(^|\s)@[A-Za-z0-9_가-힣\-]+', '\1<USER>', 'g')")
_register("mask_emails", "H3", text.mask_emails, r"regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g')")
_register("drop_no_break_space", "H4", text.drop_no_break_space, "replace(replace(text, '&nbsp;', ''), chr(160), '')")
_register("trim_text", "H5", lambda c: F.trim(F.concat(F.lit("  "), c, F.lit("\n  "))), "trim('  ' || text || chr(10) || '  ', ' ')")
_register("collapse_whitespace", "H6", text.collapse_whitespace, r"regexp_replace(text, '[\s\x0B]+', ' ', 'g')")
_register(
    "space_sentence_ends", "H7", text.space_sentence_ends,
    r"regexp_replace(regexp_replace(text, '([가-힣]+[.?!])([가-힣0-9a-zA-Z])', '\1 \2', 'g'), '([가-힣]+[.?!])([가-힣0-9a-zA-Z])', '\1 \2', 'g')",
)
_register("cap_laughs", "H8", text.cap_laughs, "regexp_replace(text, 'ㅋ{4,}', 'ㅋㅋㅋㅋ', 'g')")
_register("clean_text", "H9", text.clean_text, B.clean_sql("text"))
_register("normalize_text", "H30", text.normalize_text, r"nullif(trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g'), ' '), '')")


@query("H9 A6", with_views("SELECT * FROM clean_posts", "clean_posts"))
def clean_posts(spark, sf):
    return S.clean_columns(B.posts(spark, sf))


@query("H9", with_views("SELECT * FROM clean_comments", "clean_comments"))
def clean_comments(spark, sf):
    return S.clean_columns(B.comments(spark, sf))


@query("H10", "SELECT doc_id, upper(replace(text, 'ß', 'SS')) AS upper_text FROM documents")
def upper_text(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", F.upper("text").alias("upper_text"))


@query("H13", "SELECT doc_id, length(text) AS characters FROM documents")
def text_length(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("characters"))


@query("H17", "SELECT source || '_post_' || doc_id AS id FROM documents")
def entity_ids(spark, sf):
    return B.table(spark, sf, "documents").select(fields.entity_id(F.col("source"), "post", F.col("doc_id")).alias("id"))


@query("B7", with_views("SELECT * FROM sources", "sources"))
def title_default(spark, sf):
    return S.union_sources(S.clean_columns(B.posts(spark, sf)), S.clean_columns(B.comments(spark, sf)))


def _sources(spark, sf):
    return title_default(spark, sf)


def _sentences(spark, sf):
    return S.explode_sentences(_sources(spark, sf))


@query("H12 I1", f"SELECT doc_id, unnest({B.split_sql('text')}) AS sentence FROM documents")
def split_sentences(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", F.explode(text.split_sentences(F.col("text"))).alias("sentence"))


@query("B8 B9 H12 I1 M2", with_views("SELECT * FROM sentence", "sentence"))
def sentence(spark, sf):
    return jobs.transform_static(B.posts(spark, sf), B.comments(spark, sf), B.LEXICON)["sentence"]


@query("B10 H11 I1 M2", with_views("SELECT * FROM keyword_category", "keyword_category"))
def keyword_category(spark, sf):
    return jobs.transform_static(B.posts(spark, sf), B.comments(spark, sf), B.LEXICON)["keyword_category"]


@query("B11", with_views("SELECT id, length(sentence) AS characters FROM sentence", "sentence"))
def long_sentences(spark, sf):
    return _sentences(spark, sf).select("id", F.length("sentence").cast("long").alias("characters"))


@query("B12", "SELECT id, coalesce(length(title) > 0, false) AS from_post FROM (" + B.SQL["posts"] + ")")
def from_post_flag(spark, sf):
    return B.posts(spark, sf).select("id", text.is_from_post(F.col("title")).alias("from_post"))


@query("B19", with_views("SELECT id, source_id FROM sentence WHERE from_post", "sentence"))
def post_sentences(spark, sf):
    return _sentences(spark, sf).where("from_post").select("id", "source_id")


@query("G1", with_views("SELECT source_id, count(*) AS sentences FROM sentence GROUP BY 1", "sentence"))
def union_sentences(spark, sf):
    return _sentences(spark, sf).groupBy("source_id").agg(F.count(F.lit(1)).alias("sentences"))


@query("H11", with_views("SELECT category, keyword, count(*) AS tags FROM keyword_category GROUP BY 1, 2", "keyword_category"))
def keyword_counts(spark, sf):
    return S.keyword_rows(_sentences(spark, sf), B.LEXICON).groupBy("category", "keyword").agg(F.count(F.lit(1)).alias("tags"))


@query("H11 K1", with_views(
    f"""SELECT category, keyword, count(*) AS tags FROM sentence JOIN (VALUES {B.lexicon_sql(B.LONG_LEXICON)}) l(ord, category, keyword)
    ON contains(upper(replace(sentence, 'ß', 'SS')), keyword) GROUP BY 1, 2""", "sentence"))
def long_lexicon_counts(spark, sf):
    return S.inverted_keyword_rows(_sentences(spark, sf), B.LONG_LEXICON).groupBy("category", "keyword").agg(F.count(F.lit(1)).alias("tags"))


@query("B17", "SELECT id, title FROM (" + B.SQL["posts"] + ") WHERE contains(title, 'ation') OR contains(title, 'heit') OR contains(title, 'ment')")
def title_keyword_match(spark, sf):
    words = F.array(*[F.lit(w) for w in ("ation", "heit", "ment")])
    return B.posts(spark, sf).where(lexicon.matches_any(F.col("title"), words)).select("id", "title")


def _word_splitter():
    """A stand-in for a sentence model: one sentence per line."""
    return lambda value: [line.strip() for line in value.split("\n") if line.strip()]


@query("K1", """SELECT doc_id, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE length(trim(line, ' ')) > 0 GROUP BY 1""")
def plugin_sentences(spark, sf):
    split = S.plugin_splitter(_word_splitter)
    lines = B.table(spark, sf, "documents").select("doc_id", split(F.col("text")).alias("lines"))
    return lines.where(F.size("lines") > 0).select("doc_id", F.size("lines").cast("long").alias("lines"))


def _score_sql() -> str:
    good = " + ".join(f"contains(sentence, '{w}')::INTEGER" for w in B.POSITIVE)
    bad = " + ".join(f"contains(sentence, '{w}')::INTEGER" for w in B.NEGATIVE)
    return f"sign(({good}) - ({bad}))::INTEGER"


@query("B22 K2 M5", with_views(f"SELECT *, {_score_sql()} AS sentiment FROM sentence", "sentence"))
def sentence_sentiment(spark, sf):
    return sentiment.score_sentiment(_sentences(spark, sf), sentiment.word_scorer(B.POSITIVE, B.NEGATIVE))


@query("D8", with_views(f"SELECT {_score_sql()} AS sentiment, count(*) AS sentences FROM sentence GROUP BY 1", "sentence"))
def sentiment_counts(spark, sf):
    return sentiment.sentiment_counts(sentence_sentiment(spark, sf))


def _damage(spark, folder):
    """Beside a good Parquet file of the folder: one cut off, one with other bytes in a page, one without any."""
    system, root = isolated.opened(folder)
    good = next(f.path for f in system.get_file_info(FileSelector(root, recursive=True)) if f.path.endswith(".parquet"))
    whole = system.open_input_file(good).read()
    page = whole[:200] + bytes(byte ^ 255 for byte in whole[200:260]) + whole[260:]
    for name, content in (("cut", whole[: len(whole) // 2]), ("page", page), ("empty", b"")):
        with system.open_output_stream(f"{root}/{name}.parquet") as out:
            out.write(content)


@query("A11 M5", with_views(f"SELECT id, {_score_sql()} AS sentiment FROM sentence UNION ALL SELECT 'files left out', 3", "sentence"))
def rewrite_prefix(spark, sf):
    """Three damaged files lie among the good ones; they are listed and stop none."""
    source, target = new_path(spark, "sentence"), new_path(spark, "sentiment")
    _sentences(spark, sf).write.parquet(f"{source}/part")
    _damage(spark, source)
    jobs.run_sentiment(spark, source, target, sentiment.word_scorer(B.POSITIVE, B.NEGATIVE))
    listed = spark.read.parquet(f"{target}.skipped").agg(F.lit("files left out").alias("id"), F.count("*").cast("int").alias("sentiment"))
    return spark.read.parquet(target).select("id", "sentiment").unionByName(listed)


@query("H41", f"""SELECT doc_id, array_to_string(list_transform({B.split_sql('text')}, lambda s, i: i || '번째 문장 >> "' || s || '"'), chr(10)) AS request FROM documents""")
def scoring_request(spark, sf):
    lines = sentiment.numbered_lines(text.split_sentences(F.col("text")))
    return B.table(spark, sf, "documents").select("doc_id", lines.alias("request"))


@query("A8 A9 M2", with_views(
    "SELECT (SELECT count(*) FROM posts) AS post_static, (SELECT count(*) FROM sentence WHERE source_id LIKE 'post%') AS sentence, "
    "(SELECT count(*) FROM keyword_category WHERE sentence_id LIKE 'post%') AS keyword_category", "keyword_category", "posts"))
def transform_outputs(spark, sf):
    """The written job: the comment path is missing, so only posts are transformed."""
    source, out = new_path(spark, "posts"), new_path(spark, "transformed")
    B.posts(spark, sf).write.parquet(source)
    jobs.run_transform_static(spark, [source], [f"{source}-missing"], out, B.LEXICON)
    sizes = [tables.read_optional(spark, f"{out}/{name}").agg(F.count(F.lit(1))).scalar().alias(name)
             for name in ("post_static", "sentence", "keyword_category")]
    return spark.range(1).select(*sizes)
