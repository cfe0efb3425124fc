"""Cleaned posts and comments to sentence and keyword rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.inverted import tagger
from forumlens.functions.lexicon import Lexicon, tag_keywords
from forumlens.functions.text import clean_text, is_from_post, is_long_enough, split_sentences

# Builds, once per task, a function from one text to its sentences.
SplitterFactory = Callable[[], Callable[[str], list[str]]]


def clean_columns(df: DataFrame, columns: tuple[str, ...] = ("content",), strict: bool = False) -> DataFrame:
    """Mask and clean the named columns; titles stay as they are by default (H9)."""
    return df.withColumns({c: clean_text(F.col(c), strict) for c in columns})


def as_source(df: DataFrame) -> DataFrame:
    """``source_id, title, content, created_at``; a table without titles gets null ones."""
    title = F.col("title") if "title" in df.columns else F.lit(None).cast("string")
    return df.select(F.col("id").alias("source_id"), title.alias("title"), "content", "created_at")


def union_sources(*tables: DataFrame | None) -> DataFrame:
    """Posts and comments in one frame; either side may be absent (G1)."""
    present = [as_source(t) for t in tables if t is not None]
    if not present:
        raise ValueError("neither posts nor comments were given")
    union = present[0]
    for table in present[1:]:
        union = union.unionByName(table)
    return union


def plugin_splitter(factory: SplitterFactory) -> Callable[[Column], Column]:
    """A splitter column from a Python sentence model, built once per task (K1).

    The model sees one text at a time; the split itself is spread by Spark. Rows are pickled, a hundred at once:
    Arrow would hold thousands of texts and all their sentences in each worker.
    """
    built: list[Callable[[str], list[str]]] = []  # empty in the copy that each task unpickles

    @F.udf("array<string>", useArrow=False)
    def split(text: str | None) -> list[str]:
        if not built:
            built.append(factory())
        return built[0](text) if text else []

    return split


def explode_sentences(
    source: DataFrame, splitter: Callable[[Column], Column] = split_sentences
) -> DataFrame:
    """One row per sentence, title first, under one running index; short ones leave gaps."""
    split = source.select(
        "source_id",
        "created_at",
        is_from_post(F.col("title")).alias("from_post"),
        F.posexplode(F.concat(splitter(F.col("title")), splitter(F.col("content")))).alias("idx", "sentence"),
    )
    return split.where(is_long_enough(F.col("sentence"))).select(
        F.concat_ws("_", "source_id", F.col("idx").cast("string")).alias("id"),
        "source_id",
        "from_post",
        "sentence",
        "created_at",
    )


def keyword_rows(sentences: DataFrame, lexicon: Lexicon, distinct: bool = False) -> DataFrame:
    """One row per tag; sentences without a tag vanish."""
    tags = tag_keywords(F.col("sentence"), lexicon, distinct)
    return sentences.select(F.col("id").alias("sentence_id"), F.inline(tags))


def inverted_keyword_rows(sentences: DataFrame, lexicon: Lexicon, distinct: bool = False) -> DataFrame:
    """The rows of ``keyword_rows`` for lexicons of thousands of entries.

    ``keyword_rows`` is an expression that looks for every entry in every sentence, so its cost grows with their
    product; here substrings are looked up among the entries, at one cost for any number of them. The caller
    chooses: the expression is faster up to a few hundred entries.
    """
    upper = sentences.select(F.col("id").alias("sentence_id"), F.upper("sentence").alias("upper"))
    return upper.mapInArrow(tagger(lexicon, distinct), "sentence_id string, category string, keyword string")
