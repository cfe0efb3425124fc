"""Keyword tagging against a lexicon that the caller supplies.

A lexicon is ``{category: [keyword, ...]}``. Order and repeats are kept: a keyword listed twice
in a category gives two tags. Sentences are upper-cased, keywords are not.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Lexicon = dict[str, list[str]]


def read_lexicon(spark: SparkSession, path: str) -> Lexicon:
    """Load a lexicon from one JSON object ``{category: [keyword, ...]}``.

    It is configuration that someone edits by hand, a few hundred words, and becomes a literal of
    the plan; the tables it is applied to are never collected.
    """
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0])


def lexicon_entries(lexicon: Lexicon, distinct: bool = False) -> list[tuple[str, str]]:
    """(category, keyword) in the order given; an empty keyword, which every sentence holds, is refused."""
    entries = [(category, word) for category, words in lexicon.items() for word in words]
    empty = sorted({category for category, word in entries if not word})
    if empty:
        raise ValueError(f"empty keyword in {', '.join(empty)}")
    return list(dict.fromkeys(entries)) if distinct else entries


def literal_entries(entries: list[tuple[str, str]]) -> Column:
    """The entries as one literal array of ``struct<category, keyword>``."""
    return F.array(
        *[F.struct(F.lit(category).alias("category"), F.lit(word).alias("keyword")) for category, word in entries]
    )


def tag_keywords(sentence: Column, lexicon: Lexicon, distinct: bool = False) -> Column:
    """Array of ``struct<category, keyword>`` for every lexicon entry inside ``sentence``.

    The entries fold to one literal array. The sentence is bound to a lambda variable so that it
    is upper-cased once, not once per entry.
    """
    entries = literal_entries(lexicon_entries(lexicon, distinct))
    hits = F.transform(
        F.array(F.upper(sentence)),
        lambda upper: F.filter(entries, lambda entry: F.contains(upper, entry["keyword"])),
    )
    return F.element_at(hits, 1)


def matches_any(text: Column, keywords: Column) -> Column:
    """True when ``text`` holds at least one word of the array ``keywords``."""
    return F.exists(keywords, lambda word: F.contains(text, word))
