"""Masking, cleaning and sentence splitting of post and comment text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and replacements that decide the cleaned text.
URL = (r"https?://\S+", "<URL>")
HANDLE = (r"(?<=\s|^)@[A-Za-z0-9_가-힣\-]+", "<USER>")
EMAIL = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>")
HANGUL_SENTENCE_END = (r"([가-힣][.?!])(?=[가-힣0-9a-zA-Z])", "$1 ")
LAUGHS = (r"ㅋ{4,}", "ㅋㅋㅋㅋ")
MIN_SENTENCE_LENGTH = 6

# Text without any of these passes the masking rules unchanged; one scan for them is cheaper than
# the rules, whose look-behind and backtracking start at every character.
_MASKABLE = r"[@\xa0]|://|&nbsp;"
# Runs that are not already one space. Matching only those leaves the common case uncopied.
_WHITESPACE_RUN = r"\s\s+|[\t\n\x0B\f\r]"
_SENTENCE_BREAK = r"(?<=[.!?]) +"


def _replace(text: Column, rule: tuple[str, str]) -> Column:
    return F.regexp_replace(text, *rule)


def mask_urls(text: Column) -> Column:
    return _replace(text, URL)


def mask_handles(text: Column) -> Column:
    return _replace(text, HANDLE)


def mask_emails(text: Column) -> Column:
    return _replace(text, EMAIL)


def drop_no_break_space(text: Column) -> Column:
    """Remove the entity and the character, joining the words around them."""
    without_entity = F.replace(text, F.lit("&nbsp;"), F.lit(""))
    return F.replace(without_entity, F.lit("\u00a0"), F.lit(""))


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, _WHITESPACE_RUN, " ")


def space_sentence_ends(text: Column) -> Column:
    """A space between a Hangul sentence end and the text that follows it."""
    return _replace(text, HANGUL_SENTENCE_END)


def cap_laughs(text: Column) -> Column:
    """No more than four in a row."""
    return _replace(text, LAUGHS)


def clean_text(text: Column, strict: bool = False) -> Column:
    """Mask personal data, then tidy whitespace (H9).

    Trimming comes before the whitespace collapse, so text that starts with a newline keeps one
    leading space. ``strict`` removes no-break spaces before masking as well, so an address broken
    by one is still found.
    """
    if strict:
        text = drop_no_break_space(text)
    masked = drop_no_break_space(mask_emails(mask_handles(mask_urls(text))))
    tidy = F.trim(F.when(text.rlike(_MASKABLE), masked).otherwise(text))
    return cap_laughs(space_sentence_ends(collapse_whitespace(tidy)))


def normalize_text(text: Column) -> Column:
    """No-break spaces become spaces, whitespace runs one space, empty text null."""
    spaced = F.regexp_replace(text, " ", " ")
    return F.nullif(F.trim(collapse_whitespace(spaced)), F.lit(""))


def split_sentences(text: Column) -> Column:
    """Array of sentences of one text: a break after ``.``, ``!`` or ``?`` followed by spaces.

    Null or empty text gives an empty array, so it takes no place in the running index.
    """
    pieces = F.transform(F.split(text, _SENTENCE_BREAK), lambda piece: F.trim(piece))
    sentences = F.filter(pieces, lambda piece: F.length(piece) > 0)
    return F.coalesce(sentences, F.array().cast("array<string>"))


def is_long_enough(sentence: Column) -> Column:
    """Sentences under six code points carry no signal."""
    return F.length(sentence) >= MIN_SENTENCE_LENGTH


def is_from_post(title: Column) -> Column:
    """True for every sentence of a row with a title, its body included."""
    return F.coalesce(F.length(title) > 0, F.lit(False))
