"""Typed fields out of page text and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entity_id(community: Column, kind: str, number: Column) -> Column:
    """``{community}_{kind}_{number}``."""
    return F.concat(community, F.lit(f"_{kind}_"), number.cast("string"))


def query_id(url: Column, parameter: str = "No") -> Column:
    """Integer value of a URL parameter."""
    return F.regexp_extract(url, rf"{parameter}=([^&]+)", 1).try_cast("long")


def resolve_href(href: Column, base: Column) -> Column:
    """Absolute link of an href that may be relative to the site root, or to the scheme only."""
    scheme = F.split_part(base, F.lit("//"), F.lit(1))
    slash = F.when(href.startswith("/"), "").otherwise("/")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .otherwise(F.concat(base, slash, href))
    )


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def last_segment(url: Column) -> Column:
    """Last path segment before the query."""
    return F.split_part(strip_query(url), F.lit("/"), F.lit(-1))


def grouped_number(text: Column) -> Column:
    """``1,234`` to 1234, blank to null."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("int")


def bracketed_count(text: Column) -> Column:
    """``[5]`` to 5, anything else to 0."""
    return F.coalesce(F.btrim(text, F.lit("[]")).try_cast("int"), F.lit(0))


def labelled_count(text: Column) -> Column:
    """The number that ends a label such as ``views 433``."""
    return F.regexp_extract(text, r"(\d+)\s*$", 1).try_cast("int")


def first_number(text: Column) -> Column:
    """First run of digits."""
    return F.regexp_extract(text, r"\d+", 0).try_cast("long")


def before_bracket(text: Column) -> Column:
    """Title without its trailing ``[n]``."""
    return F.trim(F.split_part(text, F.lit("["), F.lit(1)))


def last_field(text: Column, separator: str = "|") -> Column:
    """Last of the separated fields, trimmed."""
    return F.trim(F.split_part(text, F.lit(separator), F.lit(-1)))


def to_flag(text: Column) -> Column:
    """0/1 or false/true to a boolean."""
    return text.try_cast("boolean")
