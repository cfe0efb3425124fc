"""Line deduplication by site-relative frequency, in DataFrame operations only.

A line is boilerplate of a host when more than a share of the host's pages contain it, and at least some
pages do. Few lines of a host can be: fewer than the lines of an average page over that share, whatever
the number of pages. So they go to the host's pages as one list, and lines are dropped inside each row.

Cases: a null or unparsable URL has the host ``""``; a null ``html`` has no lines. A line that occurs twice on a
page counts once. Rows repeated count as pages each. Only ``page_id``, ``url`` and ``html`` are looked at. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.runtime import materialize

RATIO = (3, 10)  # more than 3 of 10 pages of a host
LEAST_PAGES = 3

HOST = r"^[A-Za-z][-A-Za-z0-9+.]*://(?:[^/?#@]*@)?([^/?#:]+)"
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|"
    r"pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
TAG = r"<[^>]*>"


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def lines(html: Column) -> Column:
    """The text lines of a page: one per block element, white space collapsed, empty ones left out."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    text = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: tuple[int, int] = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and the keys of its boilerplate lines."""
    by_host = pages.select(host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines"))
    totals = materialize(pages.groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("pages")), "line-hosts")
    keys = by_host.select("host", F.explode(F.array_distinct(F.transform("lines", _key))).alias("line"))
    counts = keys.groupBy("host", "line").agg(F.count("*").alias("with_line")).where(F.col("with_line") >= least_pages)
    often = counts.join(totals, "host").where(F.col("with_line") * ratio[1] > F.col("pages") * ratio[0])
    return often.groupBy("host").agg(F.collect_list("line").alias("drop"))


def without_boilerplate(pages: DataFrame, ratio: tuple[int, int] = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``host``, ``n_lines``, ``n_dropped`` and the ``text`` that is left of each page."""
    # written, its size is known: the pages are joined where they are while it is small, else a hot host is split
    found = materialize(boilerplate(pages, ratio, least_pages), "line-boilerplate")
    rows = pages.select("page_id", host(F.col("url")).alias("host"), "html").join(found, "host", "left")
    rows = rows.select("page_id", "host", lines(F.col("html")).alias("lines"), "drop")
    left = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains(F.col("drop"), _key(line)))
    )
    rows = rows.select("page_id", "host", F.size("lines").alias("n_lines"), left.alias("left"))
    return rows.select(
        "page_id", "host", "n_lines", (F.col("n_lines") - F.size("left")).alias("n_dropped"), F.array_join("left", "\n").alias("text")
    )
