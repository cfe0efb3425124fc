"""Saved pages to raw posts, comments and links.

A layout says where the fields stand; the helper only cuts their raw texts out of the page, and
typing, dating and filtering are Spark expressions on its output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions import html
from forumlens.functions.dates import iso_text
from forumlens.functions.fields import last_segment, resolve_href
from forumlens.functions.text import normalize_text


@dataclass(frozen=True)
class CommentLayout:
    """Selectors of one comment relative to its row; ``id`` is an attribute of the row or of ``id_at``."""

    row: str
    content: str
    created_at: str
    id_attribute: str = "id"
    id_at: str = ""
    upvotes: str = ""
    downvotes: str = ""
    reply_class: str = "re"
    reply_rows: str = ""
    # rows with one of these classes, or with an element at `deleted`, are not comments
    drop_classes: tuple[str, ...] = ()
    deleted: str = ""


@dataclass(frozen=True)
class PageLayout:
    """Selectors of a post page: field name to path and position among its matches, and its comments."""

    fields: dict[str, str | tuple[str, int]] = field(default_factory=lambda: {"title": "h1", "content": "article"})
    comments: CommentLayout | None = None


# Where the three page layouts keep their fields.
STACKED = PageLayout(
    {
        "title": ("div.content_view h3.post_subject span", 1),
        "created_at": "div.content_view span.view_count.date",
        "content": "div.content_view div.post_article",
        "view_count": "div.content_view .view_count strong",
        "upvote_count": "div.content_view a.symph_count strong",
        "comment_count": "div.content_view a.post_reply",
    },
    CommentLayout(
        row="div.comment_row", content="div.comment_view", created_at="span.timestamp",
        id_attribute="data-comment-sn", upvotes="button.comment_symph", drop_classes=("blocked",),
    ),
)
PROFILE = PageLayout(
    {
        "title": ".writerProfile dt strong",
        "created_at": ".writerProfile .countGroup",
        "content": ".bodyCont",
        "view_count": (".writerProfile .countGroup .txtType", 0),
        "upvote_count": (".writerProfile .countGroup .txtType", 1),
        "comment_count": ".writerProfile dt strong em",
    },
    CommentLayout(
        row="ul.basiclist#cmt_reply li", content="dd", created_at="dt .date", id_at="dd",
        upvotes=".updownbox .first", downvotes=".updownbox .last",
    ),
)
GALLERY = PageLayout(
    {
        "title": "span.title_subject",
        "content": "div.write_div",
        "view_count": "span.gall_count",
        "upvote_count": "p.up_num.font_red",
        "downvote_count": "p.down_num",
        "comment_count": "span.gall_comment a",
    },
    CommentLayout(
        row="ul.cmt_list li", content="p.usertxt.ub-word", created_at="span.date_time",
        reply_rows="ul.cmt_list ul.reply_list li.ub-content", drop_classes=("dory",), deleted="p.del_reply",
    ),
)

_COMMENT = "struct<comment_id:string,content:string,is_reply:boolean,created_at:string,upvotes:string,downvotes:string,dropped:boolean>"


def _text(element, where: str | tuple[str, int]) -> str | None:
    path, position = (where, 0) if isinstance(where, str) else where
    found = html.select(element, path) if path else []
    return html.text_of(found[position]) if len(found) > position else None


def _comment(row, layout: CommentLayout, replies: set[int]) -> tuple:
    """The values of ``_COMMENT``."""
    classes = row.get("class", "").split()
    holder = html.select(row, layout.id_at)[:1] if layout.id_at else [row]
    return (
        holder[0].get(layout.id_attribute) if holder else None,
        _text(row, layout.content),
        layout.reply_class in classes or id(row) in replies,
        _text(row, layout.created_at),
        _text(row, layout.upvotes),
        _text(row, layout.downvotes),
        any(c in classes for c in layout.drop_classes) or bool(layout.deleted and html.select(row, layout.deleted)),
    )


def _comments(page, layout: CommentLayout) -> list[tuple]:
    inner = html.select(page, layout.reply_rows) if layout.reply_rows else []
    replies = {id(row) for row in inner}
    return [_comment(row, layout, replies) for row in html.select(page, layout.row)]


def page_fields(pages: DataFrame, layout: PageLayout, html_column: str = "html") -> DataFrame:
    """Every page with ``fields`` (map of raw texts) and ``comments`` (K3, K4).

    A page at a time; a page that cannot be parsed gives null fields. Rows are pickled, a hundred at once: Arrow would hold
    thousands of pages in each worker, as texts and as trees' texts, whatever their length.
    """
    names = list(layout.fields)
    texts = "".join(f"{name}:string," for name in names)
    schema = f"struct<{texts}comments:array<{_COMMENT}>,parsed:boolean>"

    @F.udf(schema, useArrow=False)
    def cut(text: str | None) -> tuple:
        if not text:
            return (*[None] * len(names), [], False)
        page = html.parse(text)
        fields = [_text(page, where) for where in layout.fields.values()]
        return (*fields, _comments(page, layout.comments) if layout.comments else [], True)

    return pages.withColumn("page", cut(F.col(html_column))).select(*pages.columns, "page.*")


def keep_comments(comments: Column) -> Column:
    """Comments that are neither blocked, advertised nor deleted and that carry text."""
    return F.filter(
        comments, lambda c: ~c["dropped"] & c["comment_id"].isNotNull() & c["content"].isNotNull()
    )


def typed_comments(comments: Column, parse_date) -> Column:
    """Raw comment texts to the comment type of the raw post document."""
    return F.transform(
        keep_comments(comments),
        lambda c: F.named_struct(
            F.lit("comment_id"), F.regexp_extract(c["comment_id"], r"(\d+)\D*$", 1).try_cast("long"),
            F.lit("content"), F.coalesce(normalize_text(c["content"]), F.lit("")),
            F.lit("is_reply"), c["is_reply"].cast("string"),
            F.lit("created_at"), iso_text(parse_date(c["created_at"])),
            F.lit("upvote_count"), F.regexp_extract(c["upvotes"], r"(\d+)\s*$", 1).try_cast("int"),
            F.lit("downvote_count"), F.regexp_extract(c["downvotes"], r"(\d+)\s*$", 1).try_cast("int"),
        ),
    )


def page_links(pages: DataFrame, base: Column | None = None, html_column: str = "html") -> DataFrame:
    """One row per distinct link of a page: ``page_id, url, link_id``.

    ``base`` is the site root of relative links, by default the one of the page's own URL. Links are
    those of the parsed page, in whatever way their attributes are written.
    """
    root = base if base is not None else F.regexp_extract("url", r"^https?://[^/]+", 0)

    @F.udf("array<string>", useArrow=False)  # a hundred pages at once, as in page_fields
    def hrefs(text: str | None) -> list[str]:
        return [a.get("href") for a in html.select(html.parse(text or ""), "a") if a.get("href")]

    found = pages.select("page_id", root.alias("root"), F.explode(F.array_distinct(hrefs(F.col(html_column)))).alias("href"))
    url = resolve_href(F.col("href"), F.col("root"))
    return found.select("page_id", url.alias("url"), last_segment(F.col("href")).alias("link_id"))


@dataclass(frozen=True)
class ListingLayout:
    """Selectors of a listing page: its rows, and link and date inside a row.

    With ``date_attribute`` the date is that attribute of the element, else its text.
    """

    row: str
    link: str
    date: str
    date_attribute: str = ""


# Where the three listing layouts keep link and date.
STACKED_LIST = ListingLayout("div.list_item.symph_row", "a.subject_fixed", "span.timestamp")
PROFILE_LIST = ListingLayout(".search_Community ul li", "dt a", ".path span")
GALLERY_LIST = ListingLayout("tr.ub-content.us-post", "td.gall_tit.ub-word a", "td.gall_date", "title")


def _row(row, layout: ListingLayout) -> dict:
    links, dates = html.select(row, layout.link), html.select(row, layout.date)
    date = dates[-1] if dates else None
    if date is not None:
        date = date.get(layout.date_attribute) if layout.date_attribute else html.text_of(date)
    return {"href": links[0].get("href") if links else None, "date": date}


def listing_function(layout: ListingLayout):
    """The rows of a listing page (``href``, ``date``) as a table function over its ``html`` (K5).

    For ``lateralJoin``, or under a name for SQL: ``spark.udtf.register("listed", listing_function(GALLERY_LIST))``,
    then ``FROM pages, LATERAL listed(html)``. A page goes in and its rows come out as they are found.
    """

    @F.udtf(returnType="href string, date string", useArrow=True)
    class Listing:
        def eval(self, text: str):
            for row in html.select(html.parse(text or ""), layout.row):
                found = _row(row, layout)
                yield found["href"], found["date"]

    return Listing


def listing_rows(
    pages: DataFrame,
    layout: ListingLayout,
    base: str,
    link_id: Callable[[Column], Column],
    posted: Callable[[Column], Column],
    start: Column,
    end: Column,
) -> DataFrame:
    """``id, url, date`` of the posts on listing pages inside the inclusive range, one per id.

    ``link_id`` and ``posted`` turn the URL and the date text into their values.
    """

    listed = listing_function(layout)
    rows = pages.lateralJoin(listed(F.col("html").outer())).select(F.struct("href", "date").alias("row")).where("row.href IS NOT NULL")
    url = resolve_href(F.col("row.href"), F.lit(base))
    found = rows.select(link_id(url).alias("id"), url.alias("url"), posted(F.col("row.date")).alias("date"))
    inside = found.where(F.col("date").between(start, end))
    return inside.groupBy("id").agg(F.min(F.struct("url", "date")).alias("_row")).select("id", "_row.*")
