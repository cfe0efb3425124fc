from datetime import datetime

from pyspark.sql import functions as F

from forumlens.functions import dates, fields, html
from forumlens.plans import jobs
from forumlens.sources import pages

STACKED = """<div class="content_view"><h3 class="post_subject"><span class="category">c</span><span>New  car</span></h3>
<span class="view_count date">2025-02-10 08:25:00 edited</span><span class="view_count"><strong>1,234</strong></span>
<a class="symph_count"><strong>7</strong></a><a class="post_reply">2</a>
<div class="post_article">First&nbsp;line<br>second <script>x()</script> end</div>
<div class="comment_row" data-comment-sn="11"><span class="timestamp">2025-02-10 09:00:00 / edited</span><button class="comment_symph">3</button><div class="comment_view"> a  b </div></div>
<div class="comment_row re" data-comment-sn="12"><span class="timestamp">2025-02-10 10:00:00</span><button class="comment_symph">0</button><div class="comment_view">reply</div></div>
<div class="comment_row blocked" data-comment-sn="13"><div class="comment_view">hidden</div></div></div>"""

PROFILE = """<div class="writerProfile"><dl><dt><strong>Great car <em>[5]</em></strong></dt><dd><p class="countGroup">
<em class="txtType">433</em> | <em class="txtType">12</em> | 2025.02.10 (월) 08:25</p></dd></dl></div><div class="bodyCont"> Body </div>
<ul class="basiclist" id="cmt_reply"><li><dl><dt><span class="date">25.02.10 09:10</span></dt><dd id="small_cmt_21">first</dd></dl>
<div class="updownbox"><a class="first">추천 2</a><a class="last">반대 3</a></div></li>
<li class="re"><dl><dt><span class="date">25.02.10 09:20</span></dt><dd id="small_cmt_22">answer</dd></dl></li><li>no header</li></ul>"""

GALLERY = """<span class="title_subject">Subject</span><span class="gall_count">조회 55</span><p class="up_num font_red">4</p>
<p class="down_num">1</p><span class="gall_comment"><a>댓글 3</a></span><div class="write_div">Text</div>
<ul class="cmt_list"><li class="ub-content" id="comment_li_31"><p class="usertxt ub-word">top</p><span class="date_time">02.10 10:00:00</span></li>
<li class="ub-content dory" id="comment_li_32"><p class="usertxt ub-word">ad</p></li>
<li class="ub-content" id="comment_li_33"><p class="del_reply">deleted</p></li>
<li><div class="reply_box"><ul class="reply_list" id="reply_list_31"><li class="ub-content" id="reply_li_34"><p class="usertxt ub-word">inner</p><span class="date_time">2025.02.10 11:00:00</span></li></ul></div></li></ul>"""


def extract(spark, html_text, layout, parse, **extra):
    saved = spark.createDataFrame([(1, "https://x/1", html_text)], "post_id long, url string, html string")
    saved = saved.withColumns({k: F.lit(v) for k, v in extra.items()})
    return jobs.extract_pages(saved, layout, parse).first()


def two_words(c):
    return dates.first_two_words(c).try_cast("timestamp_ntz")


def comments(row):
    return [(c.comment_id, c.content, c.is_reply, c.created_at, c.upvote_count, c.downvote_count) for c in row.comments]


def test_stacked_page(spark):
    row = extract(spark, STACKED, pages.STACKED, two_words)
    assert (row.title, row.content, row.created_at) == ("New  car", "First linesecond end", "2025-02-10T08:25:00")
    assert (row.view_count, row.upvote_count, row.downvote_count, row.comment_count) == (1234, 7, None, 2)
    assert comments(row) == [
        (11, "a b", "false", "2025-02-10T09:00:00", 3, None), (12, "reply", "true", "2025-02-10T10:00:00", 0, None),
    ]


def test_profile_page(spark):
    row = extract(spark, PROFILE, pages.PROFILE, lambda c: dates.parse_dotted(fields.last_field(c)))
    assert (row.title, row.content, row.created_at) == ("Great car", "Body", "2025-02-10T08:25:00")
    assert (row.view_count, row.upvote_count, row.comment_count) == (433, 12, 5)
    assert comments(row) == [
        (21, "first", "false", "2025-02-10T09:10:00", 2, 3), (22, "answer", "true", "2025-02-10T09:20:00", None, None),
    ]


def test_gallery_page(spark):
    batch = F.lit("2025-02-11 00:00:00").cast("timestamp_ntz")

    def parse(c):
        return F.coalesce(dates.parse_month_day(c, batch), c.try_cast("timestamp_ntz"))

    row = extract(spark, GALLERY, pages.GALLERY, parse, created_at="2025-02-10 07:00:00")
    assert (row.title, row.content, row.created_at) == ("Subject", "Text", "2025-02-10T07:00:00")
    assert (row.view_count, row.upvote_count, row.downvote_count, row.comment_count) == (55, 4, 1, 3)
    # an inner reply keeps its own id
    assert comments(row) == [
        (31, "top", "false", "2025-02-10T10:00:00", None, None), (34, "inner", "true", "2025-02-10T11:00:00", None, None),
    ]


def test_pages_outside_the_range_are_left_out(spark):
    saved = spark.createDataFrame([(1, "u", STACKED), (2, "u", None)], "post_id long, url string, html string")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2025-02-11 00:00:00", "2025-02-12 00:00:00"))
    assert jobs.extract_pages(saved, pages.STACKED, two_words, start, end).count() == 0
    assert jobs.extract_pages(saved, pages.STACKED, two_words).count() == 1


def test_listing_rows(spark):
    body = """<table><tr class="ub-content us-post"><td class="gall_date" title="2025-02-10 08:00:00">08:00</td><td class="gall_tit ub-word"><a href="/view?No=5&p=1">t</a></td></tr>
    <tr class="ub-content us-post"><td class="gall_date" title="2025-02-10 08:00:00">08:00</td><td class="gall_tit ub-word"><a href="/view?No=5&p=1">t</a></td></tr>
    <tr class="ub-content us-post"><td class="gall_date" title="2025-02-12 08:00:00">08:00</td><td class="gall_tit ub-word"><a href="/view?No=6">t</a></td></tr></table>"""
    df = spark.createDataFrame([(body,)], "html string")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2025-02-10 00:00:00", "2025-02-11 00:00:00"))
    got = pages.listing_rows(
        df, pages.GALLERY_LIST, "https://h", fields.query_id, lambda c: c.try_cast("timestamp_ntz"), start, end
    )
    assert list(map(tuple, got.collect())) == [(5, "https://h/view?No=5&p=1", datetime(2025, 2, 10, 8))]


def test_profile_listing(spark):
    body = """<div class="search_Community"><ul><li><dl><dt><a href="/view?code=n&No=77">t</a></dt><dd class="path"><span>board</span><span>25. 02. 10</span></dd></dl></li></ul></div>"""
    df = spark.createDataFrame([(body,)], "html string")
    got = pages.listing_rows(
        df, pages.PROFILE_LIST, "https://h", fields.query_id, dates.parse_short_date, F.lit("2025-02-10"), F.lit("2025-02-10")
    )
    assert list(map(tuple, got.collect())) == [(77, "https://h/view?code=n&No=77", "2025-02-10")]


def test_tree_survives_bad_markup():
    tree = html.parse("<div><p>a<b>b</p>c</b></div></div><p>d")
    assert html.text_of(tree) == "abcd"
    assert [html.text_of(e) for e in html.select(tree, "div p")] == ["ab"]
    deep = html.parse("<b>" * 5000 + "x")
    assert html.text_of(deep) == "x"


def test_links_in_any_writing(spark):
    body = """<a class="x" href='/a?b=1&amp;c=2'>1</a><A HREF=/d>2</A><a href="//o/e">3</a><a>none</a><a href="/d">again</a><!-- <a href="/no"> -->"""
    df = spark.createDataFrame([(1, "https://h/p", body), (2, "https://h/q", None)], "page_id int, url string, html string")
    assert [r.url for r in pages.page_links(df).collect()] == ["https://h/a?b=1&c=2", "https://h/d", "https://o/e"]


def test_listings_as_table_functions(spark):
    """Rows without a link or a date, empty pages and null pages."""
    layouts = {
        "stacked": (pages.STACKED_LIST, '<div class="list_item symph_row"><a class="subject_fixed" href="/1">t</a><span class="timestamp">d1</span></div><div class="list_item symph_row"></div>'),
        "profile": (pages.PROFILE_LIST, '<div class="search_Community"><ul><li><dl><dt><a href="/2">t</a></dt><dd class="path"><span>b</span><span>d2</span></dd></dl></li></ul></div>'),
        "gallery": (pages.GALLERY_LIST, '<tr class="ub-content us-post"><td class="gall_tit ub-word"><a href="/3">t</a></td><td class="gall_date" title="d3">x</td></tr>'),
    }
    got = {}
    for name, (layout, page) in layouts.items():
        spark.udtf.register(f"rows_{name}", pages.listing_function(layout))
        saved = spark.createDataFrame([(1, page), (2, ""), (3, None)], "n int, html string")
        found = spark.sql(f"SELECT p.n, l.href, l.date FROM {{saved}} p, LATERAL rows_{name}(p.html) l", saved=saved)
        got[name] = sorted(map(tuple, found.collect()), key=str)
    assert got == {"stacked": [(1, "/1", "d1"), (1, None, None)], "profile": [(1, "/2", "d2")], "gallery": [(1, "/3", "d3")]}


def test_pages_reach_python_in_small_batches(spark):
    """Not by Arrow, whose batches hold thousands of pages; the fields stay those of each page."""
    saved = spark.range(0, 400, 1, 1).select(
        F.col("id").alias("page_id"), F.lit("https://h/p").alias("url"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("<h1>t"), "id", F.lit("</h1><nav><li><a href='/"), "id", F.lit("'>x</a></li></nav>"))).alias("html"))
    layout = pages.PageLayout({"title": "h1", "none": "h2"}, pages.CommentLayout(row="nav li", content="a", created_at="time", id_attribute="href", id_at="a"))
    cut, links = pages.page_fields(saved, layout), pages.page_links(saved)
    for made in (cut, links):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    for row in cut.collect():
        there = row.page_id % 7 != 0
        assert (row.title, row.none, row.parsed) == (f"t{row.page_id}" if there else None, None, there)
        assert [tuple(c) for c in row.comments] == ([(f"/{row.page_id}", "x", False, None, None, None, False)] if there else [])
    assert links.count() == sum(n % 7 != 0 for n in range(400))
