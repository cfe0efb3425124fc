from datetime import datetime

from forumlens.functions import dates, fields
from pyspark.sql import functions as F


def test_parse_iso(column):
    rows = ["2025-02-10T08:25:00", "2025-02-10T08:25:00Z", "2025-02-10T08:25:00+09:00", "2025-02-10", "bad", None]
    assert column(dates.parse_iso, *rows) == [
        datetime(2025, 2, 10, 8, 25), datetime(2025, 2, 10, 8, 25), datetime(2025, 2, 9, 23, 25),
        datetime(2025, 2, 10), None, None,
    ]


def test_parse_iso_does_not_depend_on_the_session_zone(spark, column):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = ["2025-03-09T02:30:00", "2025-03-09T02:30:00Z", "2025-03-09T02:30:00-05:00"]
        assert column(dates.parse_iso, *rows) == [
            datetime(2025, 3, 9, 2, 30), datetime(2025, 3, 9, 2, 30), datetime(2025, 3, 9, 7, 30),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_dotted(column):
    rows = ["2025.02.10 (월) 08:25", "25.2.10 8:25", "조회 1 2025.02.30 08:25", "none", "12345.02.10 08:25"]
    ok = datetime(2025, 2, 10, 8, 25)
    assert column(dates.parse_dotted, *rows) == [ok, ok, None, None, None]


def test_parse_month_day_crosses_new_year(column):
    batch = F.lit("2025-01-02 00:00:00").cast("timestamp_ntz")
    rows = ["2024.12.31 23:00:00", "12.31 23:00:00", "01.01 10:00:00", "13.01 10:00:00", "soon"]
    assert column(lambda c: dates.parse_month_day(c, batch), *rows) == [
        datetime(2024, 12, 31, 23), datetime(2024, 12, 31, 23), datetime(2025, 1, 1, 10), None, None,
    ]


def test_range_class_is_inclusive(column):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2025-02-01 00:00:00", "2025-02-02 00:00:00"))
    rows = ["2025-02-01 00:00:00", "2025-02-02 00:00:00", "2025-02-02 00:00:01", "2025-01-31 23:59:59", "2025-02-01"]
    assert column(lambda c: dates.range_class(c, start, end), *rows) == ["IN", "IN", "OVER", "UNDER", None]


def test_small_date_forms(column):
    assert column(dates.join_iso, "2025-02-10 08:25:00") == ["2025-02-10T08:25:00"]
    assert column(dates.parse_short_date, "25. 02. 10") == ["2025-02-10"]
    assert column(dates.first_two_words, " 2025-02-10 08:25:00 edited 09:00 ") == ["2025-02-10 08:25:00"]


def test_elapsed_does_not_wrap(column):
    start = F.lit("2025-02-10 23:00:00").cast("timestamp_ntz")
    rows = [datetime(2025, 2, 12, 1, 2, 3), datetime(2025, 2, 10, 23, 0, 0), datetime(2025, 2, 15, 23, 0, 1)]
    assert column(lambda c: dates.elapsed(start, c), *rows, schema="t timestamp_ntz") == ["26:02:03", "00:00:00", "120:00:01"]


def test_batch_number_counts_local_minutes(column):
    assert column(dates.batch_number, datetime(2025, 2, 10, 15, 30), datetime(2025, 2, 10, 14, 59), schema="t timestamp_ntz") == [30, 1439]


def test_months_after_clamps(column):
    rows = [datetime(2025, 1, 31).date()]
    assert column(lambda c: dates.months_after(c, 1), *rows, schema="d date") == [datetime(2025, 2, 28).date()]


def test_urls(column):
    assert column(fields.query_id, "https://x/view?code=1&No=42&bm=1", "https://x/view?No=abc", "https://x/") == [42, None, None]
    assert column(lambda c: fields.resolve_href(c, F.lit("https://h")), "/a?b", "a", "https://o/a") == ["https://h/a?b", "https://h/a", "https://o/a"]
    assert column(fields.last_segment, "/service/board/park/123?od=1", "https://x/7") == ["123", "7"]


def test_counts(column):
    assert column(fields.grouped_number, "1,234", "", None, "7") == [1234, None, None, 7]
    assert column(fields.bracketed_count, "[5]", "[new]", "") == [5, 0, 0]
    assert column(fields.labelled_count, "조회 433", "댓글 3 ", "추천") == [433, 3, None]
    assert column(fields.first_number, "small_cmt_123_4", "none") == [123, None]


def test_titles(column):
    assert column(fields.before_bracket, "New car [5]", "plain") == ["New car", "plain"]
    assert column(fields.last_field, "조회 433 | 추천 0 | 2025.02.10") == ["2025.02.10"]


def test_flags(column):
    assert column(fields.to_flag, "0", "1", "true", "false", None) == [False, True, True, False, None]
