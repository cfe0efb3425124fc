"""Rendered alert and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts of an alert and of a report line.
ALERT_TEXT = ":eyes: 소셜 트랜드 이상징후 발견"
ALERT_HEADER = ":rotating_light: *조회 집계 경고* :rotating_light:"
ALERT_COLOR = "#ff0000"
ALERT_BODY = (
    "*🕒 기준 시간:* %s\n\n🚗 *Car:* `%s`\n\n🏆 *Category:* `%s`\n\n"
    "📈 *Change:* `%s`\n\n🔢 *Total:* `%s`\n\n"
)
REPORT_LINE = "*%s*\n시도: `%s건` | 성공: `%s건` | %s 성공률: `%.1f%%`"
REPORT_HEADER = "📊 데이터 수집 리포트"
REPORT_SCHEDULE, REPORT_RUN, REPORT_COUNTS = "*📅 논리적 스케줄링 정보*", "*⏱️ 실행 시간 정보*", "*🌐 커뮤니티별 수집 현황*"
REPORT_DATE, REPORT_TIME, REPORT_BATCH = "*Logical Date:*\n%s", "*Logical Time:*\n%s", "*Batch:*\n#%s"
REPORT_START, REPORT_ELAPSED = "*시작 시간:*\n%s", "*소요 시간:*\n%s"
REPORT_FOOTER = "💡 상세 내역은 대시보드를 참고해주세요"
BAND_MARKS = {"red": "🔴", "yellow": "🟡", "green": "🟢"}


def _section(kind: str, **parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), *[value.alias(name) for name, value in parts.items()])


def alert_payload(now: Column, footer: str | None = None) -> Column:
    """One JSON message per alert row (``car_id, category, view_change, total_view``).

    The closing note is left out where there is none.
    """
    body = F.format_string(
        ALERT_BODY,
        F.substring(now.cast("string"), 1, 19),
        F.col("car_id"), F.col("category"),
        F.col("view_change").cast("string"), F.col("total_view").cast("string"),
    )
    text = F.struct(F.lit("mrkdwn").alias("type"), body.alias("text"))
    title = F.struct(F.lit("plain_text").alias("type"), F.lit(ALERT_HEADER).alias("text"), F.lit(True).alias("emoji"))
    # blocks of one array share a type; absent parts stay null and are left out of the JSON
    none_title, none_fields = F.lit(None).cast("struct<type:string,text:string,emoji:boolean>"), F.array().cast(
        "array<struct<type:string,text:string>>"
    )
    empty = F.nullif(none_fields, none_fields)
    note = F.struct(F.lit("mrkdwn").alias("type"), F.lit(footer).alias("text"))
    closing = [_section("context", text=none_title, fields=empty, elements=F.array(note))] if footer else []
    blocks = F.array(
        _section("header", text=title, fields=empty, elements=empty),
        _section("divider", text=none_title, fields=empty, elements=empty),
        _section("section", text=none_title, fields=F.array(text), elements=empty),
        *closing,
    )
    attachment = F.struct(F.lit(ALERT_COLOR).alias("color"), blocks.alias("blocks"))
    return F.to_json(F.struct(F.lit(ALERT_TEXT).alias("text"), F.array(attachment).alias("attachments")))


def community_line(community: Column, attempted: Column, extracted: Column, rate: Column, band: Column) -> Column:
    """The report line of one community."""
    mark = F.lit(None).cast("string")
    for name, sign in BAND_MARKS.items():
        mark = F.when(band == name, sign).otherwise(mark)
    return F.format_string(
        REPORT_LINE,
        F.upper(community), F.format_number(attempted, 0), F.format_number(extracted, 0), mark, rate,
    )


_BLOCK = "struct<type:string,text:struct<type:string,text:string,emoji:boolean>,fields:array<struct<type:string,text:string>>,elements:array<struct<type:string,text:string>>>"


def _marked(text: Column) -> Column:
    return F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))


def _block(kind: str, text: Column | None = None, fields: list[Column] | None = None, elements: list[Column] | None = None, plain: bool = False) -> Column:
    """One block of a message; what is absent stays null and is left out of the JSON."""
    none = F.lit(None)
    shown = none if text is None else F.struct(
        F.lit("plain_text" if plain else "mrkdwn").alias("type"), text.alias("text"), F.lit(True if plain else None).cast("boolean").alias("emoji"))
    parts = [F.lit(kind).alias("type"), shown.alias("text")]
    for name, texts in (("fields", fields), ("elements", elements)):
        parts.append((F.array(*[_marked(t) for t in texts]) if texts else none).alias(name))
    return F.struct(*parts).cast(_BLOCK)


def report_payload(date: Column, time: Column, batch: Column, started: Column, elapsed: Column, lines: Column, footer: str | None = None) -> Column:
    """The report of an extraction run as one JSON message: its schedule, its times, and the ``lines`` of all communities."""
    schedule = [F.format_string(form, value.cast("string")) for form, value in ((REPORT_DATE, date), (REPORT_TIME, time), (REPORT_BATCH, batch))]
    times = [F.format_string(REPORT_START, F.substring(started.cast("string"), 1, 19)), F.format_string(REPORT_ELAPSED, elapsed)]
    head = F.array(
        _block("header", F.lit(REPORT_HEADER), plain=True),
        _block("divider"),
        _block("section", F.lit(REPORT_SCHEDULE), fields=schedule),
        _block("section", F.lit(REPORT_RUN), fields=times),
        _block("section", F.lit(REPORT_COUNTS)),
    )
    closing = [_block("divider"), *([_block("context", elements=[F.lit(footer)])] if footer else [])]
    return F.to_json(F.struct(F.concat(head, F.transform(lines, lambda line: _block("section", line)), F.array(*closing)).alias("blocks")))
