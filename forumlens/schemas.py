"""The table contract: one explicit ``StructType`` per table.

Timestamps are ``TIMESTAMP_NTZ``: the sources carry naive local time.
"""

from pyspark.sql import types as T

_S, _I, _B, _TS = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


# `post_id` and `is_reply` arrive as text in one source and as numbers in another, so both are
# read as text and cast afterwards.
RAW_COMMENT = _struct(
    ("comment_id", T.LongType()),
    ("content", _S),
    ("is_reply", _S),
    ("created_at", _S),
    ("upvote_count", _I),
    ("downvote_count", _I),
)
RAW_POST = _struct(
    ("post_id", _S),
    ("post_url", _S),
    ("title", _S),
    ("content", _S),
    ("created_at", _S),
    ("view_count", _I),
    ("upvote_count", _I),
    ("downvote_count", _I),
    ("comment_count", _I),
    ("comments", T.ArrayType(RAW_COMMENT)),
)

POST_STATIC = _struct(
    ("id", _S, False), ("url", _S, False), ("title", _S, False), ("content", _S, False),
    ("created_at", _TS, False),
)
POST_DYNAMIC = _struct(
    ("id", _S, False), ("extracted_at", _TS, False), ("view_count", _I), ("upvote_count", _I),
    ("downvote_count", _I), ("comment_count", _I),
)
COMMENT_STATIC = _struct(
    ("id", _S, False), ("post_id", _S, False), ("content", _S, False), ("is_reply", _B, False),
    ("created_at", _TS, False),
)
COMMENT_DYNAMIC = _struct(
    ("id", _S, False), ("extracted_at", _TS, False), ("upvote_count", _I), ("downvote_count", _I),
)
POST_CAR = _struct(("post_id", _S, False), ("car_id", _S, False))

SENTENCE = _struct(
    ("id", _S), ("source_id", _S), ("from_post", _B), ("sentence", _S), ("created_at", _TS),
)
SENTENCE_SENTIMENT = _struct(*[(f.name, f.dataType) for f in SENTENCE], ("sentiment", _I))
KEYWORD_CATEGORY = _struct(("sentence_id", _S), ("category", _S), ("keyword", _S))
V_POST_DYNAMIC = _struct(
    ("id", _S), ("extracted_at", _TS), ("v_view_count", _I), ("v_upvote_count", _I),
    ("v_downvote_count", _I), ("v_comment_count", _I),
)
V_COMMENT_DYNAMIC = _struct(
    ("id", _S), ("extracted_at", _TS), ("v_upvote_count", _I), ("v_downvote_count", _I),
)
_D = T.DoubleType()
TREND = _struct(
    ("batch_time", _TS), ("car_id", _S), ("category", _S), ("total_view", _D), ("total_comment", _D),
    ("total_upvote", _D), ("total_downvote", _D),
)

POST_CATEGORY = _struct(("post_id", _S), ("category", _S))

EXTRACTION_BODY = _struct(
    ("success", _B), ("error", _S), ("attempted_posts_count", T.LongType()),
    ("extracted_posts_count", T.LongType()),
)

# How a table is loaded: its columns and, for upserts, its key. No key means append.
LOAD_KEYS = {
    "post_static": (POST_STATIC, ()),
    "comment_static": (COMMENT_STATIC, ()),
    "sentence": (SENTENCE_SENTIMENT, ()),
    "keyword_category": (KEYWORD_CATEGORY, ()),
    "post_car": (POST_CAR, ("post_id", "car_id")),
    "post_dynamic": (POST_DYNAMIC, ("id", "extracted_at")),
    "comment_dynamic": (COMMENT_DYNAMIC, ("id", "extracted_at")),
    "v_post_dynamic": (V_POST_DYNAMIC, ("id", "extracted_at")),
    "v_comment_dynamic": (V_COMMENT_DYNAMIC, ("id", "extracted_at")),
}
