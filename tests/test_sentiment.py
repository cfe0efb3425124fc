from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forumlens.operators import sentiment as K

COLUMNS = "id string, source_id string, from_post boolean, sentence string, created_at timestamp_ntz"


def frame(spark, sentences):
    rows = [(f"s_{i}", "s", True, text, datetime(2025, 2, 10)) for i, text in enumerate(sentences)]
    return spark.createDataFrame(rows, COLUMNS).coalesce(1)


def test_retries_back_off_then_give_up():
    waits, calls = [], []

    def limited(texts):
        calls.append(texts)
        raise K.RateLimited()

    assert K.score_batch(limited, ["a"], waits.append) is None
    assert len(calls) == 10 and waits == [1.5**n for n in range(10)]


def test_retry_succeeds_later():
    calls = []

    def second(texts):
        calls.append(1)
        if len(calls) == 1:
            raise K.RateLimited()
        return [1] * len(texts)

    assert K.score_batch(second, ["a", "b"], lambda s: None) == [1, 1]


def test_wrong_count_and_errors_are_neutral():
    assert K.score_batch(lambda texts: [1], ["a", "b"]) is None
    assert K.score_batch(lambda texts: 1 / 0, ["a"]) is None


def test_batches_of_twenty(spark):
    def factory():
        return lambda texts: [len(texts)] * len(texts) if len(texts) == 20 else [0]

    got = K.score_sentiment(frame(spark, ["x"] * 45), factory, keep_flag=True).collect()
    assert [r.sentiment for r in got] == [20] * 40 + [0] * 5
    assert [r.scored for r in got] == [True] * 40 + [False] * 5


def test_output_schema_and_required_column(spark):
    df = frame(spark, ["good day", "bad day", "good bad", None])
    out = K.score_sentiment(df, K.word_scorer(["good"], ["bad"]))
    assert out.columns == ["id", "source_id", "from_post", "sentence", "created_at", "sentiment"]
    assert dict(out.dtypes)["sentiment"] == "int"
    assert [r.sentiment for r in out.collect()] == [1, -1, 0, 0]
    assert out.collect()[3].sentence is None
    with pytest.raises(ValueError, match="sentence"):
        K.score_sentiment(df.drop("sentence"), K.word_scorer([], []))
    assert sorted(map(tuple, K.sentiment_counts(out).collect())) == [(-1, 1), (0, 2), (1, 1)]


def test_request_lines(column):
    lines = column(K.numbered_lines, ["a", "b"], schema="t array<string>")
    assert lines == ['1번째 문장 >> "a"\n2번째 문장 >> "b"']
    assert F is not None
