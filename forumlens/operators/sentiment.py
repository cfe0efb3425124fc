"""Batched sentiment scoring with an injected scorer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.operators.posts import conform

# Sentences of a request, tries, and the base of the waits between them in seconds.
BATCH_SIZE = 20
MAX_TRIES = 10
BACK_OFF = 1.5

Scorer = Callable[[list[str]], list[int]]
# Builds, once per task, a scorer of up to BATCH_SIZE sentences.
ScorerFactory = Callable[[], Scorer]


class RateLimited(Exception):
    """Raised by a scorer that wants the same batch again later."""


def score_batch(score: Scorer, sentences: list[str], wait: Callable[[float], None] = time.sleep) -> list[int] | None:
    """Scores of one batch, or None when the scorer failed or answered with the wrong count."""
    for attempt in range(MAX_TRIES):
        try:
            scores = list(score(sentences))
        except RateLimited:
            wait(BACK_OFF**attempt)
            continue
        except Exception:  # no answer at all included
            return None
        return scores if len(scores) == len(sentences) and None not in scores else None
    return None


def sentiment_column(factory: ScorerFactory, sentence: Column) -> Column:
    """``struct<sentiment, scored>``; a batch that could not be scored is neutral and not scored."""

    @F.pandas_udf("struct<sentiment:int, scored:boolean>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for sentences in batches:
            values, scored = [], []
            texts = sentences.fillna("").tolist()
            for start in range(0, len(texts), BATCH_SIZE):
                chunk = texts[start : start + BATCH_SIZE]
                answer = score_batch(scorer, chunk)
                values += answer if answer is not None else [0] * len(chunk)
                scored += [answer is not None] * len(chunk)
            yield pd.DataFrame({"sentiment": values, "scored": scored})

    return score(sentence)


def score_sentiment(sentences: DataFrame, factory: ScorerFactory, keep_flag: bool = False) -> DataFrame:
    """Sentence rows with their sentiment in the output schema."""
    conform(sentences, schemas.SENTENCE)
    rated = sentences.withColumn("_rated", sentiment_column(factory, F.col("sentence")))
    flat = rated.select(*[f.name for f in schemas.SENTENCE], "_rated.sentiment", "_rated.scored")
    out = conform(flat, schemas.SENTENCE_SENTIMENT)
    return flat.select(*out.columns, "scored") if keep_flag else out


def word_scorer(positive: list[str], negative: list[str]) -> ScorerFactory:
    """A scorer for tests and dry runs: the sign of positive minus negative words found."""

    def factory() -> Scorer:
        def score(sentences: list[str]) -> list[int]:
            marks = []
            for sentence in sentences:
                good = sum(word in sentence for word in positive)
                bad = sum(word in sentence for word in negative)
                marks.append((good > bad) - (good < bad))
            return marks

        return score

    return factory


def sentiment_counts(scored: DataFrame) -> DataFrame:
    """Sentences per sentiment."""
    return scored.groupBy("sentiment").agg(F.count(F.lit(1)).alias("sentences"))


# Fixed value: how one sentence appears in a scoring request.
REQUEST_LINE = '%d번째 문장 >> "%s"'


def numbered_lines(sentences: Column) -> Column:
    """The sentences of one scoring request as numbered lines."""
    lines = F.transform(sentences, lambda s, i: F.format_string(REQUEST_LINE, i + 1, s))
    return F.array_join(lines, "\n")
