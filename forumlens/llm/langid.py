"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over hashed character n-grams is fitted on
a bounded sample of labelled rows; a text's bits are decoded to the codeword with the least loss, each bit
weighted by how well its classifier does on that language. Two codewords at nearly the same loss make a
text ambiguous.

Cases: a text that is null or holds no letter is ``und`` with score 0 and not ambiguous. With no labelled
rows every text is ``und``; with one language every text with a letter has that language. A null ``doc_id`` is
never learned from and not held out. Rows repeated get equal results; equal losses go to the language first
in order. ``lang``, ``source`` and ``doc_id`` are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLE_ROWS = 2000  # labelled rows that are fitted on, at most, dealt evenly over the languages
BUCKETS = 4096  # of hashed n-grams
LONGEST = 3  # n-gram
ROUNDS, RATE, PENALTY = 120, 4.0, 1e-4  # of the logistic fits
SHARPNESS = 4.0  # of the score over losses
AMBIGUOUS = 0.1  # a text is flagged when the best score leads the next by less
TIE = 0.01  # and belongs to no language when it leads by less than this
ROWS = 256  # texts whose counts are held at once

_letter: list[np.ndarray] = []


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letter[0]


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of the lower-cased letters of a whole text, other characters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[points]
    if not letter.any():
        return None
    spaced = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character after a letter
    gram = np.concatenate((np.uint32([32]), spaced[keep]))
    total = np.zeros(BUCKETS)
    code = np.zeros(len(gram), np.uint32)
    for n in range(1, LONGEST + 1):
        code = code[: len(gram) - n + 1] * np.uint32(0x01000193) + gram[n - 1 :]
        bucket = ((code + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        total += np.bincount(bucket, minlength=BUCKETS)
    return total


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of log counts and a constant, and which texts have a letter."""
    rows, known = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        found = counts(text) if text else None
        if found is not None:
            rows[i], known[i] = found, True
    rows = np.log1p(rows)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return np.concatenate((rows, np.ones((len(texts), 1), np.float32)), axis=1), known


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: every split of up to five, else the best of random codes."""
    if languages <= 5:
        bits = max(2 ** (languages - 1) - 1, 1)
        code = [[1] * bits] + [[-1 if (b + 1) >> i & 1 else 1 for b in range(bits)] for i in range(languages - 1)]
        return np.array(code[:languages], np.float32)
    bits = int(np.ceil(10 * np.log2(languages)))
    draws = (np.where(np.random.default_rng(seed).random((languages, bits)) < 0.5, 1, -1) for seed in range(100))

    def least(code: np.ndarray) -> float:
        apart = (bits - code @ code.T) / 2 + bits * np.eye(languages)
        return float(apart.min()) - bits * (np.abs(code.sum(axis=0)) == languages).any()

    return max(draws, key=least).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # language, bit
    weights: np.ndarray  # feature, bit
    trust: np.ndarray  # language, bit: how well a bit's classifier does on a language

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its score and its lead over the next."""
        margin = rows @ self.weights
        loss = np.stack([(np.logaddexp(0, -margin * word) * trust).sum(axis=1) for word, trust in zip(self.code, self.trust)], axis=1)
        share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        ordered = np.sort(share, axis=1)
        lead = ordered[:, -1] - ordered[:, -2] if share.shape[1] > 1 else ordered[:, -1]
        return best, ordered[:, -1].astype(float), lead


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """Up to ``rows`` labelled texts, evenly over the languages, those with the smallest hash of their id.

    Rows are numbered, not ids: of an id that is repeated as many texts are taken as have a place, and no more
    than ``rows`` texts reach the driver however often an id occurs.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # the hash of the text lets any scan order the rows of an id alike
    labelled = labelled.select("doc_id", "lang", "text", F.xxhash64("text").alias("digest"))
    languages = labelled.agg(F.count_distinct("lang")).first()[0]
    if not languages:
        return []
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "digest")
    chosen = labelled.select("doc_id", "lang", "digest", F.row_number().over(order).alias("nth")).where(F.col("nth") <= max(rows // languages, 1))
    chosen = chosen.groupBy("lang", "doc_id", "digest").agg(F.count("*").alias("places"))
    # at most ``rows`` rows, so they are broadcast to the scan of the texts; repeated rows shrink to one before they move
    texts = labelled.join(F.broadcast(chosen), ["lang", "doc_id", "digest"])
    found = texts.groupBy("lang", "doc_id", "digest", "places").agg(F.min("text").alias("text"))
    return sorted((r["lang"], r["text"]) for r in found.collect() for _ in range(r["places"]))


def fit(labelled: list[tuple[str, str]]) -> Model | None:
    """One logistic regression per bit, by accelerated gradient steps on all rows at once."""
    rows, known = features([text for _, text in labelled])
    labels = [lang for (lang, _), there in zip(labelled, known) if there]
    languages = sorted(set(labels))
    if not languages:
        return None
    rows, at = rows[known], np.array([languages.index(lang) for lang in labels])
    code = codewords(len(languages))
    bits = code[at]
    each = np.bincount(at)[at]
    share = (1.0 / (each * len(languages)))[:, None].astype(np.float32)  # languages count alike
    weights = moved = np.zeros((rows.shape[1], code.shape[1]), np.float32)
    for step in range(ROUNDS):
        slope = rows.T @ (-bits * share / (1 + np.exp(bits * (rows @ moved)))) + PENALTY * moved
        following = moved - RATE * slope
        moved, weights = following + step / (step + 3) * (following - weights), following
    right = (rows @ weights * bits > 0).astype(float)
    trust = np.stack([right[at == i].mean(axis=0) + 1e-3 for i in range(len(languages))])
    return Model(languages, code, weights, trust / trust.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: Model | None, least_lead: float = AMBIGUOUS) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` in place of ``text``, whole texts at a time."""
    others = [c for c in docs.columns if c != "text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*others).schema)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                best = np.full(len(texts), -1)
                score, lead = np.zeros(len(texts)), np.ones(len(texts))
                if model:
                    rows, known = features(texts)
                    if known.any():
                        best[known], score[known], lead[known] = model.decode(rows[known])
                names = [model.languages[i] if i >= 0 else UNKNOWN for i in best]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(names), pa.array(score), pa.array(lead < least_lead)],
                    [*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"],
                )

    return docs.select(*others, "text").mapInArrow(guess, schema + "lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``ambiguous`` of every document."""
    model = fit(sample(docs, rows))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


def accepted(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without those of no language: null texts, texts without a letter, and ties of two codewords.

    A text that is half in one language and half in another is only flagged, and kept.
    """
    model = fit(sample(docs, rows))
    names = docs.columns
    whole = docs.select(F.struct(*[docs[n] for n in names]).alias("_doc"), "text")
    fields = ", ".join(f"_{i}: {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    guessed = predict(whole.withColumn("_doc", F.col("_doc").cast(f"struct<{fields}>")), model, TIE)
    kept = guessed.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(*[F.col(f"_doc._{i}").alias(n) for i, n in enumerate(names)])
