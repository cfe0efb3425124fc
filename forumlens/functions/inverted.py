"""Tagging against a long lexicon: the text is looked up in the lexicon, not each entry in the text.

Keywords are kept by length and hash. Every substring of a text of those lengths is hashed by one running sum over
the text and looked up among the keywords of its length, and what is found is compared by its characters. The work
grows with the text and the number of different lengths, not with the number of entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from forumlens.functions.lexicon import Lexicon, lexicon_entries

SEGMENT = 1 << 18  # characters hashed at once
_BITS = 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


class InvertedLexicon:
    """The entries of a lexicon by length and hash; built once per task."""

    def __init__(self, lexicon: Lexicon, distinct: bool = False):
        self.entries = lexicon_entries(lexicon, distinct)
        words = sorted({word for _, word in self.entries})
        self.at = {word: n for n, word in enumerate(words)}
        held = [[] for _ in words]
        for n, (_, word) in enumerate(self.entries):
            held[self.at[word]].append(n)
        #: for each word the numbers of its entries, end to end
        self.starts = np.cumsum([0] + [len(h) for h in held])
        self.numbers = np.array([n for h in held for n in h], np.int64)
        self.longest = max(map(len, words), default=0)
        self.lengths: dict[int, tuple[np.ndarray, ...]] = {}
        many = SEGMENT + self.longest + 1
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(many, np.uint64(_BASE)))))
            self.inverses = np.cumprod(np.concatenate(([np.uint64(1)], np.full(many, np.uint64(pow(_BASE, -1, 1 << 64))))))
        for length in sorted({len(w) for w in words}):
            of = [w for w in words if len(w) == length]
            codes = _codes("".join(of)).reshape(len(of), length)
            hashes = (codes.astype(np.uint64) * self.powers[:length]).sum(1, dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << _BITS, bool)  # most substrings end here
            seen[hashes >> np.uint64(64 - _BITS)] = True
            self.lengths[length] = (seen, hashes[order], codes[order], np.array([self.at[w] for w in of], np.int64)[order])

    def find(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, entry) for every entry inside a text, once, in the order of texts and entries."""
        begins = np.cumsum([0] + [len(t) if t else 0 for t in texts])
        codes = _codes("".join(t for t in texts if t))
        found = [np.zeros(0, np.int64)]
        for at in range(0, len(codes), SEGMENT):
            part = codes[at : at + SEGMENT + self.longest - 1]  # matches that begin in this segment
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part.astype(np.uint64) * self.powers[: len(part)], dtype=np.uint64)))
            for length, (seen, hashes, held, words) in self.lengths.items():
                many = min(len(part) - length + 1, SEGMENT)
                if many <= 0:
                    continue
                here = (sums[length : length + many] - sums[:many]) * self.inverses[:many]
                hit = np.flatnonzero(seen[here >> np.uint64(64 - _BITS)])
                here = here[hit]
                low = np.searchsorted(hashes, here)
                while len(hit):  # of equal hashes every word is compared
                    equal = hashes[np.minimum(low, len(hashes) - 1)] == here
                    equal &= low < len(hashes)
                    hit, here, low = hit[equal], here[equal], low[equal]
                    same = (part[hit[:, None] + np.arange(length)] == held[low]).all(1)
                    start = at + hit[same]
                    text = np.searchsorted(begins, start, "right") - 1
                    inside = start + length <= begins[text + 1]
                    found.append((text * len(self.at) + words[low[same]])[inside])
                    low = low + 1
        pairs = np.unique(np.concatenate(found))
        texts_of, words_of = np.divmod(pairs, max(len(self.at), 1))
        times = self.starts[words_of + 1] - self.starts[words_of]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        text = np.repeat(texts_of, times)
        entry = self.numbers[np.repeat(self.starts[words_of], times) + within]
        order = np.lexsort((entry, text))
        return text[order], entry[order]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def tagger(lexicon: Lexicon, distinct: bool = False):
    """Arrow batches of (id, upper-cased text) to (id, category, keyword)."""
    lexicon_entries(lexicon, distinct)  # a lexicon that is refused fails on the driver

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inverted = InvertedLexicon(lexicon, distinct)
        categories, keywords = (pa.array(column, pa.string()) for column in (zip(*inverted.entries) if inverted.entries else ((), ())))
        for batch in batches:
            text, entry = inverted.find(batch.column(1).to_pylist())
            ids, entries = batch.column(0).take(pa.array(text)), pa.array(entry)
            yield pa.RecordBatch.from_arrays([ids, categories.take(entries), keywords.take(entries)], ["sentence_id", "category", "keyword"])

    return tag
