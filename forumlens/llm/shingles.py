"""Words and word shingles of many texts as numbers, whole texts, in bounded memory."""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20  # bytes hashed at once
WORDS_EACH = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _power(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < length:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [
            np.cumprod(np.concatenate((np.uint64([1]), np.full(max(length, SEGMENT) - 1, b)))) for b in (_BASE, inverse)
        ]
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in bytes that no word continues before or after."""
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    first, end = edge[::2], edge[1::2]
    power, inverse = _power(len(data) + 1)
    sums = np.concatenate((np.uint64([0]), np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power[: len(data)])))
    return mixed((sums[end] - sums[first]) * inverse[first]), first


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's begin (one more than texts).

    A-Z are lower-cased; words are runs of anything but the six ASCII white space characters.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
    hashes, firsts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):  # not inside a word
            gap = np.flatnonzero(_BLANK[data[end : end + SEGMENT]])
            end = end + gap[0] if len(gap) else min(end + SEGMENT, len(data))
            if len(gap):
                break
        found, first = _hash_words(data[at:end])
        hashes.append(found)
        firsts.append(first + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), begins)


def shingle_sets(texts: list[str | None], each: int = WORDS_EACH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts in a row, sorted within a text, and where each text's begin.

    A text of fewer words is one shingle as a whole; one without words has none.
    """
    hashes, begins = words(texts)
    counts = np.diff(begins)
    text_of = np.repeat(np.arange(len(texts)), counts)
    odd = [mixed(np.uint64([k + 1]))[0] | np.uint64(1) for k in range(each)]
    full = np.zeros(0, np.uint64)
    if len(hashes) >= each:
        many = len(hashes) - each + 1
        full = sum((hashes[k : k + many] * odd[k] for k in range(1, each)), hashes[:many] * odd[0])
        inside = text_of[:many] == text_of[each - 1 :]
        full, text_of = mixed(full[inside]), text_of[:many][inside]
    else:
        text_of = text_of[:0]
    edges = np.searchsorted(text_of, np.arange(len(texts) + 1))
    sets = []
    for i, count in enumerate(counts):
        if count >= each:
            sets.append(np.unique(full[edges[i] : edges[i + 1]]))
        elif count:
            own = hashes[begins[i] : begins[i + 1]]
            sets.append(mixed(np.uint64([sum(int(h) * int(o) for h, o in zip(own, odd)) + int(count) & (1 << 64) - 1])))
        else:
            sets.append(full[:0])
    lengths = [len(s) for s in sets]
    return np.concatenate(sets) if sets else full, np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
