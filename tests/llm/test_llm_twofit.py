import collections
import random
import zlib

import numpy as np
import pytest
from llm_helpers import SF, sf_exists

import __spark_entry__ as entry
from forumlens.llm import packing, twofit

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def by_hand(lengths, window):
    """Best two fit on single pieces, every pair tried."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        room, inside = window, []
        for length in list(left):
            if length <= room:
                room -= length
                inside.append(length)
                left.remove(length)
        if room and len(inside) > 1:
            least = min(inside)
            pairs = [(a + b, a, b) for n, a in enumerate(left) for b in left[n + 1 :] if least < a + b <= room + least]
            if pairs:
                _, a, b = max(pairs)
                inside.remove(least)
                inside += [a, b]
                left.remove(a)
                left.remove(b)
                left = sorted([*left, least], reverse=True)
        out.append(sorted(inside))
    return out


def planned(lengths, window):
    counts = collections.Counter(lengths)
    runs = twofit.plan(dict(counts), window)
    bins = collections.defaultdict(list)
    for rank, length in enumerate(sorted(lengths)):
        at, of, sequence, each, offset = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
        assert of == length
        bins[sequence + (rank - at) // each].append((offset + (rank - at) % each * length, length))
    for inside in bins.values():
        inside.sort()
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))]
    return [sorted(n for _, n in bins[k]) for k in sorted(bins)]


def test_plan_equals_best_two_fit_by_hand():
    for seed in range(150):
        rng = random.Random(seed)
        window = rng.choice([16, 40, 100])
        lengths = [rng.randint(1, rng.choice([window, window // 2, window // 3])) for _ in range(rng.choice([1, 5, 60, 120]))]
        assert planned(lengths, window) == by_hand(lengths, window), seed


def test_two_pieces_replace_the_smallest():
    assert planned([60, 30, 25, 14], 100) == [[14, 25, 60], [30]]


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    counts = collections.Counter(min(1024, max(1, int(rng.lognormvariate(5.5, 1)))) for _ in range(200_000))
    small, large = twofit.plan(dict(counts)), twofit.plan({n: c * 10_000 for n, c in counts.items()})
    assert len(large) < 2 * len(small)
    total = sum(n * c for n, c in counts.items())
    assert small[:, 2].max() + 1 <= packing.plan(dict(counts))[:, 2].max() + 1
    assert (small[:, 2].max() + 1) * 1024 < total * 1.0005 + 1024


def check(rows, got, tokenizer, window=1024):
    """Pieces hold every id once, in order and place; only long documents are cut, first piece shortest."""
    ids = sorted((tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in rows))
    want = collections.Counter()
    for doc, text in rows:
        whole = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(whole) - 1) % window + 1
        for nth, end in enumerate(range(first, len(whole) + 1, window)):
            start = max(end - window, 0)
            want[doc, nth, start, end - start, zlib.crc32(whole[start:end].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want and ids is not None
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(map(sorted, ([n for _, n in b] for b in bins.values()))) == sorted(by_hand([r.length for r in got], window))


def test_nulls_empties_long_texts_repeats_and_added_tokens(documents, tokenizer):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(6))
    rows = [(1, None), (2, ""), (3, "  two  spaces "), (None, "no id"), (4, "x" + " ab" * 5000), (5, "a<|endoftext|>b"), (6, " ab" * 1023), (7, " ab" * 1024)]
    rows += [(8, "same text"), (8, "same text")] + [(n, " ".join(word() for _ in range(rng.randint(1, 300)))) for n in range(10, 60)]
    frame = documents(*rows)
    check(rows, twofit.digests(frame, added=packing.ADDED).collect(), tokenizer)
    sequences = twofit.sequences(frame, added=packing.ADDED).collect()
    assert sum(len(s.ids) // 4 for s in sequences) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    for s in sequences:
        for p in s.pieces:
            text = next(t for d, t in rows if d == p.doc_id)
            whole = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            assert s.ids[4 * p.offset : 4 * (p.offset + p.length)] == whole[p.start : p.start + p.length].tobytes()


def test_empty_tables_and_clashing_columns(spark, documents, written, tokenizer):
    assert twofit.digests(documents(files=1).where("doc_id = 0")).count() == 0
    frame = written([(1, "one text", 5, "a", 7, "b")], "doc_id long, text string, length long, ids string, _rank long, piece string")
    check([(1, "one text")], twofit.digests(frame).collect(), tokenizer)


@pytest.mark.skipif(not sf_exists(), reason="no test tables")
def test_query_equals_best_two_fit(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, entry.queries()["op11_pack_two_fit"](spark, SF).collect(), tokenizer)
