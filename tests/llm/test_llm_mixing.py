from collections import Counter, defaultdict

import pytest
from llm_helpers import word_list

from forumlens.llm import mixing


def targets(sizes):
    """Shares by weight, stopping at twice a source, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        share = rest / (sum(weight[s] for s in names if s not in full) or 1)
        over = {s for s in names if s not in full and share * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else share * weight[s] for s in names}
        full |= over


def checked(frame):
    rows = frame.collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    longest = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    expect = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expect[r.source])
        assert r.taken == r.copies * r["size"] and r.copies in (0, 1, 2)
        epochs = int(r.target // r.source_size) if r.source_size else 0
        assert r["size"] == 0 or r.copies in (epochs, epochs + 1)
    for source in sizes:
        assert abs(taken[source] - expect[source]) <= longest[source] / 2 + 1e-6
    return rows


def sample(n=400):
    texts = ["word " * (1 + (i * 7919) % 60) for i in range(n)]
    sources = ["big"] * (n // 3) + [f"s{i % 9}" for i in range(n - n // 3)]
    return [(i, texts[i], "en", sources[i]) for i in range(n)]


def test_taken_words_meet_the_targets(documents):
    frame = documents(*sample())
    rows = checked(mixing.mix(frame))
    again = mixing.mix(frame.repartition(5))
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again.collect())


def test_nulls_empty_texts_repeats_and_long_texts(documents):
    rows = [(i, f"w{i} x y z", "en", None) for i in range(30)] + [(100, None, "en", "a"), (101, "", "en", "a"), (102, " \n", "en", "empty")]
    rows += [(None, "null id here", "en", "b"), (5, "word " * 100_000, "en", "long"), (6, "a b c", "en", "long")] + [(7, "twin words", "en", "b")] * 4
    found = checked(mixing.mix(documents(*rows)))
    assert len(found) == len(rows)
    assert {r["size"] for r in found if r.doc_id in (100, 101, 102)} == {0}
    assert next(r["size"] for r in found if r.doc_id == 5 and r.source == "long") == 100_000


def test_a_rest_that_ends_among_equal_rows_takes_some_of_them(documents):
    rows = [(1, "four words are here", "en", "a")] * 375 + [(i, f"word {i}", "en", "b") for i in range(2, 40)] + [(None, "no id " * 3, "en", None)] * 60
    frame = documents(*rows)
    found = checked(mixing.mix(frame))
    assert len({r.copies for r in found if r.source == "a"}) == 2
    decided = Counter()
    for r in found:
        decided[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixing.mixed(frame).collect()) == +decided
    again = mixing.mix(frame.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in found) == Counter((r.doc_id, r.taken) for r in again)


def test_sizes_follow_the_word_rule(documents):
    texts = ["a b c", "x\x0by\x0cz", "\x1f", "é è", "tab\tnew\nline"]
    found = mixing.mix(documents(*[(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r["size"] for r in found} == {i: len(word_list(t)) for i, t in enumerate(texts)}


def test_the_mix_repeats_rows_and_keeps_their_columns(written):
    schema = "doc_id long, text string, source string, size string, key string, epochs string, cell string, last string"
    rows = [(i, "word " * (1 + i % 11), f"s{i % 4}", "S", "K", "E", "C", "L") for i in range(80)]
    frame = written(rows, schema)
    decided = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in decided.items() if v})


def test_empty_tables_and_tables_without_words(documents):
    assert mixing.mix(documents(files=1).where("doc_id = 0")).count() == 0
    rows = mixing.mix(documents((1, None, "en", "a"), (2, "", "en", "b"))).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


def test_better_documents_come_first_more_often(documents):
    plain, odd = "sound words here today " * 5, f"{'x' * 40} " * 20
    rows = [(i, plain if i % 2 else odd, "en", "s") for i in range(2000)] + [(9999, "word " * 60_000, "en", "a")]
    found = [r for r in mixing.mix(documents(*rows)).collect() if r.source == "s"]
    extra = max(r.copies for r in found)
    chosen = Counter(r.doc_id % 2 for r in found if r.copies == extra)
    assert len(chosen) == 2 and chosen[1] > 1.3 * chosen[0]
