import random
from collections import defaultdict

import pytest
from llm_helpers import word_list
from pyspark.sql import functions as F

from forumlens.llm import suffixes
from forumlens.llm.common import locator, probably_in
from forumlens.llm.shingles import words
from forumlens.llm.suffixes import minimisers

LEAST = suffixes.MIN_WORDS


def expected(rows):
    """Covered word positions of each row, by shared runs of LEAST words."""
    held, out = defaultdict(set), []
    lists = [word_list(t) for _, t in rows]
    for n, w in enumerate(lists):
        for k in range(len(w) - LEAST + 1):
            held[tuple(w[k : k + LEAST])].add(n)
    for (doc, _), w in zip(rows, lists):
        at = {p for k in range(len(w) - LEAST + 1) if len(held[tuple(w[k : k + LEAST])]) > 1 for p in range(k, k + LEAST)}
        if at:
            out.append((str(doc), tuple(sorted(at))))
    return sorted(out)


def covered(frame):
    spans = defaultdict(set)
    for r in suffixes.repeated_spans(frame).collect():
        assert r.n_words >= LEAST
        spans[str(r.doc_id)].update(range(r.first_word, r.first_word + r.n_words))
    return sorted((d, tuple(sorted(at))) for d, at in spans.items())


def passages(seed):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = [words(n) for n in (49, 50, 51, 64, 120, 400)]
    rows = []
    for doc in range(70):
        text = words(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(shared) + words(rng.randint(0, 40))
        rows.append((doc, rng.choice([" ", "\n", "  "]).join(text)))
    return rows


def test_spans_equal_brute_force(documents):
    rows = passages(1) + [(1000 + i, t) for i, (_, t) in enumerate(passages(1)[:5])]
    assert covered(documents(*rows, files=4)) == expected(rows)


def test_neighbours_over_the_ends_of_tasks(spark, documents):
    rows = passages(2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        assert covered(documents(*rows, files=4)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_batches(spark, documents):
    rows = passages(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert covered(documents(*rows, files=2)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_passage_that_most_rows_share_hides_none(documents):
    rng = random.Random(5)
    common = " ".join(f"c{i}" for i in range(60))
    pair = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{i} {common} " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(30))) for i in range(150)]
    rows += [(200, f"{common} {pair} end"), (201, f"start {common} {pair} x")]
    assert covered(documents(*rows, files=4)) == expected(rows)


def test_repeats_inside_one_text_are_no_match(documents):
    once = " ".join(f"w{i}" for i in range(80))
    assert covered(documents((1, f"{once} {once} {once}"), (2, "other words"))) == []
    rows = [(1, f"{once} {once} {once}"), (2, f"x {once}")]
    assert covered(documents(*rows)) == expected(rows)


def test_nulls_empties_long_texts_repeats_and_empty_tables(written, documents):
    long = " ".join(f"w{i % 7001}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " "), (4, long), (5, "short"), (6, "y " * 30_000), (7, long.upper())]
    assert covered(documents(*rows)) == expected(rows)
    same = " ".join(f"s{i}" for i in range(70))
    assert len(suffixes.repeated_spans(documents((9, same), (9, same), (None, same))).collect()) == 3
    assert suffixes.repeated_spans(documents(files=1).where("doc_id = 0")).count() == 0
    frame = written([(1, same, *"abcd"), (2, same, *"abcd")], "doc_id long, text string, row string, key string, at string, file string")
    assert suffixes.repeated_spans(frame).count() == 2


def test_best_partner_is_no_neighbour_on_either_side(documents):
    """A and B share 50 words around their only minimiser; others share more on one side, but too little in all."""
    rng = random.Random(8)
    draw = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    stream = draw(50_000)
    hashes, _ = words([" ".join(stream)])
    best = int(minimisers(hashes, suffixes.GRAM)[1].argmin())
    core = stream[best : best + suffixes.GRAM]  # so low that it is the minimiser of every window around it
    before, after = draw(21), draw(21)
    a = (draw(21) + before, after + draw(21))
    docs = [a[0] + core + a[1], draw(21) + before + core + after + draw(21)]
    for _ in range(30):
        docs += [draw(42) + core + a[1][:25] + draw(17), draw(17) + a[0][-25:] + core + draw(42)]
    for w in docs[:2]:
        assert list(minimisers(words([" ".join(w)])[0])[0]) == [42]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    want = expected(rows)
    assert [d for d, _ in want] == ["0", "1"]
    assert covered(documents(*rows)) == want


@pytest.mark.parametrize("chosen", [0, 1, 40, 5000])
def test_rows_are_chosen_without_a_join_of_all(spark, chosen):
    """All that are asked for, and few others; several maps of bits, negative hashes and null keys among them."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("a"), F.concat(F.lit("f"), "id").alias("b"), "id")
    found = {r.id for r in probably_in(rows, rows.where(F.col("id") < chosen), ["a", "b"]).select("id").collect()}
    assert found >= set(range(chosen)) and len(found) <= chosen + 60_000 / 15


def test_texts_of_rows_without_suffixes_are_not_moved(spark, documents, capsys):
    """With the joins held from broadcasting, the texts that are shuffled are those with suffixes to compare and few others."""
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(10**7)}" for _ in range(n))
    shared = text(60)
    docs = documents(*[(i, text(60)) for i in range(1500)], *[(5000 + i, f"{text(9)} {shared} {text(9)}") for i in range(12)], files=3)
    wanted = suffixes.shared_suffixes(docs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = suffixes.texts_of(docs, wanted)
        places = {(r.file, r.nth) for r in docs.where("doc_id >= 5000").select(*locator("file", "nth")).collect()}
        found = {(r.file, r.nth) for r in moved.collect()}
        assert places <= found and len(found) < 200
        suffixes.suffixes(docs, LEAST, wanted).explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
