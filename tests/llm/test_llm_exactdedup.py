import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from forumlens.llm import exactdedup


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for text, docs in groups.items():
        keep = min(docs, key=lambda d: (d is None, d or 0))
        out += [(d, keep, len(docs), hashlib.sha256(text.encode()).hexdigest()) for d in docs]
    return sorted(out, key=str)


ROWS = [
    (5, "a b"), (3, "a  b"), (9, "a\n\tb"), (4, "a b "), (7, None), (8, ""), (6, " "), (2, "\x0b\x0c"), (1, "x" * 300_000),
    (10, "x" * 300_000), (None, "a b"), (11, "a b"), (12, "é"), (13, "é"),
]


def got(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in frame.collect()), key=str)


def test_groups_nulls_blanks_and_long_texts(documents):
    frame = exactdedup.classes(documents(*ROWS, files=4))
    assert got(frame) == expected(ROWS)
    kept = {r.doc_id for r in frame.where("kept").collect()}
    assert kept == {3, 4, 7, 2, 1, 11, 12, 13}


def test_state_goes_on_over_several_batches(documents):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    assert got(exactdedup.classes(documents(*rows, files=6), files_per_trigger=1)) == expected(rows)


def test_colliding_digests_are_told_apart_by_their_bytes(documents):
    rows = [(i, f"text {i % 23}") for i in range(120)]
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    found = exactdedup.classes(documents(*rows, files=4), digest=weak)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found.collect()} == {(a, b, c) for a, b, c, _ in expected(rows)}
    assert found.where("kept").count() == 23


def test_repeated_rows_keep_one(documents):
    frame = documents(*[(1, "same")] * 5, (2, "same"), files=3)
    assert exactdedup.classes(frame).where("kept").count() == 1
    assert exactdedup.first_of_each(frame).count() == 1


def test_empty_table_and_clashing_columns(written, documents):
    assert exactdedup.classes(documents(files=1).where("doc_id = 0")).count() == 0
    schema = "doc_id long, text string, digest string, kept string, file string, row string, keep string, group_size string"
    frame = written([(1, "a", "d", "k", "f", "r", "p", "g"), (2, "a", "d", "k", "f", "r", "p", "g")], schema)
    left = exactdedup.first_of_each(frame)
    assert left.columns == frame.columns and [tuple(r)[0] for r in left.collect()] == [1]


def test_a_large_group_is_compared_in_parts(documents):
    rows = [(i, "copy of one") for i in range(3 * exactdedup.SALT_ROWS)]
    assert got(exactdedup.classes(documents(*rows, files=3))) == expected(rows)
