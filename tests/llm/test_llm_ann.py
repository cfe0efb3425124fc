import math
import random
from collections import Counter

import numpy as np
from llm_helpers import SF

from forumlens.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    lengths = Counter(len(v) for _, v in ok)
    wide = max(lengths, key=lambda n: (lengths[n], n), default=0)
    ok = [(i, np.array(v, float)) for i, v in ok if len(v) == wide]
    asking = {}
    for i, v in ok:
        asking[i] = min(asking.get(i, v), v, key=tuple)
    out = {}
    for i, v in asking.items():
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in ok if j != i)
            out[i] = near[:k]
    return out


def found(frame, **options):
    out = {}
    for r in sorted(ann.search(frame, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def vectors(n, wide, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, wide)).astype(np.float32))]


def test_all_rows_are_looked_at_in_a_small_table(written):
    rows = vectors(700, 6)
    got, want = found(written([(i, v, 0) for i, v in rows], SCHEMA)), brute(rows)
    assert {q: [j for _, j in near] for q, near in got.items()} == {q: [j for _, j in near] for q, near in want.items()}
    assert all(math.isclose(a, b, rel_tol=1e-12) for q in want for (a, _), (b, _) in zip(got[q], want[q]))


def test_vectors_that_take_no_part(written):
    odd = [(100, None), (200, []), (300, [0.0, 0.0]), (400, [1.0, None]), (500, [float("nan"), 1.0]), (600, [1.0, float("inf")]), (700, [1.0]), (None, [1.0, 1.0])]
    rows = odd + [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0])]
    got = found(written([(i, v, None) for i, v in rows], SCHEMA))
    assert {q: [j for _, j in near] for q, near in got.items()} == {0: [1, 2]}


def test_one_longer_vector_and_repeated_queries(written):
    rows = vectors(300, 5) + [(7777, [1.0] * 6), (7800, [1.0] * 6)]
    rows += [rows[0]] * 3 + [rows[7]] * 2 + [(100, [0.5, -0.5, 0.25, 1.0, 2.0])]
    got, want = found(written([(i, v, 0) for i, v in rows], SCHEMA)), brute(rows)
    assert set(got) == {0, 100, 200} and all(len(near) == 10 for near in got.values())
    assert {q: [j for _, j in near] for q, near in got.items()} == {q: [j for _, j in near] for q, near in want.items()}


def test_ties_copies_and_one_hot_cell(written, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 2)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(900)] + [(900 + i, v) for i, (_, v) in enumerate(vectors(300, 4))]
    rng = random.Random(0)
    rng.shuffle(rows)
    got, want = found(written([(i, v, 0) for i, v in rows], SCHEMA, 4), share=1.0), brute(rows)
    assert {q: [j for _, j in near] for q, near in got.items()} == {q: [j for _, j in near] for q, near in want.items()}


def test_few_rows_empty_tables_and_clashing_columns(written, spark):
    schema = "vec_id long, embedding array<float>, first string, second string, block string, vector string"
    frame = written([(0, [1.0, 1.0], *"abcd"), (1, [2.0, 1.0], *"abcd")], schema)
    assert found(frame) == {0: [(1.0, 1)]}
    assert ann.search(frame.where("vec_id > 5")).count() == 0
    assert ann.search(frame.where("vec_id = 0")).count() == 0


def test_cells_are_walked_in_the_order_of_summed_distances():
    rng = np.random.default_rng(3)
    first, second = rng.random(7), rng.random(5)
    held = rng.integers(0, 4, (7, 5))
    sums = (first[:, None] + second).ravel()
    order = [divmod(int(c), 5) for c in sums.argsort(kind="stable") if held.ravel()[c]]
    for wanted in (1, 10, 30, held.sum()):
        taken, n = [], 0
        for i, j in order:
            if n >= wanted:
                break
            taken.append((i, j))
            n += held[i, j]
        cells = ann.walk(first, second, held, wanted)
        assert sorted((i, j) for i, js in cells.items() for j in js) == sorted(taken)


def test_recall_on_vectors_that_point_anywhere(written):
    rows = vectors(6000, 64)
    frame = written([(i, v, 0) for i, v in rows], SCHEMA, 4)
    got, want = found(frame), brute(rows)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in near}) for q, near in want.items())
    assert hits / (10 * len(want)) >= 0.9


def test_recall_on_the_given_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    got, want = found(frame), brute(rows)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in near}) for q, near in want.items())
    assert set(got) == set(want) and hits / (10 * len(want)) >= 0.9
