import collections
import random
import re
import zlib

import pytest
from llm_helpers import SF, sf_exists

import __spark_entry__ as entry
from forumlens.llm import spelling


def counted(rows):
    """Words of all texts and how often they occur."""
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain(n):
    """Form, root, count, near words and the form's count of each word, every pair compared that lies within a letter in length."""
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if one_apart(w, x)] for w in n}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def result(frame, **options):
    rows = spelling.variants(frame, **options).collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def corpus(seed):
    """Texts of a few frequent words and their misspellings."""
    rng = random.Random(seed)
    letters = "abcdeilnorstüéßÀÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(25)]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 30, 300])
        for _ in range(rng.randint(0, 12)):
            k, c = rng.randrange(len(w)), rng.choice(letters)
            other = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            words += [other] * rng.choice([1, 2, 3, 30])
    rng.shuffle(words)
    return [(i, rng.choice([" ", "-", ", "]).join(w.title() if rng.random() < 0.1 else w for w in words[i::40])) for i in range(40)]


@pytest.mark.parametrize("node", [spelling.NODE, 20, 3])
def test_variants_equal_brute_force_at_any_node_size(documents, node):
    rows = corpus(1)
    got = result(documents(*rows), node=node)
    want = plain(counted(rows))
    assert got == want
    assert sum(w[0] is not None for w in want.values()) > 20


def test_anagrams_and_repeated_letters(documents):
    words = ["abababab", "babababa", "aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "abcdefg", "abcdegf", "gbcdefa", "aabcdefg", "abcdeef", "quuuuux", "àbcdefg", "ábcdefg"]
    rows = [(i, " ".join(words)) for i in range(3)]
    assert result(documents(*rows)) == plain(counted(rows))


def test_nulls_empties_long_runs_ties_and_repeats(documents):
    long = "ab" * 40_000
    rows = [(1, None), (2, ""), (None, "another another anothex"), (3, f"{long} {long}x {long} {long}x"), (4, "Another ANOTHER anotherq ÄNOTHER"), (4, "Another ANOTHER anotherq ÄNOTHER")]
    rows += [(5, "tiedone " * 30 + "tiedtwo " * 30 + "tied÷wo×fine " * 3)]
    rows += [(n, "tiedowo tiedoneq") for n in (6, 7)]
    assert result(documents(*rows)) == plain(counted(rows))


def test_empty_tables_and_clashing_columns(documents, written):
    assert result(documents(files=1).where("doc_id = 0")) == {}
    rows = [(1, "letters letterz letters"), (2, "letters letterz")]
    frame = written([(*r, "a", 1, True, 2) for r in rows], "doc_id long, text string, word string, n long, own boolean, node long")
    assert result(frame) == plain(counted(rows))


def test_chains_of_forms_are_followed_to_their_end(documents):
    n = {"chained": 2, "chainedq": 20, "chainedqr": 200, "chainedqrs": 2000}
    rows = [(0, " ".join(w for w, c in n.items() for _ in range(c)))]
    got = result(documents(*rows))
    assert got == plain(counted(rows))


@pytest.mark.skipif(not sf_exists(), reason="no test tables")
def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op12_spelling_variants"](spark, SF).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(counted(rows))
