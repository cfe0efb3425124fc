import random

from llm_helpers import word_list

from forumlens.llm import neardup
from forumlens.llm.components import components


def shingles(text):
    w = word_list(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), root) for i, root in roots(links, ids).items()}


def found(frame, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classes_of(frame, **options).collect()}


def variants(rng, base, many, edits):
    out = []
    for _ in range(many):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(1, 80))) for _ in range(120)]
    for _ in range(6):
        texts += variants(rng, [f"w{rng.randrange(5000)}" for _ in range(90)], 25, 8)
    shared = " ".join(f"common{i}" for i in range(30))
    texts += [f"{shared} " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(60)) for _ in range(60)]
    return dict(enumerate(texts))


def test_components_equal_brute_force(documents):
    texts = corpus()
    assert found(documents(*texts.items(), files=4)) == expected(texts)


def test_short_empty_null_and_long_texts(documents):
    texts = {
        1: None, 2: "", 3: " \n\t", 4: "one", 5: "ONE", 6: "one two", 7: "one  Two", 8: "É a b c", 9: "é a b c", 10: "a b c d e", 11: "A b\x0bc d e",
        12: "long word " * 60_000, 13: "x" * 500_000, 14: "a b", 15: "z " * 4, 16: "z z z z",
    }
    assert found(documents(*texts.items())) == expected(texts)


def test_the_threshold_is_met_exactly(documents):
    words = [f"w{i}" for i in range(11)]  # seven shingles
    texts = {1: " ".join(words), 2: " ".join(words[:-1] + ["other"]), 3: " ".join(["else"] + words)}
    assert expected(texts)[2][1] == 1
    assert found(documents(*texts.items())) == expected(texts)


def test_nodes_that_stay_large_are_cut_and_tied_by_pivots(documents, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 8)
    monkeypatch.setattr(neardup, "LEVELS", 2)
    rng = random.Random(4)
    texts = dict(enumerate(variants(rng, [f"w{i}" for i in range(300)], 120, 3)))
    assert found(documents(*texts.items())) == expected(texts)


def test_no_link_is_lost_in_a_node_that_stays_large(documents, monkeypatch):
    """A family whose members share a long template (similarity 0.70 each), with pairs in it at 0.77."""
    monkeypatch.setattr(neardup, "LEAF", 128)
    template = [f"t{i}" for i in range(504)]  # 500 shingles; an own part of k words adds k more
    texts = {}
    for i in range(2400):
        texts[i] = " ".join(template + [f"own{i}x{j}" for j in range(107)])
    for i in range(0, 600, 2):  # the second of a pair shares 46 words of the first's own part
        first = texts[i].split()
        texts[i + 1] = " ".join(first[:550] + [f"own{i + 1}x{j}" for j in range(61)])
    sets = {i: shingles(texts[i]) for i in range(6)}
    assert 0.69 < len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 0.72
    assert 0.75 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.83
    got = found(documents(*texts.items(), files=4))
    assert {i: root for i, (_, root) in got.items()} == {i: i - 1 if i % 2 and i < 600 else i for i in texts}


def test_members_outside_the_largest_component_meet_all_members(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 8)
    deep = spark.createDataFrame([(1, i) for i in range(50)] + [(2, i) for i in range(20)], "node long, row long")
    roots = spark.createDataFrame([(i, 0) for i in range(40)], "node long, root long")
    together = {}
    for r in neardup.across(deep, roots).collect():
        assert r.root == (0 if r["row"] < 40 else r["row"])
        together.setdefault(r.node, set()).add(r["row"])
    met = {(a, b) for rows in together.values() for a in rows for b in rows if a < b}
    assert met >= {(a, b) for a in range(50) for b in range(40, 50) if a < b}
    assert max(map(len, together.values())) < 30  # the node of one component needs no leaf


def test_repeated_rows_null_ids_and_one_of_each(documents):
    rows = [(7, "the same words in this text here")] * 3 + [(None, "the same words in this text here"), (9, "alone stands this other short text"), (None, None), (8, None)]
    frame = documents(*rows)
    got = sorted(f"{r.doc_id} in {r.component_id}" for r in neardup.classes_of(frame).collect())
    assert got == sorted(["7 in 7"] * 3 + ["None in 7", "9 in 9", "None in None", "8 in 8"])
    left = neardup.one_of_each(frame)
    assert sorted(str(r.doc_id) for r in left.collect()) == ["7", "8", "9", "None"] and left.columns == frame.columns


def test_empty_table_and_clashing_columns(written, documents):
    assert neardup.classes_of(documents(files=1).where("doc_id = 0")).count() == 0
    schema = "doc_id long, text string, row string, node string, file string, at string, root string, class string, stays string"
    frame = written([(1, "a b c d e f", *"rnfaocs"), (2, "a b c d e f", *"rnfaocs")], schema)
    left = neardup.one_of_each(frame)
    assert [r.doc_id for r in left.collect()] == [1] and left.columns == frame.columns


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(i, 900 + (i - 899) % 30) for i in range(900, 930)]
    pairs += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    rng.shuffle(pairs)
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == roots([p for p in pairs if p[0] != p[1]], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
