"""The registered queries against their SQL, and the pipeline against brute force."""

import re

import numpy as np
import pytest
from llm_helpers import SF, sf_exists, word_list

import __spark_entry__ as entry
import corpus_pipeline
from forumlens.llm import mixing
from forumlens.llm.queries import ENTRIES
from tools.compare import compare, connect

pytestmark = pytest.mark.skipif(not sf_exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF, name).startswith("ok")


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in ENTRIES) == list(range(1, 14)) and set(ENTRIES) <= set(names)


def shingles(text):
    w = word_list(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    roots, sizes = components(texts)
    got = entry.queries()["op3_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (sizes[i], roots[i], roots[i] == i) for i in texts}


def test_repeated_passages_equal_brute_force(spark):
    texts = {r.doc_id: word_list(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    holders = {}
    for doc, w in texts.items():
        for k in range(len(w) - 49):
            holders.setdefault(tuple(w[k : k + 50]), set()).add(doc)
    want = {d: {p for k in range(len(w) - 49) if len(holders[tuple(w[k : k + 50])]) > 1 for p in range(k, k + 50)} for d, w in texts.items()}
    got = {d: set() for d in texts}
    for r in entry.queries()["op10_repeated_passages"](spark, SF).collect():
        got[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
    assert got == want


def test_pipeline_equals_its_stages_by_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in source.collect()}
    kept, seen = {}, set()
    for doc in sorted(docs):
        text = re.sub(r"[\x20\x09-\x0D]+", " ", docs[doc] or "")
        if re.search(r"[^\W\d_]", text) and text not in seen:
            seen.add(text)
            kept[doc] = docs[doc]
    roots, _ = components(kept)
    left = [d for d in kept if roots[d] == d]
    copies = {r.doc_id: r.copies for r in mixing.mix(source.where(source.doc_id.isin(left))).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {d: sum(r.length for r in got if r.doc_id == d) for d in {r.doc_id for r in got}} == {
        r.doc_id: r.doc_tokens * copies[r.doc_id] for r in got
    }
    assert {r.doc_id for r in got} == {d for d, n in copies.items() if n}
    places = np.array([(r.sequence_id, r.offset, r.length) for r in got])
    for sequence in np.unique(places[:, 0]):
        part = places[places[:, 0] == sequence]
        part = part[part[:, 1].argsort()]
        assert (part[:, 1] == np.concatenate(([0], part[:, 2].cumsum()[:-1]))).all() and part[:, 2].sum() <= 1024


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
