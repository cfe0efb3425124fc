import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF

from forumlens.llm import langid

WORDS = {"aa": "lorem ipsum dolor sit amet", "bb": "zwei drei größer über schön", "cc": "pätkä hyvä yötä kissa", "dd": "çok güzel ağaç kırmızı", "ee": "wąż łódź gęś ćma",
         "ff": "ñandú niño cigüeña español", "gg": "кошка собака дерево дом"}


def corpus(langs, each=40, seed=2):
    rng = random.Random(seed)
    rows = [(rng.randrange(10**6), " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(3, 40))), lang, "s") for lang in langs for _ in range(each)]
    return list({r[0]: r for r in rows}.values())


def out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2


@pytest.mark.parametrize("langs", ["aa bb", "aa bb cc dd", "aa bb cc dd ee ff gg"])
def test_held_out_texts_are_recognised(documents, langs):
    rows = corpus(langs.split())
    truth = {r[0]: r[2] for r in rows}
    found = langid.identify(documents(*rows)).collect()
    assert {r.doc_id for r in found} == set(truth)
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert len(held) > 5 and np.mean(held) > 0.97


def test_the_sample_is_bounded_in_rows_however_often_an_id_occurs(documents):
    rows = corpus(["aa", "bb"], each=20) + [(4, f"lorem {i % 7}", "aa", "s") for i in range(3000)]
    assert not out(4)
    got = langid.sample(documents(*rows), rows=30)
    assert len(got) <= 30 and {lang for lang, _ in got} == {"aa", "bb"}
    everything = langid.sample(documents(*rows), rows=10**6)
    assert Counter(everything) == Counter((r[2], r[1]) for r in rows if not out(r[0]))


def test_no_letter_null_long_and_unlabelled_texts(documents):
    rows = corpus(["aa", "bb"]) + [(-1, None, "aa", "s"), (-2, "", "aa", "s"), (-3, "123 ½ Ⅷ ! \n", "bb", "s"), (-4, "lorem ipsum " * 50_000, None, None), (None, "drei größer", "aa", None)]
    found = {r.doc_id: r for r in langid.identify(documents(*rows)).collect()}
    assert [(found[i].lang_pred, found[i].score) for i in (-1, -2, -3)] == [("und", 0.0)] * 3
    assert found[-4].lang_pred == "aa" and found[None].lang_pred == "bb" and not found[None].held_out


def test_held_out_labels_do_not_matter(documents):
    rows = corpus(["aa", "bb"])
    wrong = [(i, t, "zz" if out(i) else lang, "other") for i, t, lang, _ in rows]
    first, second = (sorted(map(tuple, langid.identify(documents(*r)).collect())) for r in (rows, wrong))
    assert first == second


def test_no_labels_one_language_and_empty_table(documents):
    bare = [(i, t, None, s) for i, t, _, s in corpus(["aa"])]
    assert {r.lang_pred for r in langid.identify(documents(*bare)).collect()} == {"und"}
    assert {r.lang_pred for r in langid.identify(documents(*corpus(["aa"]))).collect()} == {"aa"}
    assert langid.identify(documents(files=1).where("doc_id = 0")).count() == 0


def test_codewords_differ(documents):
    for languages in (2, 3, 4, 5, 6, 9, 40):
        code = langid.codewords(languages)
        apart = (code.shape[1] - code @ code.T) / 2
        assert (apart[~np.eye(languages, dtype=bool)] >= max(1, code.shape[1] / 5)).all()


def test_a_tie_of_codewords_is_ambiguous(documents):
    rows = corpus(["aa", "bb"]) + [(-9, "lorem größer dolor schön", None, None)]
    model = langid.fit(langid.sample(documents(*rows)))
    half = (langid.features(["lorem ipsum dolor sit"])[0] + langid.features(["zwei drei größer über"])[0]) / 2
    _, score, lead = model.decode(np.concatenate((half, langid.features(["lorem ipsum dolor"])[0])))
    assert lead[0] < lead[1] and score[0] < score[1]


def test_accepted_keeps_columns_and_drops_texts_of_no_language(written):
    rows = [(i, t, lang, s, "D", 0.5) for i, t, lang, s in corpus(["aa", "bb"])]
    frame = written(rows + [(-1, "12 34", "aa", "s", "D", 0.5), (-2, None, "aa", "s", "D", 0.5)], "doc_id long, text string, lang string, source string, lang_pred string, score double")
    left = langid.accepted(frame)
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows}


def test_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
