import os
import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forumlens.functions import inverted, lexicon, text
from forumlens.operators import sentences as S
from pyspark.sql import functions as F

MIXED = "hi @kim_이 see https://a.b/c?d=1 mail a.b@c.co&nbsp;x  좋다.그래.맞다 ㅋㅋㅋㅋㅋㅋㅋ  "


def test_clean_text_masks_and_tidies(column):
    assert column(text.clean_text, MIXED) == ["hi <USER> see <URL> mail <EMAIL>x 좋다. 그래. 맞다 ㅋㅋㅋㅋ"]


def test_clean_text_edges(column):
    rows = ["가.나.다.라", "\n  leading", "a b", None, "", "plain text", "one\ttwo\x0bthree", "ㅋㅋㅋㅋㅋㅋㅋㅋ", "ㅋㅋㅋ"]
    assert column(text.clean_text, *rows) == [
        "가. 나. 다. 라", " leading", "ab", None, "", "plain text", "one two three", "ㅋㅋㅋㅋ", "ㅋㅋㅋ",
    ]


def test_handles_need_a_word_start(column):
    assert column(text.mask_handles, "x@kim @kim-1 (@no", "@가나") == ["x@kim <USER> (@no", "<USER>"]


def test_address_broken_by_entity_needs_strict(column):
    broken = "a@b&nbsp;.com"
    assert column(text.clean_text, broken) == ["a@b.com"]
    assert column(lambda c: text.clean_text(c, strict=True), broken) == ["<EMAIL>"]


def _clean(value: str) -> str:
    """The rules one after another, as plain regular expressions."""
    java_space = "[ \\t\\n\\x0b\\f\\r]"
    value = re.sub(r"https?://[^ \t\n\x0b\f\r]+", "<URL>", value)
    value = re.sub(rf"((?<={java_space})|^)@[A-Za-z0-9_가-힣\-]+", "<USER>", value)
    value = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>", value)
    value = re.sub("&nbsp;| ", "", value).strip(" ")
    value = re.sub(rf"{java_space}+", " ", value)
    value = re.sub(r"([가-힣]+[.?!])(?=[가-힣0-9a-zA-Z])", r"\1 ", value)
    return re.sub("ㅋ{4,}", "ㅋㅋㅋㅋ", value)


pieces = st.sampled_from(
    ["http://a.b", "https://", "@kim", "a@b.co", "&nbsp;", " ", " ", "  ", "\n", "\t", "\x0b", "\r", "가", "나다", ".", "!",
     "?", "ㅋ", "ㅋㅋㅋ", "a", "Z9", "-", "@", "&", "<URL>", "://"]
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=300, max_size=400))
def test_clean_text_equals_the_rules_in_order(column, values):
    got = column(text.clean_text, *values)
    assert got == [_clean(v) for v in values]
    for cleaned in got:
        assert "  " not in cleaned and "ㅋㅋㅋㅋㅋ" not in cleaned


def test_split_sentences(column):
    rows = ["One. Two!  Three? 4.5 ok", "", None, "...", "1. 11. 12. x", " . a"]
    assert column(text.split_sentences, *rows) == [
        ["One.", "Two!", "Three?", "4.5 ok"], [], [], ["..."], ["1.", "11.", "12.", "x"], [".", "a"],
    ]


def test_normalize_text(column):
    assert column(text.normalize_text, " a \n b ", "  ", None) == ["a b", None, None]


def test_tags_overlap_repeat_and_fold_case(column):
    words = {"one": ["AS", "GAS", "AS"], "two": ["AS", "디자인"]}
    tagged = column(lambda c: lexicon.tag_keywords(c, words), "gas 디자인", "none", None)
    assert [tuple(t) for t in tagged[0]] == [("one", "AS"), ("one", "GAS"), ("one", "AS"), ("two", "AS"), ("two", "디자인")]
    assert tagged[1] == []
    distinct = column(lambda c: lexicon.tag_keywords(c, words, distinct=True), "gas")
    assert [tuple(t) for t in distinct[0]] == [("one", "AS"), ("one", "GAS"), ("two", "AS")]


def test_read_lexicon(spark, folder):
    with open(f"{folder}/words.json", "w") as out:
        out.write('{"design": ["디자인", "LED"], "fault": ["결함"]}')
    assert lexicon.read_lexicon(spark, f"{folder}/words.json") == {"design": ["디자인", "LED"], "fault": ["결함"]}


def test_sentence_rows_keep_gaps_and_title_flag(spark):
    rows = [
        ("a", "Short. A long title", "Body text here. tiny. Another sentence", None),
        ("b", None, "12345. 123456", None),
        ("c", "", "Some content", None),
    ]
    df = spark.createDataFrame(rows, "id string, title string, content string, created_at timestamp_ntz")
    got = {r.id: (r.from_post, r.sentence) for r in S.explode_sentences(S.as_source(df)).collect()}
    assert set(got) == {"a_0", "a_1", "a_2", "a_4", "b_0", "b_1", "c_0"}
    assert got["a_1"] == (True, "A long title") and got["a_4"] == (True, "Another sentence")
    assert got["b_0"] == (False, "12345.") and got["c_0"] == (False, "Some content")
    assert "a_3" not in got


def test_keyword_rows_drop_untagged(spark):
    df = spark.createDataFrame([("s_0", "The led lamp"), ("s_1", "nothing")], "id string, sentence string")
    got = S.keyword_rows(df, {"design": ["LED", "LAMP"]}).collect()
    assert sorted(map(tuple, got)) == [("s_0", "design", "LAMP"), ("s_0", "design", "LED")]


def test_union_tolerates_one_side(spark):
    comments = spark.createDataFrame([("c", "text", None)], "id string, content string, created_at timestamp_ntz")
    assert S.union_sources(None, comments).first().title is None
    try:
        S.union_sources(None, None)
        raise AssertionError("no error")
    except ValueError:
        pass


def test_plugin_splitter_builds_one_model_per_task(spark):
    def factory():
        return lambda value: value.split("|")

    df = spark.createDataFrame([("a|b",), (None,)], "t string")
    assert [r[0] for r in df.coalesce(1).select(S.plugin_splitter(factory)(F.col("t"))).collect()] == [["a", "b"], []]


def test_plugin_splitter_takes_small_batches(spark, folder):
    """Not by Arrow, whose batches hold thousands of texts; still one model for each task."""

    def factory():
        with open(f"{folder}/{uuid.uuid4().hex}", "w"):
            pass
        return lambda value: value.split("|")

    df = spark.range(0, 900, 1, 3).select(F.concat("id", F.lit("|x")).alias("t"))
    made = df.select(S.plugin_splitter(factory)(F.col("t")).alias("s"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert sorted(r.s[0] for r in made.collect()) == sorted(str(n) for n in range(900))
    assert len(os.listdir(folder)) == 3


def test_long_lexicons_are_tagged_as_short_ones(spark):
    words = {"one": ["AS", "GAS", "AS"], "two": ["디자인"], "three": [c + d for c in "ABCDEFGH" for d in "AEIOUNRS"]}
    df = spark.createDataFrame([("a", "gas 디자인 tank"), ("b", ""), ("c", None)], "id string, sentence string")
    tags = [(r.sentence_id, r.category, r.keyword) for r in S.keyword_rows(df, words).collect()]
    upper = "gas 디자인 tank".upper()
    assert tags == [("a", c, w) for c, listed in words.items() for w in listed if w in upper]


WORDS = {"one": ["AS", "GAS", "AS"], "two": ["디자인", "자", "😀x", "x😀"], "three": ["A", "AA", "AAA", "GAS 디"], "four": [], "five": ["a", "SS"]}
TEXTS = ["gas 디자인 tank", "", None, "aaaa", "straße", "😀x😀X x😀", "as", "a\nas " * 3, "자", "ga" + "s"]


@pytest.mark.parametrize("segment", [inverted.SEGMENT, 3, 1])
@pytest.mark.parametrize("distinct", [False, True])
def test_inverted_lexicons_find_what_the_expression_finds(spark, segment, distinct, monkeypatch):
    df = spark.createDataFrame([(str(n), t) for n, t in enumerate(TEXTS)], "id string, sentence string").coalesce(1)
    want = [tuple(r) for r in S.keyword_rows(df, WORDS, distinct).collect()]
    assert [tuple(r) for r in S.inverted_keyword_rows(df, WORDS, distinct).collect()] == want
    monkeypatch.setattr(inverted, "SEGMENT", segment)
    built = inverted.InvertedLexicon(WORDS, distinct)
    upper = [r[0] for r in df.select(F.upper("sentence")).collect()]
    text, entry = built.find(upper)
    assert [(str(t), *built.entries[e]) for t, e in zip(text, entry)] == want


def test_inverted_lexicons_compare_words_of_one_hash(monkeypatch):
    monkeypatch.setattr(inverted, "_BASE", 1)  # a word and its anagrams have one hash
    built = inverted.InvertedLexicon({"c": ["AB", "BA", "ABC", "CAB", "BCA"]})
    text, entry = built.find(["xBAx", "BCAB", "AAB", "", "CB"])
    assert [(t, built.entries[e][1]) for t, e in zip(text, entry)] == [(0, "BA"), (1, "AB"), (1, "CAB"), (1, "BCA"), (2, "AB")]


def test_inverted_lexicons_without_entries_and_of_thousands(spark):
    df = spark.createDataFrame([(str(n), f"Text number W{n} ends.") for n in range(300)], "id string, sentence string")
    assert S.inverted_keyword_rows(df, {}).count() == 0 and S.inverted_keyword_rows(df.limit(0), WORDS).count() == 0
    many = {"n": [f"W{n}" for n in range(4000)]}
    got = sorted((r.sentence_id, r.keyword) for r in S.inverted_keyword_rows(df, many).collect())
    assert got == sorted((str(n), f"W{m}") for n in range(300) for m in {int(str(n)[:k]) for k in range(1, len(str(n)) + 1)})


def test_an_empty_keyword_is_refused():
    with pytest.raises(ValueError, match="empty keyword in two"):
        lexicon.lexicon_entries({"one": ["A"], "two": ["B", ""]})
    with pytest.raises(ValueError, match="empty keyword in two"):
        inverted.tagger({"one": ["A"], "two": ["B", ""]})
    with pytest.raises(ValueError, match="empty keyword in two"):
        lexicon.lexicon_entries({"one": ["A"], "two": ["B", ""]})
