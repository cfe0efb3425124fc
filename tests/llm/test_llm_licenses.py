import math
import random
import re

from forumlens.llm import licenses

MIT, APACHE, GPL = (licenses.TEMPLATES[n] for n in ("MIT", "Apache-2.0", "GPL-3.0"))
FILLER = "quite other words stand here and go on for a while\n" * 5


def run(spark, files, **options):
    rows = [(i, p, t, "x", 1.0) for i, (p, t) in enumerate(files)]
    frame = spark.createDataFrame(rows, "id long, path string, text string, license string, cosine double")
    return {r.id: r for r in licenses.licensed(frame, "id", **options).collect()}


def test_own_lines_and_nearest_directories(spark):
    files = [
        ("a/LICENSE", MIT), ("a/b/c/copying.txt", GPL), ("a/x.py", FILLER), ("a/b/y.py", FILLER), ("a/b/c/z.py", FILLER), ("a/b/c/d/e/w.py", FILLER),
        ("a/b/c/own.py", FILLER + APACHE + "\n" + FILLER), ("q/x.py", FILLER), ("ab/x.py", FILLER), ("top.py", FILLER), ("a/b/notes.txt", MIT),
    ]
    got = run(spark, files)
    assert [got[i].license for i in range(len(files))] == ["MIT", "GPL-3.0", "MIT", "MIT", "GPL-3.0", "GPL-3.0", "Apache-2.0", None, None, None, "MIT"]
    assert [got[i].origin for i in (0, 2, 5, 6, 7)] == ["own", "inherited", "inherited", "own", "none"]
    assert got[5].from_path == "a/b/c/copying.txt" and got[6].cosine == 1.0


#: Ordinary lines, in which the words that notices share with any text are as common as they are in any corpus.
PROSE = "the work of a public house is under way\nthis version of the idea is general and for the most part subject to the forms of use\nfishing is licensed in the lake\n" + FILLER


def test_texts_that_only_share_words_are_left_alone(spark):
    shared = "the work is under a public version of the general idea of licensed fishing"
    texts = [shared, "License", FILLER, GPL, *[PROSE] * 40]
    got = run(spark, [(f"a/{n}", t) for n, t in enumerate(texts)])
    assert {n for n, r in got.items() if r.license} == {3} and got[3].license == "GPL-3.0"
    assert plain_cosines(texts)[0] < 0.5


def test_words_no_other_line_holds_weigh_as_much_as_the_definition_says(spark):
    """Among lines without any of its words a text is near a notice by the words it shares: the weights are those of the corpus."""
    texts = ["the work is under a public version of the general idea of licensed fishing", "License", *[FILLER] * 41]
    got = run(spark, [(f"a/{n}", t) for n, t in enumerate(texts)])
    want = plain_cosines(texts)
    assert {n: round(r.cosine, 5) for n, r in got.items() if r.license} == {n: round(c, 5) for n, c in enumerate(want) if c >= licenses.LEAST_COSINE}


def test_changed_notices_are_still_found(spark):
    got = run(spark, [("x", "# Licensed under the apache license, version 2.0 (see below)"), ("y", "Released under the MIT License"), *[(f"n{i}", FILLER) for i in range(30)]])
    assert (got[0].license, got[1].license) == ("Apache-2.0", "MIT")


def test_nulls_empties_long_texts_ties_and_repeats(spark):
    files = [(None, MIT), ("a/n", None), ("a/e", ""), ("a/long", FILLER * 4000 + GPL), ("d/LICENSE", MIT), ("d/LICENSE", APACHE), ("d/f", FILLER), ("d/f", FILLER), ("a/sp", "\n \n" + "é" * 100_000)]
    got = run(spark, files)
    assert len(got) == len(files)
    assert got[0].license == "MIT" and got[1].license is None and got[3].license == "GPL-3.0"
    assert (got[6].license, got[7].license) == ("Apache-2.0", "Apache-2.0")
    assert got[8].license is None


def test_empty_tables_and_no_templates(spark):
    frame = spark.createDataFrame([(1, "a", MIT)], "id long, path string, text string")
    assert licenses.licensed(frame.where("id = 9"), "id").count() == 0
    assert licenses.licensed(frame, "id", templates={}).collect()[0].license is None


def plain_cosines(texts):
    """The best cosine of each text's lines by the definition: the weight of every term is counted."""
    split = [[re.findall(licenses.TERM, line.lower()) for line in text.split("\n")] for text in texts]
    lines = [line for held in split for line in held if line]
    weight = lambda t: math.log((1 + len(lines)) / (1 + sum(t in line for line in lines)))
    vector = lambda line: {t: line.count(t) * weight(t) for t in set(line)}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    notices = [vector(re.findall(licenses.TERM, n.lower())) for n in licenses.TEMPLATES.values()]
    cosine = lambda a, b: sum(x * b.get(t, 0) for t, x in a.items()) / ((length(a) * length(b)) or 1)
    return [max([cosine(vector(line), n) for line in held if line for n in notices], default=0) for held in split]


def test_every_terms_weight_is_counted(spark):
    """Frequent words beside a notice weigh little, as in any corpus; rare ones weigh much."""
    rng = random.Random(2)
    common = "see for details of the a is to in file".split()
    prose = ["\n".join(" ".join(rng.choices(common, k=8)) for _ in range(10)) for _ in range(60)]
    texts = [
        "Released under the MIT License; see the file for details.", "released rarely under odd names the mit license quux frob blah zork",
        "see the MIT License, license, for the details of it", APACHE + " see for details of the file", *prose,
    ]
    got = run(spark, [(f"f{i}", t) for i, t in enumerate(texts)])
    want = plain_cosines(texts)
    assert want[0] >= licenses.LEAST_COSINE > want[1]
    assert {i: round(c, 5) for i, c in enumerate(want) if c >= licenses.LEAST_COSINE} == {i: round(r.cosine, 5) for i, r in got.items() if r.origin == "own"}
