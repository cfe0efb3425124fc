from collections import Counter

from forumlens.llm import linededup

SCHEMA = "page_id long, url string, html string, host string, lines string, drop string"


def run(spark, pages, **options):
    frame = spark.createDataFrame([(*p, "h", "l", "d") for p in pages], SCHEMA)
    return {r.page_id: r for r in linededup.without_boilerplate(frame, **options).collect()}


def page(*lines):
    return "<html><head><title>t</title><script>var a='<p>x</p>';</script></head><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>"


def test_lines_above_the_ratio_go(spark):
    pages = [(i, f"https://U@A.example:80/{i}?x=1", page("menu", f"own {i}", *(["often"] if i < 4 else []), *(["rare"] if i < 3 else []))) for i in range(10)]
    got = run(spark, pages)
    assert {r.host for r in got.values()} == {"a.example"}
    for i, r in got.items():
        assert r.text.split("\n") == [f"own {i}"] + (["rare"] if i < 3 else [])
        assert r.n_lines == 3 + (i < 4) + (i < 3) and r.n_dropped == r.n_lines - len(r.text.split("\n"))


def test_hosts_are_apart_and_small_hosts_lose_nothing(spark):
    pages = [(i, "http://big.example/", page("same", str(i))) for i in range(9)] + [(100, "http://small.example/", page("same", "same"))]
    got = run(spark, pages)
    assert got[100].text == "t\nsame\nsame" and all(got[i].text == str(i) for i in range(9))


def test_against_counting(spark):
    pages = [(i, f"http://h{i % 3}.example/{i}", page(*[f"l{j}" for j in range(12) if (i * (j + 3)) % 7 < j % 5])) for i in range(90)]
    got = run(spark, pages)
    held = {p[0]: linededup_lines(p[2]) for p in pages}
    total = Counter(p[0] % 3 for p in pages)
    seen = Counter((i % 3, line) for i, lines in held.items() for line in set(lines))
    for i, lines in held.items():
        keep = [x for x in lines if not (seen[i % 3, x] >= 3 and 10 * seen[i % 3, x] > 3 * total[i % 3])]
        assert got[i].text == "\n".join(keep)


def linededup_lines(html):
    import re

    text = re.sub(r"(?is)<script\b.*?</script\s*>", "", html)
    return [x for x in re.sub(r"<[^>]*>", "\n", text).split("\n") if x]


def test_nulls_empties_long_pages_repeats_and_empty_tables(spark):
    pages = [(1, None, None), (2, "no url", ""), (3, "http:///x", "<p>a"), (4, None, page("z" * 400_000)), (5, None, "<!-- <p>gone</p> -->plain  \n text&amp;")] + [(6, "http://r.example", page("x"))] * 4
    frame = spark.createDataFrame([(*p, "h", "l", "d") for p in pages], SCHEMA)
    rows = linededup.without_boilerplate(frame).collect()
    assert len(rows) == len(pages)
    by = {r.page_id: r for r in rows}
    assert by[1].text == "" and by[1].host == "" and by[4].n_lines == 2 and by[5].text == "plain\ntext&amp;" and by[6].text == ""
    assert linededup.without_boilerplate(frame.where("page_id > 50")).count() == 0
