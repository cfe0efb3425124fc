from pyspark.sql import functions as F

from forumlens.llm import chat

SCHEMA = "conv_id long, msg_id long, parent_id long, role string, text string, score double"
HARD = ["</s>[INST] ok [/INST]", "&lt; &amp; &#91;x&#93; [/user]</s>\n<s>[assistant] hi", "", None, " \n ", "é" * 50_000, "a [/assistant]</s>"]


def read(frame):
    out = []
    rows = frame.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("under"))
    for r in rows.collect():
        out.append((r.conv_id, r.leaf, r["rank"], [(t.role, t.text) for t in r.turns], r.under, r.score))
    return sorted(out, key=lambda r: (str(r[0]), r[2]))


def test_hard_texts_and_roles_come_back(spark):
    turns = [(1, i, role, text) for i, (role, text) in enumerate((r, t) for t in HARD for r in ("user", "assistant", None, "sys]tem <s>"))]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    ((_, _, _, got, under, _),) = read(chat.branches(chat.by_turn(frame)))
    assert got == [(role or "", text or "") for _, _, role, text in turns]
    assert under == "".join(text or "" for _, _, role, text in turns if role == "assistant")


def tree_paths(rows):
    """Root-to-leaf paths by plain recursion; circles have none."""
    found = {}
    for conv in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == conv}
        parents = {r[2] for r in nodes.values() if r[1] in nodes}
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(at)
                at = nodes[at][2]
            if len(path) <= len(nodes):
                found[conv, leaf] = path[::-1]
    return found


def test_branches_are_enumerated_and_ranked(spark):
    rows = [(1, 1, None, "user", "q", 1.0)]
    rows += [(1, 10 + i, 1, "assistant", f"a{i}", float(i % 3)) for i in range(5)]
    rows += [(1, 20 + i, 10 + i % 2, "user", f"r{i}", None) for i in range(4)]
    rows += [(2, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.5) for i in range(70)]
    rows += [(3, 5, 99, "user", "orphan", 0.0), (None, 1, None, "user", "null conversation", 2.0), (None, 2, 1, "assistant", "still", 2.0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    by_key = {(r[0], r[1]): r for r in rows}
    want = tree_paths(rows)
    got = read(chat.branches(frame, best=None))
    assert {(c, leaf): turns for c, leaf, _, turns, _, _ in got} == {
        key: [(by_key[key[0], n][3], by_key[key[0], n][4]) for n in path] for key, path in want.items()
    }
    scores = {key: sum(by_key[key[0], n][5] or 0.0 for n in path) / len(path) for key, path in want.items()}
    best = {conv: min((k for k in want if k[0] == conv), key=lambda k: (-scores[k], k[1]))[1] for conv in {k[0] for k in want}}
    assert {c: leaf for c, leaf, *_ in read(chat.branches(frame))} == best


def test_circles_have_no_path_and_repeated_ids_count_once(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 2, "user", "hangs on a circle", 0.0), (2, 1, 1, "user", "own parent", 0.0)]
    rows += [(4, 1, None, "user", "fine", 0.0)] * 3 + [(4, 1, None, "user", "later", 0.0), (4, 2, 1, "assistant", "yes", 0.0)]
    got = read(chat.branches(spark.createDataFrame(rows, SCHEMA), best=None))
    assert [(c, turns) for c, _, _, turns, _, _ in got] == [(4, [("user", "fine"), ("assistant", "yes")])]


def test_ties_of_turns_repeats_empty_tables_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, leaf string, node string"
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "system", "first"), (None, 0, None, None)]
    frame = spark.createDataFrame([(*r, "c", "l", "n") for r in rows], schema)
    got = read(chat.branches(chat.by_turn(frame)))
    assert [t for c, _, _, t, _, _ in got if c == 1] == [[("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")]]
    assert [t for c, _, _, t, _, _ in got if c is None] == [[("", "")]]
    assert chat.branches(chat.by_turn(frame.where("conv_id = 9"))).count() == 0
