import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from llm_helpers import SF, sf_exists

import __spark_entry__ as entry
from forumlens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(rows):
    """Damaged rows, nulls written as one space."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """Cost, audit and repaired lines by recursion over (rows done, state), comparing whole audits."""
    accepted = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
    wanted = {"": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}

    @cache
    def best(i, state, inserted=0):
        found = []
        name, to = wanted[state]
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 2:
            cost, audit, lines = best(i, to, inserted + 1)
            found.append((cost + 2, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            role, text = rows[i][2], rows[i][3]
            extra = faults[i] == "T"
            cost, audit, lines = best(i + 1, state)
            found.append((cost + 3, "D" + audit, lines))
            if faults[i] not in ("B", "D"):
                after = accepted.get(role[:1], {}).get(state)
                if after:
                    cost, audit, lines = best(i + 1, after)
                    found.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, to)
                found.append((cost + 2 + extra, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    return best(0, "")


def plain(rows):
    """The contract by brute force: counts, cost, audit and checksum of every conversation."""
    held = {r[0]: [] for r in rows}
    for r in damage(rows):
        held[r[0]].append(r)
    out = {}
    for conv, group in held.items():
        group.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in group:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("B" if not marks else "D" if (role, text) in seen else "T" if marks[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        cost, audit, lines = cheapest(tuple(group), tuple(faults))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *map(faults.count, "BDT"), illegal, cost, audit, digest)
    return out


def result(frame, **options):
    rows = repair.report(frame, **options).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: (*[r[c] for c in COUNTS], r.audit, r.repaired_sha256) for r in rows}


def conversations(seed, many=60, longest=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "unknown", "System"]
    texts = ["Yes.", "No!", "open", " ", "", None, "again?  ", "é…", " ", "twice.", "a\nb."]
    rows = []
    for conv in range(many):
        for turn in range(rng.randint(1, longest)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, turn * rng.choice([1, 1, 2]) if rng.random() < 0.95 else None, role, rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randrange(10**6)}."))
    return rows


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 3), (3, 1)])
def test_repairs_equal_brute_force_in_blocks_of_any_size(spark, seed, block):
    rows = conversations(seed)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), block=block) == plain(rows)


def test_a_long_conversation_spans_many_blocks(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", f"c{t}!", ""])) for t in range(260)]
    rows += [(8, 0, "user", "x."), (6, 0, "system", "x.")]
    assert result(spark.createDataFrame(rows, SCHEMA), block=16) == plain(rows)


def test_nulls_ties_repeats_and_conversations_without_rows(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(None, None, None, None), (None, 3, "user", "q."), (None, 3, "assistant", "r."), (dropped, 0, "user", "gone."), (5, None, "user", "q"), (5, None, "user", "q")]
    rows += [(9, 1, "user", "same.")] * 40 + [(10, 2, "a" * 5000, "z" * 200_000 + ".")]
    got = result(spark.createDataFrame(rows, SCHEMA), block=8)
    assert got == plain(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_tables_and_clashing_columns(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "q."), (1, 1, "assistant", "r."), (2, 0, "user", "q")]
    clashing = spark.createDataFrame([(*r, 1, 2, 3, "x", "y") for r in rows], SCHEMA + ", pos long, copy long, kind long, block string, at string")
    assert result(clashing) == plain(rows)


@pytest.mark.skipif(not sf_exists(), reason="no test tables")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op13_repair_conversations"](spark, SF).collect()
    assert {r.conv_id: (*[r[c] for c in COUNTS], r.audit, r.repaired_sha256) for r in got} == plain(rows)
