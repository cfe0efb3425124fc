"""Spelling variants: words that differ by one code point, and the form each rare one most likely stands for.

Near words are found in a trie of frequency vectors. The code points of a word are counted by group (code point
modulo ``GROUPS``), and the trie branches on one count after the other, those first that vary most. One inserted,
deleted or replaced code point changes the counts by a surplus of one, a deficit of one or one of each, so a
depth-first search spends one of either on its way down. A pair is sought from one side only: from the shorter
word, or from the word whose surplus comes before its deficit. Words at the leaves it reaches are compared.

The first levels of the trie are the shuffle. A word lies at one node and asks at each node that its budget reaches.
Nodes with more than ``NODE`` words are taken apart by the next levels, down to the last; more than ``NODE``
askers are dealt to copies of the node. What is left of the trie is searched inside a task, by all askers at once.

Words are runs of ``RUN`` with A-Z lower-cased, of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT``
occurrences. Run counting, the forms and their roots are DataFrame operations.

Cases: null and empty texts hold no words. Rows repeated count as often as they occur; a null ``doc_id`` is an
empty string before the colon. Very long runs are words like others. Equal counts go to the word that is first in
code-point order. An empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.shingles import mixed
from forumlens.runtime import materialize

RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
DAMAGED = 31  # one run in so many loses a code point
FORM_RATIO = 10
GROUPS = 32
LEVELS = 4  # levels of the trie that are taken at a time
NODE = 1 << 17  # words, and askers, that a task may hold at once
LEAF = 64  # words that are compared without going deeper
PAIRS = 1 << 16  # pairs compared at once
WIDE = 64  # longer words are compared one by one

_ODD = mixed(np.arange(301, 301 + GROUPS, dtype=np.uint64)) | np.uint64(1)


def runs(docs: DataFrame, damaged: int | None = DAMAGED, least: int = LEAST_LENGTH) -> DataFrame:
    """The words of every text; one run in ``damaged`` without one of its code points."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(f"{RUN}{{{least},}}"), F.lit(0))  # a match begins where its run does
    each = docs.select("doc_id", F.explode(found).alias("word"))
    if not damaged:
        return each.select("word")
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    hashed = each.select("word", F.crc32(key).alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return hashed.select(F.when(F.col("h") % damaged == 0, less).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least)


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and how often it occurs, ``n``."""
    return runs(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def vectors(words: list[str]) -> np.ndarray:
    """How many code points of each group every word has."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(owner * GROUPS + codes % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return counts.astype(np.int16 if lengths.max(initial=0) < 1 << 15 else np.int32)


def level_order(words: DataFrame) -> list[int]:
    """Groups by how much their counts vary over all words, most first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors(batch.column(0).to_pylist()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS)), pa.array(v.sum(0)), pa.array((v * v).sum(0))], ["g", "one", "two"])

    sums = words.select("word").mapInArrow(moments, "g long, one long, two long").groupBy("g").agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    n = words.count() or 1
    spread = {r["g"]: r["two"] / n - (r["one"] / n) ** 2 for r in sums.collect()}  # a row per group
    return sorted(range(GROUPS), key=lambda g: (-spread.get(g, 0.0), g))


def _prefix_keys(levels: np.ndarray, depth: int) -> np.ndarray:
    """A number for the node at ``depth`` above each row; nodes that get the same number are searched as one."""
    return (levels[:, :depth].astype(np.uint64) * _ODD[:depth]).sum(1, dtype=np.uint64)


def routed(words: DataFrame, order: list[int], depth: int, above: int) -> DataFrame:
    """Words at their own node at ``depth`` and at those where they ask: ``upper`` (the node's at ``above``), ``node``, ``word``, ``n``, ``own``."""
    steps = [(None, None), *[(i, None) for i in range(depth)], *[(i, j) for i in range(depth) for j in range(i + 1, depth)]]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = vectors(batch.column(0).to_pylist())[:, order]
            upper, node = _prefix_keys(levels, above), _prefix_keys(levels, depth)
            for surplus, deficit in steps:
                up, at, keep = upper, node, None
                if surplus is not None:
                    up, at = up + _ODD[surplus] * np.uint64(surplus < above), at + _ODD[surplus]
                if deficit is not None:
                    keep = np.flatnonzero(levels[:, deficit] > 0)
                    up, at = (up - _ODD[deficit] * np.uint64(deficit < above))[keep], (at - _ODD[deficit])[keep]
                rest = batch if keep is None else batch.take(pa.array(keep))
                own = pa.array(np.full(rest.num_rows, surplus is None))
                yield pa.RecordBatch.from_arrays([pa.array(up.view(np.int64)), pa.array(at.view(np.int64)), *rest.columns, own], ["upper", "node", "word", "n", "own"])

    return words.select("word", "n").mapInArrow(route, "upper long, node long, word string, n long, own boolean")


def _candidates(asking: np.ndarray, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth-first search: pairs of (asking, held) rows whose counts differ by a surplus and then a deficit of one at most.

    ``held`` is sorted by its columns, so a node of the trie is a range of its rows.
    """
    depth = held.shape[1]
    held_floats, asking_floats = held.astype(np.float64), asking.astype(np.float64)  # whole numbers, so exact
    held_squares, asking_squares = (held_floats**2).sum(1), (asking_floats**2).sum(1)
    held_length, asking_length = held.sum(1, dtype=np.int64), asking.sum(1, dtype=np.int64)
    none = np.zeros(len(asking), np.int8)
    stack = [(0, 0, len(held), np.arange(len(asking)), none, none)]
    while stack:
        level, low, high, who, surplus, deficit = stack.pop()
        while level < depth and held[low, level] == held[high - 1, level] and len(who):  # one branch
            apart = held[low, level] - asking[who, level]
            keep = (apart == 0) | ((apart == 1) & (surplus == 0)) | ((apart == -1) & (surplus == 1) & (deficit == 0))
            who, apart = who[keep], apart[keep]
            surplus, deficit, level = surplus[keep] | (apart == 1), deficit[keep] | (apart == -1), level + 1
        if not len(who):
            continue
        if level == depth or high - low <= LEAF:
            step = max(PAIRS // (high - low), 1)
            for at in range(0, len(who), step):
                some = who[at : at + step]
                # a squared distance of 2 is a surplus and a deficit of one, and lengths tell them from two of a kind
                distance = asking_squares[some, None] + held_squares[None, low:high] - 2 * (asking_floats[some] @ held_floats[low:high].T)
                longer = held_length[None, low:high] - asking_length[some, None]
                one, two = np.nonzero((distance <= 2) & (longer >= 0) & (longer <= 1))
                one, two = some[one], two + low
                apart = held[two] - asking[one]
                first = (apart != 0).argmax(1)
                inside = apart[np.arange(len(one)), first] >= 0  # surplus before deficit
                yield one[inside], two[inside]
            continue
        column = held[low:high, level]
        edges = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low]))
        own = asking[who, level]
        for a, b in zip(edges[:-1], edges[1:]):
            apart = column[a] - own
            keep = (apart == 0) | ((apart == 1) & (surplus == 0)) | ((apart == -1) & (surplus == 1) & (deficit == 0))
            if keep.any():
                gone = apart[keep]
                stack.append((level + 1, low + a, low + b, who[keep], surplus[keep] | (gone == 1), deficit[keep] | (gone == -1)))


def _padded(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


def _one_apart(a: bytes, b: bytes) -> bool:
    """Whether ``b``, as long as ``a`` or one longer, differs by exactly one code point."""
    first = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[first + 1 :] if len(a) == len(b) else a[first:]) == b[first + 1 :]


class Verifier:
    """Compares words exactly, many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = [w.encode("latin-1") for w in words]
        self.length = np.fromiter(map(len, self.words), np.int64, len(words))
        short = [w if len(w) <= WIDE else b"" for w in self.words]
        width = max(map(len, short), default=0) + 1
        self.forward, self.backward = _padded(short, width), _padded([w[::-1] for w in short], width)

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the pairs are one code point apart; the second is as long as the first or one longer."""
        same = self.length[one] == self.length[two]
        differ = self.forward[one] != self.forward[two]
        before = np.where(differ.any(1), differ.argmax(1), self.length[one])
        behind = self.backward[one] != self.backward[two]
        after = np.where(behind.any(1), behind.argmax(1), self.length[one])
        near = np.where(same, differ.sum(1) == 1, before + after >= self.length[one])
        for i in np.flatnonzero((self.length[one] > WIDE) | (self.length[two] > WIDE)):
            near[i] = _one_apart(self.words[one[i]], self.words[two[i]])
        return near


def near_in_node(order: list[int]):
    """The near pairs of one node: both ways, as ``word``, ``near`` and ``near_n``."""

    def search(group: pa.Table) -> pa.Table:
        own = group["own"].to_numpy(zero_copy_only=False)
        words, n = group["word"].to_pylist(), group["n"].to_numpy()
        levels = np.ascontiguousarray(vectors(words)[:, order])
        held = np.flatnonzero(own)
        held = held[np.lexsort(levels[held].T[::-1])]
        asking = np.flatnonzero(group["asks"].to_numpy(zero_copy_only=False))
        verified = Verifier(words)
        place = pc.rank(group["word"], tiebreaker="dense").to_numpy()
        out = []
        if len(held) and len(asking):
            for one, two in _candidates(levels[asking], levels[held]):
                one, two = asking[one], held[two]
                alike = (levels[one] == levels[two]).all(1)  # of equal vectors the smaller word asks
                keep = ~alike | (place[one] < place[two])
                one, two = one[keep], two[keep]
                good = verified(one, two)
                out.append((one[good], two[good]))
        one, two = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
        word = group["word"].combine_chunks()
        first, second = np.concatenate((one, two)), np.concatenate((two, one))
        return pa.table({"word": word.take(pa.array(first)), "near": word.take(pa.array(second)), "near_n": pa.array(n[second])})

    return search


def near_words(words: DataFrame, node: int = NODE) -> DataFrame:
    """Near pairs of ``words`` (``word``, ``n``), both ways: ``word``, ``near``, ``near_n``."""
    order = level_order(words)
    found, depth, above, left = [], LEVELS, 0, None
    while True:
        rows = routed(words, order, depth, above)
        if left is not None:
            rows = rows.join(left.select(F.col("node").alias("upper")), "upper", "left_semi")
        rows = materialize(rows, "spelling-routed")
        sizes = rows.groupBy("node").agg(F.count_if("own").alias("held"), F.count("*").alias("asking")).where("held > 0")
        sizes = materialize(sizes, "spelling-nodes")
        last = depth == GROUPS
        small = sizes if last else sizes.where(F.col("held") <= node)
        parts = F.ceil(F.col("asking") / node).cast("int")
        dealt = rows.join(small.select("node", parts.alias("parts")), "node")
        part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        every = F.when(F.col("own"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(part))
        each = dealt.withColumn("asks_in", part).withColumn("part", F.explode(every))
        each = each.select("node", "part", "word", "n", "own", (F.col("part") == F.col("asks_in")).alias("asks"))
        found.append(each.groupBy("node", "part").applyInArrow(near_in_node(order), "word string, near string, near_n long"))
        left = None if last else sizes.where(F.col("held") > node)
        if last or left.isEmpty():
            break
        above, depth = depth, min(depth + LEVELS, GROUPS)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """``word`` and the ``root`` its chain of forms ends in; chains have at most ``longest`` steps, and each round doubles the reach."""
    known = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(longest, 1)))):
        on = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = materialize(known.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return known


def variants(docs: DataFrame, ratio: int = FORM_RATIO, node: int = NODE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of ``docs``."""
    words = materialize(vocabulary(docs), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("fewer"), F.col("near").alias("form")))
    nearest = near_words(words, node).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(nearest, "word", "left")
    enough = -F.col("best.fewer") >= ratio * F.col("n")
    rows = materialize(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.fewer")).alias("form_n"),
        ),
        "spelling-forms",
    )
    most = rows.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log(max(most / LEAST_COUNT, 1), ratio)) + 1  # each step has ``ratio`` times the count
    rooted = roots(rows.where("form is not null"), steps)
    return rows.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

