"""Repair of conversation structure at least cost, with an audit of the edits.

Rows are kept (K), given another role (R), deleted (D) or preceded by inserted ones (I) so that the initials of the
roles read ``(s?(ua)+)?``. Four states say what came before: nothing, a system, a user, an assistant row. A dynamic
program gives each node (rows done, state) its cost to the end; arcs that lose nothing of it are optimal. Of the
cheapest audits the least in ASCII order counts. The letters of a node's arcs differ, so each node has one least
arc; nodes are ranked by audits of 1, 2, 4, ... letters, a rank being that of the pair of ranks at the node and at
the end of its doubled pointer. Ranks pick among a node's optimal arcs, and the pointers, halved again, give its path.

A conversation may be longer than a task holds. Rows get a position in a distributed sort and are cut into blocks
of ``BLOCK`` rows; what a block holds of a conversation is a segment. A segment becomes a matrix of costs between
states; the costs behind it come from doubling over the segments. It then solves its rows for each state it may be
entered in, and the states themselves come from doubling as well. Only narrow rows are grouped; texts are sorted once
and joined with their edits by position. The checksum of a conversation is sequential by its nature: its texts
stream, sorted, through one task, which holds a batch of rows and the audit.

Cases: null roles, texts, turns and ids count as one space where they are compared, hashed or written; null turns
come first, and a null ``conv_id`` is one conversation. Rows of one turn go by role, then the first 100 code
points of the text, then its checksum. Rows repeated in the
table are damaged each. Roles are told by their first code point. Other columns are not looked at. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import ranked
from forumlens.runtime import materialize

BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows end with
STATES = 4
FAR = 1 << 40  # no way
NEXT = np.array([USER, USER, ASSISTANT, USER])  # the state that a row of the role wanted next leads to
ENDING = np.array([0, 2 * INSERT, INSERT, 0])  # cost to the end behind the last row
#: Letters of the edits in ASCII order; lower case where the role is an assistant's. ``audit`` folds them.
LETTER_RANK = {"D": 1, "I": 2, "i": 2, "K": 3, "R": 4, "r": 4}
BLANKS = r"[\x20\x09-\x0D]"


def audit(codes: Column) -> Column:
    return F.translate(codes, "ir", "IR")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that are planted by a hash of conversation and turn."""
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))) % 20
    cast = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _spaced("role").alias("role"), _spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    left = cast.where("kind != 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return left.drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, their place among all rows by conversation and turn, and what their faults are told by."""
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){BLANKS}*\z", 1)
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    seen = rows.select(
        "conv_id", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("open"), F.sha2(both, 256).alias("digest"), F.monotonically_increasing_id().alias("_row"),
    )
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 100), "digest", "_row"]  # range bounds hold no long texts
    return ranked(seen, keys, "repair-rows", "pos").drop("_row")


def faults(rows: DataFrame) -> DataFrame:
    """``pos, conv_id, turn, initial, fault`` (B blank, D duplicate, T truncated, or empty) of placed rows.

    Role and text are compared by their digest; of those that occur again the first place is joined, so one
    pair that a third of all rows have is counted on the map side and its rows are never brought together.
    """
    told = ["conv_id", "digest"]
    again = rows.where("not blank").groupBy(*told).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = materialize(again.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first"), "repair-repeats")
    narrow = rows.select("pos", "conv_id", "turn", "initial", "blank", "open", "digest")
    same = narrow["conv_id"].eqNullSafe(again["_conv"]) & (narrow["digest"] == again["_digest"])
    fault = F.when(F.col("blank"), "B").when(F.col("pos") > F.col("first"), "D").when(F.col("open"), "T").otherwise("")
    return narrow.join(again, same, "left").select("pos", "conv_id", "turn", "initial", fault.alias("fault"))


class Segments:
    """The rows of one block as arrays, and its segments: runs of rows of one conversation."""

    def __init__(self, block: pa.Table):
        block = block.sort_by("pos")
        self.pos = block["pos"].to_numpy()
        conv = block["conv_id"].combine_chunks()
        self.conv = conv
        known, value = np.asarray(conv.is_valid()), conv.fill_null(0).to_numpy()
        fresh = np.concatenate(([True], (known[1:] != known[:-1]) | (value[1:] != value[:-1])))
        self.first = np.flatnonzero(fresh)
        self.size = np.diff(np.append(self.first, len(fresh)))
        initial = np.array(block["initial"].to_pylist(), object)
        self.initial = initial
        self.fault = np.array(block["fault"].to_pylist(), object)
        self.turn = block["turn"].combine_chunks()
        self.gone = (self.fault == "B") | (self.fault == "D")
        self.extra = np.where(self.fault == "T", TRUNCATED, 0)
        # the state that keeping a row leads to from each state, or -1
        self.keeps = np.full((len(fresh), STATES), -1)
        self.keeps[initial == "s", START] = SYSTEM
        for q in range(STATES):
            self.keeps[initial == {USER: "u", ASSISTANT: "a"}[NEXT[q]], q] = NEXT[q]
        self.keeps[self.gone] = -1

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows from the last of each segment to the first, all segments at once: the rows and their segments."""
        for back in range(int(self.size.max(initial=0))):
            which = np.flatnonzero(self.size > back)
            yield self.first[which] + self.size[which] - 1 - back, which

    def before(self, row: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Costs to the end before ``row`` in each state (last axis), from those behind it."""
        shape = (len(row), *[1] * (behind.ndim - 2))
        extra, gone = self.extra[row].reshape(shape), self.gone[row].reshape(shape)
        least = np.empty_like(behind)
        for q in range(STATES):
            cost = DELETE + behind[..., q]
            cost = np.minimum(cost, np.where(gone, FAR, REROLE + extra + behind[..., NEXT[q]]))
            for to in {SYSTEM, NEXT[q]}:
                cost = np.minimum(cost, np.where((self.keeps[row, q] == to).reshape(shape), KEEP + extra + behind[..., to], FAR))
            least[..., q] = cost
        for _ in range(2):  # two inserted rows lead from any state to any that rows are inserted for
            least = np.minimum(least, INSERT + least[..., NEXT])
        return least

    def matrix(self) -> np.ndarray:
        """Cost from each state before a segment to each behind it."""
        cost = np.tile(np.where(np.eye(STATES, dtype=bool), 0, FAR), (len(self.first), 1, 1))  # [segment, exit, state]
        for row, which in self.steps():
            cost[which] = np.minimum(self.before(row, cost[which]), FAR)
        return cost.transpose(0, 2, 1)

    def arcs(self, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Optimal arcs, ordered by the node they leave: that node, the one they lead to, letter and code.

        Nodes are numbered by (place, state); a segment has a place before each of its rows and one behind the last.
        The nodes behind the last row lead to themselves with the letter 0.
        """
        place = np.arange(len(self.pos)) + np.repeat(np.arange(len(self.first)), self.size)
        last = place[self.first + self.size - 1] + 1
        cost = np.zeros((len(self.pos) + len(self.first), STATES), np.int64)
        cost[last] = ends
        for row, which in self.steps():
            cost[place[row]] = self.before(row, cost[place[row] + 1])
        here, behind = cost[place], cost[place + 1]
        final = (last[:, None] * STATES + np.arange(STATES)).ravel()
        found = [(final, final, np.zeros(len(final), np.int64), np.zeros(len(final), np.int64))]

        def arc(code: str, state: int, to: np.ndarray, target: int, good: np.ndarray) -> None:
            at = np.flatnonzero(good)
            many = np.ones(len(at), np.int64)
            found.append((place[at] * STATES + state, to[at] * STATES + target, many * LETTER_RANK[code], many * ord(code)))

        for q in range(STATES):
            other = NEXT[q] == ASSISTANT
            arc("D", q, place + 1, q, here[:, q] == DELETE + behind[:, q])
            arc("i" if other else "I", q, place, NEXT[q], here[:, q] == INSERT + here[:, NEXT[q]])
            for to in {SYSTEM, NEXT[q]}:
                arc("K", q, place + 1, to, (self.keeps[:, q] == to) & (here[:, q] == KEEP + self.extra + behind[:, to]))
            arc("r" if other else "R", q, place + 1, NEXT[q], ~self.gone & (here[:, q] == REROLE + self.extra + behind[:, NEXT[q]]))
        self.place = place
        tail, head, letter, code = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((letter, tail))
        return tail[order], head[order], letter[order], code[order]

    def least_paths(self, ends: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
        """For each segment and each state it is entered in: the codes of the least cheapest audit, and the state behind it.

        An arc's rank for 2^k letters is that of the least audit of so many letters that begins with it; its pointer
        is the arc 2^k letters on, the one of least rank among those that leave the node reached.
        """
        tail, head, letter, code = self.arcs(ends)
        first = np.flatnonzero(np.concatenate(([True], tail[1:] != tail[:-1])))  # every node has arcs, in the order of nodes
        many = len(tail) + 1

        def least(rank: np.ndarray) -> np.ndarray:
            """For each node the arc of least rank."""
            lowest = np.minimum.reduceat(rank * many + np.arange(len(rank)), first)
            return lowest % many

        rank, reach, pointers = letter, head, []
        while True:
            pointers.append(least(rank)[reach])
            if 1 << len(pointers) > 3 * self.size.max(initial=1):  # an audit has three letters a row at most
                break
            rank = np.unique(rank * many + rank[pointers[-1]], return_inverse=True)[1]
            reach = reach[pointers[-1]]
        entry = least(rank)[self.place[self.first, None] * STATES + np.arange(STATES)]
        texts: list[list[str]] = [[]] * len(self.first)
        exits = np.zeros(entry.shape, np.int64)
        length = np.ceil(np.log2(3 * self.size + 1)).astype(int)
        for bits in np.unique(length):  # segments of about one length at once
            which = np.flatnonzero(length == bits)
            path = entry[which].reshape(-1, 1)
            for pointer in reversed(pointers[:bits]):  # arcs at every 2^k-th letter, then those half way between
                path = np.stack((path, pointer[path]), 2).reshape(len(path), -1)
            letters = code[path].astype(np.uint8)
            exits[which] = (head[path[:, -1]] % STATES).reshape(-1, STATES)
            flat = [bytes(row[row > 0]).decode() for row in letters]
            for n, at in enumerate(which):
                texts[at] = flat[n * STATES : (n + 1) * STATES]
        return texts, exits


SEGMENT = "at long, size long, conv_id long, cost array<long>, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"

EMPTY_SEGMENTS = pa.table({n: pa.array([], pa.list_(pa.int64()) if k.startswith("array") else pa.int64()) for n, k in (c.split() for c in SEGMENT.split(", "))})


def segments(block: pa.Table) -> pa.Table:
    """Cost matrix and counts of each segment of a block. The row before the block comes along to be compared with."""
    block = block.sort_by("pos")
    mine = block.filter(block["mine"])
    if not mine.num_rows:
        return EMPTY_SEGMENTS
    s = Segments(mine)
    before = Segments(block)
    pair = np.array([a + b for a, b in zip(before.initial[:-1], before.initial[1:])], object)
    inside = np.ones(len(before.pos), bool)
    inside[before.first] = False  # has a row of its conversation before it
    illegal = inside.copy()
    illegal[1:] &= ~np.isin(pair, ["su", "ua", "au"])
    turn, known = before.turn.fill_null(0).to_numpy(), np.asarray(before.turn.is_valid())
    changes = known.copy()
    changes[1:] &= ~(inside[1:] & known[:-1] & (turn[1:] == turn[:-1]))
    skip = len(before.pos) - len(s.pos)
    total = lambda flags: pa.array(np.add.reduceat(flags.astype(np.int64), s.first))
    end = np.iinfo(np.int64)
    low = np.minimum.reduceat(np.where(known, turn, end.max)[skip:], s.first)
    high = np.maximum.reduceat(np.where(known, turn, end.min)[skip:], s.first)
    some = np.add.reduceat(known[skip:].astype(np.int64), s.first) == 0
    matrix = pa.ListArray.from_arrays(np.arange(len(s.first) + 1, dtype=np.int32) * STATES**2, s.matrix().ravel())
    counts = [total(s.fault == kind) for kind in "BDT"]
    columns = [
        pa.array(s.pos[s.first]), pa.array(s.size), s.conv.take(pa.array(s.first)), matrix, *counts, total(illegal[skip:]), total(changes[skip:]),
        pa.array(low, mask=some), pa.array(high, mask=some),
    ]
    return pa.table(columns, ["at", "size", "conv_id", "cost", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"])


SOLVED = "at long, size long, conv_id long, codes array<string>, exits array<int>"


def solved(block: pa.Table, behind: pa.Table) -> pa.Table:
    """Codes and exit of each segment for each state it may be entered in, from the costs behind it."""
    s = Segments(block)
    ends = np.array(behind.sort_by("at")["ends"].to_pylist(), np.int64)
    texts, exits = s.least_paths(ends)
    columns = [pa.array(s.pos[s.first]), pa.array(s.size), s.conv.take(pa.array(s.first)), pa.array(texts, pa.list_(pa.string())), pa.array(exits.tolist(), pa.list_(pa.int32()))]
    return pa.table(columns, ["at", "size", "conv_id", "codes", "exits"])


def _then(one: Column, two: Column) -> Column:
    """Cost matrix of two segments one after the other."""
    cell = lambda i, j: F.least(*[one[i * STATES + k] + two[k * STATES + j] for k in range(STATES)], F.lit(FAR))
    return F.array(*[cell(i, j) for i in range(STATES) for j in range(STATES)])


def _ending(cost: Column) -> Column:
    """Costs in each state before segments that end a conversation."""
    return F.array(*[F.least(*[cost[i * STATES + k] + int(ENDING[k]) for k in range(STATES)]) for i in range(STATES)])


def _followed(one: DataFrame, two: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``one`` with ``columns`` of the row of ``two`` that begins where it ends, in the same conversation, or null."""
    other = two.select(F.col("at").alias("_at"), F.col("conv_id").alias("_conv"), *[F.col(c).alias(n) for n, c in columns.items()])
    return one.join(other, (one["at"] + one["size"] == other["_at"]) & one["conv_id"].eqNullSafe(other["_conv"]), "left").drop("_at", "_conv")


def _rounds(table: DataFrame) -> tuple[DataFrame, int]:
    """The segments of conversations that have several, and how often reach must double to span the most."""
    several = table.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    several = materialize(several.withColumnRenamed("conv_id", "_conv"), "repair-long")
    most = several.agg(F.max("n")).first()[0] or 1
    return table.join(several, table["conv_id"].eqNullSafe(several["_conv"]), "left_semi"), (most - 1).bit_length()


def costs_behind(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``at`` and ``ends``, the costs behind each segment; and the matrix from each segment on, ``onward``."""
    reach, rounds = _rounds(parts.select("at", "size", "conv_id", "cost"))
    for _ in range(rounds):
        far = _followed(reach, reach, {"_cost": "cost", "_size": "size"})
        cost = F.when(F.col("_cost").isNull(), F.col("cost")).otherwise(_then(F.col("cost"), F.col("_cost")))
        reach = materialize(far.select("at", (F.col("size") + F.coalesce("_size", F.lit(0))).alias("size"), "conv_id", cost.alias("cost")), "repair-reach")
    ends = _followed(parts.select("at", "size", "conv_id"), reach, {"_cost": "cost"})
    nothing = F.array(*[F.lit(int(c)).cast("long") for c in ENDING])
    ends = ends.select("at", F.when(F.col("_cost").isNull(), nothing).otherwise(_ending(F.col("_cost"))).alias("ends"))
    return ends, reach.select(F.col("at").alias("_at"), F.col("cost").alias("onward"))


def entered(done: DataFrame) -> DataFrame:
    """Solved segments with the state they are entered in, ``entry``."""
    reach, rounds = _rounds(done.select("at", "size", "conv_id", "exits"))
    for _ in range(rounds):
        other = reach.select((F.col("at") + F.col("size")).alias("_end"), F.col("conv_id").alias("_conv"), F.col("size").alias("_size"), F.col("exits").alias("_exits"))
        far = reach.join(other, (reach["at"] == other["_end"]) & reach["conv_id"].eqNullSafe(other["_conv"]), "left")
        more, both = F.coalesce("_size", F.lit(0)), F.transform("_exits", lambda q: F.element_at("exits", q + 1))
        exits = F.when(F.col("_exits").isNull(), F.col("exits")).otherwise(both)
        reach = materialize(far.select((F.col("at") - more).alias("at"), (F.col("size") + more).alias("size"), "conv_id", exits.alias("exits")), "repair-entries")
    before = reach.select((F.col("at") + F.col("size")).alias("_at"), F.col("conv_id").alias("_conv"), F.element_at("exits", START + 1).alias("entry"))
    rows = done.join(before, (done["at"] == before["_at"]) & done["conv_id"].eqNullSafe(before["_conv"]), "left")
    return rows.select("at", "size", done["conv_id"], "codes", "exits", F.coalesce("entry", F.lit(START)).alias("entry"))


REPAIRED = "conv_id long, codes string, repaired_sha256 string"


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows (``conv_id, pos, codes, ending, role, text``): a segment's codes, then its rows; one row per conversation."""
    conv, open_, digest, empty, written, tokens = None, False, None, True, [], iter(())

    def insert(codes: str) -> None:
        nonlocal empty
        for code in codes:
            digest.update((b"" if empty else b"\n") + (b"user:" if code == "I" else b"assistant:"))
            empty = False

    def closed() -> tuple[str, str]:
        return "".join(written), digest.hexdigest()

    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "codes", "role", "text")]
        for row_conv, codes, role, text in zip(*columns):
            if not open_ or row_conv != conv:
                if open_:
                    out.append((conv, *closed()))
                conv, open_, digest, empty, written = row_conv, True, hashlib.sha256(), True, []
            if codes is not None:
                written.append(codes)
                if role is not None:  # behind the last row
                    insert(codes)
                else:
                    tokens = iter(codes)
                continue
            for code in tokens:
                if code in "Ii":
                    insert(code)
                    continue
                if code != "D":
                    said = role if code == "K" else "user" if code == "R" else "assistant"
                    digest.update((("" if empty else "\n") + said + ":" + text).encode("utf-8", "surrogatepass"))
                    empty = False
                break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.string()))], ["conv_id", "codes", "repaired_sha256"])
    if open_:
        row = zip((conv, *closed()), (pa.int64(), pa.string(), pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in row], ["conv_id", "codes", "repaired_sha256"])


def streamed(rows: DataFrame, states: DataFrame, last: DataFrame) -> DataFrame:
    """Edits and texts of each conversation in order: codes before the rows of a segment, rows, and the codes behind the last row."""
    chosen = F.element_at("codes", F.col("entry") + 1)
    none = F.lit(None).cast("string")
    heads = states.select("conv_id", F.col("at").alias("pos"), F.lit(0).alias("kind"), chosen.alias("codes"), none.alias("role"), none.alias("text"))
    leaving = F.element_at("exits", F.col("entry") + 1)
    closing = F.when(leaving == SYSTEM, "Ii").when(leaving == USER, "i")
    tails = states.join(last, "at").where(closing.isNotNull())
    tails = tails.select("conv_id", (F.col("at") + F.col("size")).alias("pos"), F.lit(-1).alias("kind"), closing.alias("codes"), F.lit("").alias("role"), none.alias("text"))
    said = rows.select("conv_id", "pos", F.lit(1).alias("kind"), none.alias("codes"), "role", "text")
    return heads.unionByName(tails).unionByName(said)


def repaired(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (``conv_id, turn, role, text``) per conversation: counts and cost; and the edits' codes with the checksum."""
    rows = placed(rows)
    flagged = materialize(faults(rows).withColumn("block", F.floor(F.col("pos") / block)), "repair-faults")
    following = F.when(F.col("pos") % block == block - 1, F.array(F.struct(F.lit(False).alias("mine"), (F.col("block") + 1).alias("to")))).otherwise(F.array())
    sent = F.explode(F.concat(F.array(F.struct(F.lit(True).alias("mine"), F.col("block").alias("to"))), following))
    seen = flagged.withColumn("_s", sent).select("pos", "conv_id", "turn", "initial", "fault", F.col("_s.mine").alias("mine"), F.col("_s.to").alias("to"))
    parts = materialize(seen.groupBy("to").applyInArrow(segments, SEGMENT), "repair-segments")
    behind, onward = costs_behind(parts)
    behind = materialize(behind.withColumn("block", F.floor(F.col("at") / block)), "repair-behind")
    done = flagged.select("pos", "conv_id", "turn", "initial", "fault", "block").groupBy("block").cogroup(behind.groupBy("block")).applyInArrow(solved, SOLVED)
    states = materialize(entered(materialize(done, "repair-solved")), "repair-states")
    last = parts.groupBy("conv_id").agg(F.max("at").alias("at")).select("at")
    ordered = streamed(rows, states, last).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
    edits = ordered.select("conv_id", "codes", "role", "text").mapInArrow(checksums, REPAIRED)
    first = F.min_by(F.struct("at", "cost"), "at")
    counts = parts.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")], F.min("low").alias("low"), F.max("high").alias("high"), first.alias("f")
    ).join(onward, F.col("f.at") == F.col("_at"), "left")
    whole = _ending(F.coalesce("onward", "f.cost"))[START]
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return counts.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", whole.alias("cost")), edits


def report(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conversation of the table, damaged and repaired: its counts, cost, audit and the checksum of what it reads like then."""
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    counts, edits = repaired(damaged(conversations), block)
    counts, edits = materialize(counts, "repair-counts"), materialize(edits, "repair-edits")
    counts, edits = counts.withColumnRenamed("conv_id", "_conv"), edits.withColumnRenamed("conv_id", "_edited")
    rows = ids.join(counts, ids["conv_id"].eqNullSafe(counts["_conv"]), "left").join(edits, ids["conv_id"].eqNullSafe(edits["_edited"]), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select(
        "conv_id", *zero, audit(F.coalesce("codes", F.lit(""))).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
