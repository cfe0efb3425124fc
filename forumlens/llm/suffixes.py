"""Repeated passages by sparse suffix arrays.

Only suffixes that begin at minimisers are kept: in each window of consecutive word 8-grams the one with the
smallest hash. A passage of ``MIN_WORDS`` words holds a whole window, so its copies keep the same suffix. Of
those whose 8-gram occurs in several rows, the words after (and before) are sorted across the cluster, and
each suffix is compared with its neighbours of other rows, from the 8-gram to the right and to the left. Sorted
once by what follows and once by what precedes, the neighbour with the longest match on a side is next to it.
A match that adds up to ``MIN_WORDS`` is a span; a row's spans are merged.

The neighbour that follows a suffix furthest to the right and the one that follows it furthest to the left bound
what any partner can share. Where the two matches cover all of that, or it is too short for a span, the suffix is settled.
Otherwise, as when the best partner over both sides is a neighbour on neither, all suffixes of that 8-gram begin anew at
each word before it: their first ``MIN_WORDS`` words are compared by hash, each with those of all other rows. So are suffixes of a row that repeats an 8-gram across the end of a task.

Suffixes are range-partitioned with their row as the last key, so a passage that most rows share is spread over
tasks; the first and last suffixes of each task (four at most) are compared on the driver.

Matching ignores the case of A-Z and the kind and amount of white space. Words beyond the 8-gram are compared
by 16 bits of their hash: one span end in 65,536 is a word too far.

Cases: null, empty and short texts hold no span. Repeats inside one row are no match. Rows repeated match each
other, null ``doc_id`` included. Other columns are not looked at. An empty table gives no rows. ``docs`` must be
read from Parquet files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import locator, probably_in
from forumlens.llm.shingles import mixed, words
from forumlens.runtime import materialize

MIN_WORDS = 50
GRAM = 8
CHUNK = 256  # documents hashed at once

_ODD = mixed(np.arange(101, 101 + GRAM, dtype=np.uint64)) | np.uint64(1)
_WINDOW_ODD = mixed(np.arange(201, 201 + MIN_WORDS, dtype=np.uint64)) | np.uint64(1)


def _sliding(values: np.ndarray, wide: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each window of ``wide`` values, by doubling."""
    done, reach = values, 1
    while reach < wide:
        step = min(reach, wide - reach)
        done, reach = pick(done[:-step], done[step:]), reach + step
    return done


def _grams(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the word 8-grams."""
    many = len(hashes) - GRAM + 1
    return mixed(sum((hashes[k : k + many] * _ODD[k] for k in range(1, GRAM)), hashes[:many] * _ODD[0]))


def minimisers(hashes: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which suffixes are kept, and the hashes of the 8-grams there."""
    if len(hashes) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams, wide = _grams(hashes), least - GRAM + 1
    lowest = _sliding(grams, wide, np.minimum)
    edge = np.zeros(wide - 1, np.uint64)
    reached = _sliding(np.concatenate((edge, lowest, edge)), wide, np.maximum)
    at = np.flatnonzero(reached == grams)
    return at, grams[at]


def anchors(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """One row per document that is long enough: its place, ``doc_id`` and the ``keys`` and ``at`` of its suffixes."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(start, CHUNK)
                hashes, begins = words(batch.column(3).to_pylist())
                found = [minimisers(hashes[a:b], least) for a, b in zip(begins[:-1], begins[1:])]
                sizes = np.cumsum([0] + [len(at) for at, _ in found]).astype(np.int32)
                at = np.concatenate([f[0] for f in found]).astype(np.int32)
                keys = np.concatenate([f[1] for f in found]).view(np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(sizes), pa.array(v)) for v in (keys, at)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], ["doc_id", "file", "nth", "keys", "at"])

    placed = docs.select(F.col("doc_id").cast("long"), *locator("file", "nth"), "text")
    found = placed.mapInArrow(keep, "doc_id long, file string, nth long, keys array<long>, at array<int>")
    return found.where("size(at) > 0").withColumn("row", F.monotonically_increasing_id())


def shared_suffixes(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``row``, ``doc_id``, place and ``s`` (``at`` and ``key``) of the kept suffixes whose 8-gram occurs in several rows."""
    kept = materialize(anchors(docs, least), "suffix-anchors")
    each = kept.select("row", F.explode(F.arrays_zip("keys", "at")).alias("s")).select("row", F.col("s.keys").alias("key"), F.col("s.at").alias("at"))
    shared = each.groupBy("key").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first != last").select("key")
    shared = materialize(shared, "suffix-keys")  # apart from its aggregate, the join can split a key that many rows hold
    wanted = each.join(shared, "key").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "key"))).alias("s"))
    return materialize(wanted.join(kept.select("row", "doc_id", "file", "nth"), "row"), "suffix-wanted")


def open_suffixes(wanted: DataFrame, reach: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``wanted`` with the suffixes of unsettled keys only."""
    keys = materialize(unsettled(reach, least), "suffix-open")
    each = wanted.select("row", "doc_id", "file", "nth", F.explode("s").alias("s")).withColumn("key", F.col("s.key"))
    left = each.join(keys, "key").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("file").alias("file"), F.first("nth").alias("nth"), F.collect_list("s").alias("s"))
    return materialize(left, "suffix-again")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Place and text of the rows of ``wanted`` and of few others: the join with ``wanted`` need not move all texts."""
    return probably_in(docs.select(*locator("file", "nth"), "text"), wanted, ["file", "nth"])


def windows(docs: DataFrame, wanted: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Spans of ``least`` words that another row holds, found by their hash among the windows whose minimiser is a suffix of ``wanted``."""
    offsets = sorted({*range(0, least - GRAM, GRAM), least - GRAM})  # 8-grams that hold every word

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(start, CHUNK)
                hashes, begins = words(batch.column(0).to_pylist())
                bounds, keys = batch.column(2).offsets.to_numpy(), batch.column(2).flatten().to_numpy().view(np.uint64)
                for n, (a, b) in enumerate(zip(begins[:-1], begins[1:])):
                    grams, many = _grams(hashes[a:b]), b - a - least + 1
                    shared = keys[bounds[n] - bounds[0] : bounds[n + 1] - bounds[0]]
                    at = np.flatnonzero(np.isin(_sliding(grams, least - GRAM + 1, np.minimum), shared))
                    if len(at):
                        window = mixed(sum(grams[o : o + many] * _WINDOW_ODD[k] for k, o in enumerate(offsets)))[at]
                        rows = batch.column(1).take(pa.array(np.full(len(at), n)))
                        yield pa.RecordBatch.from_arrays([pa.array(window.view(np.int64)), rows, pa.array(at.astype(np.int32))], ["window", "row", "at"])

    texts = texts_of(docs, wanted).join(wanted, ["file", "nth"])
    each = texts.select("text", "row", F.col("s.key").alias("keys")).mapInArrow(hashed, "window long, row long, at int")
    each = materialize(each, "suffix-windows")
    held = each.groupBy("window").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low != high")
    held = materialize(held, "suffix-held")  # apart from its aggregate, the join can split a window that many rows hold
    found = each.join(held, "window").withColumn("other", F.when(F.col("row") == F.col("low"), F.col("high")).otherwise(F.col("low")))
    # a row's windows that follow on each other with one other row are one span
    order = Window.partitionBy("row", "other").orderBy("at")
    runs = found.select("row", "other", "at", (F.col("at") - F.row_number().over(order)).alias("run"))
    spans = runs.groupBy("row", "other", "run").agg(F.min("at").alias("first"), (F.max("at") + least).alias("last"))
    spans = materialize(spans, "suffix-window-spans")
    ids = wanted.select("row", "doc_id")
    others = ids.select(F.col("row").alias("other"), F.col("doc_id").alias("other_id"))
    return spans.join(ids, "row").join(others, "other").select("row", "doc_id", "first", "last", "other_id")


def suffixes(docs: DataFrame, least: int = MIN_WORDS, wanted: DataFrame | None = None) -> DataFrame:
    """The kept suffixes whose 8-gram occurs in several rows: ``key, row, doc_id, at, right, left``.

    ``right`` are the words after the 8-gram, ``left`` those before it, nearest first; two bytes a word, and
    as many words as a span may need.
    """
    wanted = shared_suffixes(docs, least) if wanted is None else wanted

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(start, CHUNK)
                hashes, begins = words(batch.column(0).to_pylist())
                low = hashes.astype(np.uint16)
                places, keys = batch.column(3), batch.column(4)
                many = np.diff(places.offsets.to_numpy())
                at, key = places.flatten().to_numpy(), keys.flatten()
                first, end = np.repeat(begins[:-1], many), np.repeat(begins[1:], many)
                right, left = [], []
                for a, lo, hi in zip(at + first, first, end):
                    right.append(low[a + GRAM : min(a + least, hi)].tobytes())
                    left.append(low[max(a - least, lo) : a][::-1].tobytes())
                spread = pa.array(np.repeat(np.arange(batch.num_rows), many))
                yield pa.RecordBatch.from_arrays(
                    [key, batch.column(1).take(spread), batch.column(2).take(spread), pa.array(at), pa.array(right, pa.binary()), pa.array(left, pa.binary())],
                    ["key", "row", "doc_id", "at", "right", "left"],
                )

    texts = texts_of(docs, wanted).join(wanted, ["file", "nth"])
    texts = texts.select("text", "row", "doc_id", F.col("s.at").alias("at"), F.col("s.key").alias("keys"))
    return texts.mapInArrow(cut, "key long, row long, doc_id long, at int, right binary, left binary")


def _common(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """How many words each pair has in common from the start."""
    out = np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b)):
        short = min(len(x), len(y))
        if x[:short] == y[:short]:
            out[i] = short // 2
        else:
            differ = np.frombuffer(x, np.uint16, short // 2) != np.frombuffer(y, np.uint16, short // 2)
            out[i] = differ.argmax()
    return out


SPANS = "row long, doc_id long, first int, last int, other_id long"


def _pairs(rows: dict[str, np.ndarray], one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
    """Those of the pairs that have the 8-gram in common and lie in different rows, and the words in common from it on and before it."""
    alike = (rows["key"][one] == rows["key"][two]) & (rows["row"][one] != rows["row"][two])
    one, two = one[alike], two[alike]
    return one, two, _common(rows["right"][one], rows["right"][two]) + GRAM, _common(rows["left"][one], rows["left"][two])


def _spans(rows: dict[str, np.ndarray], pairs: tuple[np.ndarray, ...], least: int) -> pa.RecordBatch:
    """Spans of the first suffixes of ``pairs`` that are long enough with the second."""
    long = pairs[2] + pairs[3] >= least
    one, two, after, before = (x[long] for x in pairs)
    at = rows["at"][one]
    columns = (rows["row"][one], at - before, at + after)
    ids = [pa.array(rows["doc_id"][i], pa.int64()) for i in (one, two)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), ids[0], pa.array(columns[1].astype(np.int32)), pa.array(columns[2].astype(np.int32)), ids[1]],
        ["row", "doc_id", "first", "last", "other_id"],
    )


#: A reach is ``_STEP`` times the words matched on the sorted side, and one more than those on the other if both make a span.
_STEP = 128


def _reaches(rows: dict[str, np.ndarray], pairs: list[tuple[np.ndarray, ...]], by: str, least: int) -> np.ndarray:
    """For each suffix how far its best neighbour follows it on the side ``by``; 0 where none shares the 8-gram."""
    reach = np.zeros(len(rows["key"]), np.int32)
    for one, _, after, before in pairs:
        near, far = (after, before) if by == "right" else (before, after)
        np.maximum.at(reach, one, (near * _STEP + np.where(after + before >= least, far + 1, 0)).astype(np.int32))
    return reach


def unsettled(reach: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """The keys of which some suffix may share more with another row than its two neighbours show.

    ``reach`` has ``key``, ``row``, ``at``, ``by`` and ``reach`` of every suffix from either order.
    """
    best = {by: F.coalesce(F.max(F.when(F.col("by") == by, F.col("reach"))), F.lit(0)) for by in ("right", "left")}
    each = reach.groupBy("row", "at").agg(F.first("key").alias("key"), *[v.alias(by) for by, v in best.items()])
    after, before = (F.floor(F.col(by) / _STEP) for by in ("right", "left"))
    # the words before, and after, that the best match on the other side has as well; 0 if that is no span
    with_before, with_after = F.col("right") % _STEP, F.col("left") % _STEP
    settled = (with_before > before) | (with_after > after) | ((with_before > 0) & (with_after > 0))
    return each.where((after + before >= least) & ~settled).select("key").distinct()


def _rows(table: pa.Table) -> dict[str, np.ndarray]:
    out = {n: table[n].to_numpy() for n in ("key", "row", "at")}
    for n in ("right", "left", "doc_id"):
        out[n] = np.array([None, *table[n].to_pylist()], object)[1:]
    return out


def _runs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the first and the last of the neighbouring suffixes of the same row."""
    fresh = np.concatenate(([True], rows["row"][1:] != rows["row"][:-1]))
    starts = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    return starts[run], np.concatenate((starts[1:], [len(run)]))[run] - 1


def neighbours(suffix_rows: DataFrame, by: str, least: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Spans found between neighbours in the order of the key and the words on one side (``right`` or ``left``), and all reaches."""
    spark = suffix_rows.sparkSession
    edge_columns = ["key", "row", "doc_id", "at", "right", "left"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: pa.Table | None = None
        head: pa.Table | None = None
        tail: pa.Table | None = None
        ending: tuple = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            rows = _rows(table)
            first, last = _runs(rows)
            index = np.arange(len(first))
            pairs = []
            for one, two in ((index, first - 1), (index, last + 1)):
                there = (two >= 0) & (two < len(index))
                pairs.append(_pairs(rows, one[there], two[there]))
                yield _with(task, found=_spans(rows, pairs[-1], least))
            reach = _reaches(rows, pairs, by, least)
            edges = np.unique(np.concatenate((first, last)))
            if head is None:
                head = table.take(edges[:3])
                # inside a run at the end of a task, suffixes do not see the row beyond it
                reach[1 : last[0]] = least * _STEP
            yield _with(task, reach=(rows, reach))
            ending = (rows, np.arange(first[-1] + 1, last[-1]))
            tail = table.take(edges[-3:])
            # the last run and the suffix before it meet the next batch
            held = table.slice(max(first[-1] - 1, 0))
        if head is not None:
            rows, inside = ending
            yield _with(task, reach=({n: rows[n][inside] for n in ("key", "row", "at")}, np.full(len(inside), least * _STEP, np.int32)))
            for side, kept in (("head", head), ("tail", tail)):
                yield _with(task, edges=kept, side=side)

    schema = SPANS + ", task int, side string, edge struct<key: long, row: long, doc_id: long, at: int, right: binary, left: binary>, key long, at int, reach int"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", by, "row", "at"]
    found = materialize(
        suffix_rows.select(*edge_columns).repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(compare, schema), f"suffix-{by}"
    )
    spans, reaches = _across(found, by, least)
    reach = found.where("side = 'reach'").select("key", "row", "at", "reach").unionByName(reaches).withColumn("by", F.lit(by))
    return found.where("side is null").select("row", "doc_id", "first", "last", "other_id").unionByName(spans), reach


_EDGE = [("key", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32()), ("right", pa.binary()), ("left", pa.binary())]
_REACH = "key long, row long, at int, reach int"


def _with(task: int, found: pa.RecordBatch | None = None, reach: tuple | None = None, edges: pa.Table | None = None, side: str | None = None) -> pa.RecordBatch:
    """Spans, reaches or edges as rows of one table."""
    names = ["row", "doc_id", "first", "last", "other_id", "task", "side", "edge", "key", "at", "reach"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.struct(_EDGE), pa.int64(), pa.int32(), pa.int32()]
    filled: dict = {}
    if found is not None:
        many = found.num_rows
        filled = dict(zip(found.schema.names, found.columns))
    elif reach is not None:
        rows, values = reach
        many, side = len(values), "reach"
        filled = {"row": pa.array(rows["row"]), "key": pa.array(rows["key"]), "at": pa.array(rows["at"]), "reach": pa.array(values)}
    else:
        many = edges.num_rows
        filled = {"edge": pa.array(edges.to_pylist(), pa.struct(_EDGE))}
    filled |= {"task": pa.repeat(pa.scalar(task, pa.int32()), many), "side": pa.repeat(pa.scalar(side, pa.string()), many)}
    return pa.RecordBatch.from_arrays([filled.get(n, pa.nulls(many, k)).cast(k) for n, k in zip(names, kinds)], names)


def _across(found: DataFrame, by: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Spans and reaches between the last suffixes of a task and the first of the next that has any."""
    edges = found.where("side in ('head', 'tail')").select("task", "side", "edge.*").collect()  # six rows a task at most
    ends: dict[int, dict[str, list]] = {}
    for e in edges:
        ends.setdefault(e["task"], {"head": [], "tail": []})[e["side"]].append(e)
    out, reaches, tasks = [], [], sorted(ends)
    for task, after in zip(tasks, tasks[1:]):
        held = ends[task]["tail"] + ends[after]["head"]
        rows = _rows(pa.Table.from_pylist([{n: r[n] for n in ("key", "row", "doc_id", "at", "right", "left")} for r in held]))
        pairs = [(i, j) for i in range(len(ends[task]["tail"])) for j in range(len(ends[task]["tail"]), len(held))]
        one, two = (np.array(p) for p in zip(*pairs))
        both = [_pairs(rows, x, y) for x, y in ((one, two), (two, one))]
        for x in both:
            out += [tuple(r.values()) for r in _spans(rows, x, least).to_pylist()]
        reaches += zip(*[rows[n].tolist() for n in ("key", "row", "at")], _reaches(rows, both, by, least).tolist())
    spark = found.sparkSession
    return spark.createDataFrame(out, SPANS), spark.createDataFrame(reaches, _REACH)


def repeated_spans(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``first_word``, ``n_words`` of each passage that another document repeats, and one such ``other_id``."""
    wanted = shared_suffixes(docs, least)
    kept = materialize(suffixes(docs, least, wanted), "suffix-rows")
    right, after = neighbours(kept, "right", least)
    left, before = neighbours(kept, "left", least)
    again = open_suffixes(wanted, after.unionByName(before), least)
    found = right.unionByName(left).unionByName(windows(docs, again, least))
    order = Window.partitionBy("row").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("fresh", F.when(F.col("first") <= before, 0).otherwise(1)).withColumn("island", F.sum("fresh").over(order))
    longest = F.max_by("other_id", F.struct(F.col("last") - F.col("first"), -F.coalesce("other_id", F.lit(0))))
    merged = islands.groupBy("row", "island").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first_word"), F.max("last").alias("last"), longest.alias("other_id")
    )
    return merged.select("doc_id", "first_word", (F.col("last") - F.col("first_word")).alias("n_words"), "other_id")
