"""Near-duplicate classes by chosen-path set similarity search.

A document is its set of five-word shingles. Equal sets are one class from the start. Every tree begins with
all classes in one node; a node chooses one or two minwise tokens, and its members branch by their values of
those tokens. Nodes of few members are leaves and compared exhaustively on their signatures; independent
trees bring the recall to its target. A pair of similarity J shares a child with probability J for each chosen
token, so with 8 trees and 4/3 tokens a node a pair at 0.75 is missed by all first levels once in a million.

Candidates are confirmed on full sets: first each class with its best candidate, then, in leaves where
candidates are still in different components, every member outside the leaf's largest component with all other
members sent there. Links are joined to components by star contraction.

A node that does not get small in ``LEVELS`` levels holds members alike in that many tokens. It is cut into leaves by
hash, and a few of its members are pivots in all of them, which joins a family of near copies in one pass. What is
then still outside the node's largest component meets every member: both sides are dealt in parts, and each pair of
parts is a leaf. So no pair of a cut node is left out; the work is the members outside times all members, in blocks.

Cases: A-Z are lower-cased; null texts and texts without words have no shingles, are linked with nothing, and
are their own component if their ``doc_id`` is null too. Rows repeated share a component. A null ``doc_id`` is
never a component's name unless all are null. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import locator
from forumlens.llm.components import components
from forumlens.llm.shingles import mixed, shingle_sets
from forumlens.runtime import materialize

SIMILARITY = 75  # percent
TREES = 8
TOKENS = 128  # of a signature
SECOND = 3  # one node in so many chooses a second token
LEAF = 1024
LEVELS = 8
PIVOTS = 16
ESTIMATE = 0.64  # least estimated similarity of a candidate: three standard deviations below 0.75
CHUNK = 256  # documents shingled at once
SET_BYTES = 6  # kept of each shingle's hash in a set

_ODD = mixed(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(2)) | np.uint64(1)


def signatures(docs: DataFrame) -> DataFrame:
    """``row`` (a number for each row), its ``doc_id`` and place, ``n_shingles``, two hashes of the set, its minwise tokens.

    ``tokens`` are 32-bit and decide branches; ``low`` are their lower halves, which are compared.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                grams, begins = shingle_sets(batch.column(3).to_pylist())
                count = np.diff(begins)
                some = begins[:-1][count > 0]
                tokens = np.zeros((len(count), TOKENS), np.uint32)
                both = np.zeros((len(count), 2), np.uint64)
                if len(some):
                    for k in range(TOKENS):
                        tokens[count > 0, k] = np.minimum.reduceat(((grams * _ODD[k]) >> np.uint64(32)).astype(np.uint32), some)
                    both[count > 0, 0] = np.add.reduceat(mixed(grams), some)
                    both[count > 0, 1] = np.add.reduceat(mixed(grams + np.uint64(1)), some)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:3], pa.array(count.astype(np.int64)), pa.array(both[:, 0].view(np.int64)), pa.array(both[:, 1].view(np.int64)),
                        pa.array([t.tobytes() for t in tokens], pa.binary()), pa.array([t.tobytes() for t in tokens.astype(np.uint16)], pa.binary()),
                    ],
                    ["doc_id", "file", "at", "n_shingles", "set_a", "set_b", "tokens", "low"],
                )

    signed = docs.select(F.col("doc_id").cast("long"), *locator("file", "at"), "text").mapInArrow(
        sign, "doc_id long, file string, at long, n_shingles long, set_a long, set_b long, tokens binary, low binary"
    )
    return signed.withColumn("row", F.monotonically_increasing_id())


def _chosen(nodes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The tokens each node branches by: (which nodes, token numbers)."""
    h = mixed(nodes ^ np.uint64(0x5851F42D4C957F2D))
    second = np.flatnonzero((h >> np.uint64(40)) % np.uint64(SECOND) == 0)
    one = (h % np.uint64(TOKENS)).astype(np.int64)
    two = (one + 1 + ((h >> np.uint64(20)) % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS
    return [(np.arange(len(nodes)), one), (second, two[second])]


def _branch(members: DataFrame) -> DataFrame:
    """Children of each (``node``, ``row``, ``tokens``)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column(0).to_numpy().view(np.uint64)
            rows = batch.column(1).to_numpy()
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, TOKENS)
            for at, token in _chosen(nodes):
                value = tokens[at, token].astype(np.uint64) << np.uint64(8) | token.astype(np.uint64)
                child = mixed(nodes[at] * np.uint64(3) + mixed(value + np.uint64(1)))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(rows[at])], ["node", "row"])

    return members.select("node", "row", "tokens").mapInArrow(step, "node long, row long")


def leaves(signed: DataFrame, left_out: DataFrame, trees: int = TREES) -> tuple[DataFrame, DataFrame | None]:
    """``node`` and ``row`` of every leaf of at least two members, and of the nodes that were cut into leaves, if any.

    ``signed`` has ``row`` and ``tokens``; the rows in ``left_out`` are dropped as narrow members, which spares
    a shuffle of the tokens.
    """
    roots = F.explode(F.array(*[F.lit(int(r)) for r in mixed(np.arange(1, trees + 1, dtype=np.uint64)).view(np.int64)]))
    members = _branch(signed.select(roots.alias("node"), "row", "tokens")).join(left_out, "row", "left_anti")
    members, done = materialize(members, "path-members"), None
    for level in range(1, LEVELS + 1):
        # written apart, so that the join can split a node that many rows are in
        sizes = materialize(members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "path-sizes")
        members = materialize(members.join(sizes, "node"), "path-nodes")
        small = members.where(F.col("size") <= LEAF).select("node", "row")
        done = small if done is None else done.unionByName(small)
        members = members.where(F.col("size") > LEAF)
        if members.isEmpty():
            return done, None
        if level < LEVELS:
            members = materialize(_branch(members.join(signed.select("row", "tokens"), "row")), "path-members")
    return done.unionByName(_cut(members)), members.select("node", "row")


def _cut(members: DataFrame) -> DataFrame:
    """Leaves of nodes that stayed large: parts by hash, and the same pivots in each."""
    parts = F.ceil(F.col("size") / (LEAF // 2))
    part = F.pmod(F.xxhash64("node", "row"), parts)
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("row", "node"), "row"))
    pivots = members.withColumn("nth", first).where(F.col("nth") <= PIVOTS)
    copies = pivots.select("node", "row", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    dealt = members.select("node", "row", part.alias("part")).unionByName(copies).distinct()
    return dealt.select(F.xxhash64("node", "part").alias("node"), "row")


def across(deep: DataFrame, roots: DataFrame) -> DataFrame:
    """Leaves (``node``, ``row``, ``root``) in which members of cut nodes outside the largest component meet all members.

    Half a leaf are members outside, half are any members; every pair of such halves is a leaf of its own.
    """
    rooted = deep.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    rooted = materialize(rooted, "path-deep")
    by_root = rooted.groupBy("node", "root").agg(F.count("*").alias("n"))
    largest = by_root.groupBy("node").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("size")).where("main.n < size")
    half = LEAF // 2
    # one row per cut node, written apart so that the join can split a node
    largest = materialize(
        largest.select("node", F.col("main.root").alias("main"), F.ceil((F.col("size") - F.col("main.n")) / half).alias("asking"), F.ceil(F.col("size") / half).alias("asked")),
        "path-largest",
    )
    members = rooted.join(largest, "node")
    own = F.xxhash64("row", "node")

    def dealt(rows: DataFrame, mine: str, other: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other)
        return rows.select("node", "row", "root", F.pmod(own, F.col(mine)).alias(mine), each)

    met = dealt(members, "asked", "asking").unionByName(dealt(members.where("root != main"), "asking", "asked"))
    return met.select(F.xxhash64("node", "asking", "asked").alias("node"), "row", "root").distinct()


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches (``node`` first), cut so that no node is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy()
        cut = int(np.searchsorted(nodes, nodes[-1]))  # signed and sorted
        if cut or (held and held[-1].column(0)[-1].as_py() != nodes[0]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _leaf_rows(members: DataFrame) -> DataFrame:
    return members.repartition("node").sortWithinPartitions("node", "row")


def candidates(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Best candidate of each (``node``, ``row``) in another component: ``other`` and ``estimate``; ``members`` has ``root``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_node(batches):
            node, row, root = (table.column(i).to_numpy() for i in range(3))
            low = np.frombuffer(b"".join(table.column(3).to_pylist()), np.uint16).reshape(-1, TOKENS)
            best, other = np.zeros(len(node), np.int32), np.full(len(node), -1)
            at, apart = np.arange(len(node)), 1
            while True:
                at = at[at + apart < len(node)]
                at = at[node[at] == node[at + apart]]
                if not len(at):
                    break
                for some in np.array_split(at, len(at) // 4096 + 1):
                    some = some[root[some] != root[some + apart]]
                    same = (low[some] == low[some + apart]).sum(axis=1, dtype=np.int32)
                    for x, y in ((some, some + apart), (some + apart, some)):
                        better = same > best[x]
                        best[x[better]], other[x[better]] = same[better], row[y[better]]
                apart += 1
            found = np.flatnonzero(best >= ESTIMATE * TOKENS)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (node[found], row[found], other[found], best[found])], ["node", "row", "other", "estimate"]
                )

    rows = members.join(classes.select("row", "low"), "row").select("node", "row", "root", "low")
    return _leaf_rows(rows).mapInArrow(compare, "node long, row long, other long, estimate int")


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``row`` and the full shingle set of the wanted rows, which have ``row`` and their place."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                grams, begins = shingle_sets(batch.column(1).to_pylist())
                kept = [
                    np.ascontiguousarray(grams[a:b].view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()
                    for a, b in zip(begins[:-1], begins[1:])
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], ["row", "set"])

    texts = docs.select(*locator("file", "at"), "text").join(wanted, ["file", "at"])
    return texts.select("row", "text").mapInArrow(shingle, "row long, set binary")


def confirmed(members: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Links ``a``, ``b`` found on full sets; ``members`` has ``node``, ``row``, ``root`` and ``set``.

    Members outside a node's largest component are compared with all of its members. A component needs one link
    to another, so each such member gives one link for each component it is linked with.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_node(batches):
            nodes = table.column(0).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1], [True])))
            left: list[int] = []
            right: list[int] = []
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > 1:
                    part = table.slice(a, b - a)
                    for x, y in _links(part.column(1).to_numpy(), part.column(2).to_numpy(), part.column(3).to_pylist(), percent):
                        left.append(x)
                        right.append(y)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    rows = members.select("node", "row", "root", "set")
    return _leaf_rows(rows).mapInArrow(compare, "a long, b long")


def _links(rows: np.ndarray, roots: np.ndarray, packed: list[bytes], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join what is linked: as many as members at most, since members once joined count as one component."""
    names, root = np.unique(roots, return_inverse=True)
    if len(names) == 1:
        return
    sizes = np.array([len(p) // SET_BYTES for p in packed])
    raw = np.zeros((sizes.sum(), 8), np.uint8)
    raw[:, :SET_BYTES] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, SET_BYTES)
    distinct, element = np.unique(raw.view(np.uint64).ravel(), return_inverse=True)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(len(distinct), np.int32)
    outside = np.flatnonzero(root != np.bincount(root).argmax())
    for x in outside:
        own = element[begins[x] : begins[x + 1]]
        mark[own] = 1
        shared = np.add.reduceat(mark[element], begins[:-1])
        mark[own] = 0
        linked = np.flatnonzero((100 * shared.astype(np.int64) >= percent * (sizes + sizes[x] - shared)) & (root != root[x]))
        joined, first = np.unique(root[linked], return_index=True)
        for y in linked[first]:
            yield int(rows[x]), int(rows[y])
        root[np.isin(root, joined)] = root[x]


def classes_of(docs: DataFrame, trees: int = TREES, percent: int = SIMILARITY) -> DataFrame:
    """``file``, ``at``, ``doc_id``, ``n_shingles``, ``component_id`` (its smallest ``doc_id``) and ``stays`` (one row of each component).

    ``docs`` must be read from Parquet files.
    """
    signed = materialize(signatures(docs), "path-signatures")
    keys = ["set_a", "set_b", "n_shingles"]
    first = materialize(signed.where("n_shingles > 0").groupBy(*keys).agg(F.min("row").alias("class")), "path-first")
    # one row per class on the right; a class of many copies is split by the adaptive skew join
    narrow = signed.select("row", "doc_id", "file", "at", *keys).join(first, keys, "left")
    narrow = materialize(narrow.select("row", "doc_id", "file", "at", "n_shingles", F.coalesce("class", "row").alias("class")), "path-classes")
    copies = narrow.where("row != class or n_shingles = 0").select("row")
    small, deep = leaves(signed, copies, trees)
    found = materialize(small, "path-leaves")
    places = narrow.select("row", "file", "at")

    alone = found.withColumn("root", F.col("row"))
    near = materialize(candidates(alone, signed), "path-candidates")
    best = near.groupBy("row").agg(F.max(F.struct("estimate", (-F.col("node")).alias("minus"), "other")).alias("b"))
    best = materialize(best.select("row", (-F.col("b.minus")).alias("node"), "b.other"), "path-best")
    sent = best.select("node", "row").unionByName(best.select("node", F.col("other").alias("row"))).distinct()
    grams = materialize(sets(docs, places.join(sent.select("row").distinct(), "row")), "path-sets")
    links = materialize(confirmed(sent.join(grams, "row").withColumn("root", F.col("row")), percent), "path-links")

    roots = materialize(components(links), "path-roots")
    rooted = near.select("node", "row").join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    several = rooted.groupBy("node").agg(F.min("root").alias("low_root"), F.max("root").alias("high_root")).where("low_root != high_root")
    several = materialize(several.select("node"), "path-several")
    still = materialize(rooted.join(several, "node"), "path-open")
    open_rows = materialize(candidates(still, signed).select("node", "row", "other"), "path-open-candidates")
    if not open_rows.isEmpty():
        both = open_rows.select("node", "row").unionByName(open_rows.select("node", F.col("other").alias("row"))).distinct()
        again = both.join(still, ["node", "row"]).join(grams, "row")  # all of them were candidates before
        links = links.unionByName(materialize(confirmed(again, percent), "path-links"))
        roots = materialize(components(links), "path-roots")
    if deep is not None:
        met = materialize(across(deep, roots), "path-across")
        pairs = materialize(candidates(met, signed).select("node", "row", "other"), "path-across-candidates")
        if not pairs.isEmpty():
            both = pairs.select("node", "row").unionByName(pairs.select("node", F.col("other").alias("row"))).distinct()
            unread = both.select("row").distinct().join(grams.select("row"), "row", "left_anti")
            grams = grams.unionByName(materialize(sets(docs, places.join(unread, "row")), "path-sets"))
            links = links.unionByName(materialize(confirmed(both.join(met, ["node", "row"]).join(grams, "row"), percent), "path-links"))
            roots = materialize(components(links), "path-roots")

    named = narrow.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = materialize(named.select("row", "file", "at", "doc_id", "n_shingles", "root"), "path-named")
    order = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    leads = materialize(named.groupBy("root").agg(order.alias("lead")), "path-leads")  # apart, so that the join can split a component
    return named.join(leads, "root").select(
        "file", "at", "doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id"), (F.col("row") == F.col("lead.row")).alias("stays")
    )


def one_of_each(docs: DataFrame, trees: int = TREES, percent: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component."""
    gone = classes_of(docs, trees, percent).where("not stays").select(F.col("file").alias("_llm_file"), F.col("at").alias("_llm_at"))
    placed = docs.select("*", *locator("_llm_file", "_llm_at"))
    return placed.join(gone, ["_llm_file", "_llm_at"], "left_anti").drop("_llm_file", "_llm_at")
