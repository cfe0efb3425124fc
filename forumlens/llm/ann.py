"""Approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors have their own centroids, and a cell is a pair of centroids. A query walks the
cells in the order of its summed distances to both centroids, with a heap, until the cells it has seen
hold a share of all rows; the rows of those cells are then ranked by their exact distance.

The centroids are fitted on a bounded sample; every row is indexed. Rows are dealt by their first centroid
into blocks of bounded size, queries into chunks, and each block and chunk are compared as matrices, so no
pair is ever a row and a common vector or cell is split. A block gives at most ``k`` rows a query.

Cases: vectors that are null, zero, hold null or non-finite components, or are not of the commonest length (of
equally common ones the longest) take no part, neither as queries nor as candidates. Rows with the query's
``vec_id`` are not its candidates. Ties go to the smaller ``vec_id``; rows repeated are found as often, but ask
once: an id asks with its vector, or with the first in order if its rows differ. Null ids take no part. With few
rows all are looked at. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.runtime import materialize

CENTROIDS = 64  # of each half
SAMPLE_ROWS = 10_000  # that the centroids are fitted on, at most
SHARE = 0.5  # of all rows that a query's cells hold; the given vectors point anywhere, so half is needed
LEAST_ROWS = 1000  # that they hold in any case
BLOCK_ROWS, CHUNK_QUERIES = 4096, 512


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0))
    # one row per length is counted, and only the commonest comes back
    commonest = rows.groupBy(F.size("vector").alias("wide")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "wide"))).first()[0]
    return rows.where(F.size("vector") == (commonest["wide"] if commonest else 0))


def centroids(half: np.ndarray, many: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from the first distinct rows."""
    places = np.unique(half, axis=0, return_index=True)[1]
    found = half[np.sort(places)[:many]].copy()
    for _ in range(rounds):
        nearest = _apart(half, found).argmin(axis=1)
        for i in np.unique(nearest):
            found[i] = half[nearest == i].mean(axis=0)
    return found


def _apart(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(axis=1)[:, None] - 2 * rows @ points.T + (points**2).sum(axis=1), 0)


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)


def walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, wanted: float) -> dict[int, list[int]]:
    """The cells in the order of summed distances until they hold ``wanted`` rows: second centroids by first."""
    a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
    heap, seen, cells = [(first[a[0]] + second[b[0]], 0, 0)], 0, {}
    while heap and seen < wanted:
        _, i, j = heapq.heappop(heap)
        rows = held[a[i], b[j]]
        if rows:
            seen += rows
            cells.setdefault(int(a[i]), []).append(int(b[j]))
        # each cell has one predecessor: along the first half at j = 0, else along the second
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
    return cells


def search(
    vectors: DataFrame, every: int = 100, k: int = 10, many: int = CENTROIDS, share: float = SHARE, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The ``k`` nearest found of each query, rows whose id is divisible by ``every``: ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    if not drawn:
        return spark.createDataFrame([], empty)
    points = np.array([r["vector"] for r in drawn])
    wide, half = points.shape[1], points.shape[1] // 2
    fitted = centroids(points[:, :half], many), centroids(points[:, half:], many)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column(1), wide)
            cells = [pa.array(_apart(h, c).argmin(axis=1).astype("int32")) for h, c in zip((found[:, :half], found[:, half:]), fitted)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cells], ["vec_id", "vector", "first", "second"])

    indexed = materialize(rows.mapInArrow(index, "vec_id long, vector array<double>, first int, second int"), "ann-index")
    held = np.zeros((len(fitted[0]), len(fitted[1])), np.int64)
    for r in indexed.groupBy("first", "second").agg(F.count("*").alias("n")).collect():  # one row per cell
        held[r["first"], r["second"]] = r["n"]
    total, tiles = int(held.sum()), held.sum(axis=1)
    blocks = np.maximum(-(-tiles // BLOCK_ROWS), 1)
    wanted = min(total, max(share * total, LEAST_ROWS))
    # an id that is repeated asks once; the aggregate keeps one vector a task and id
    chosen = indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    chunks = max(-(-chosen.count() // CHUNK_QUERIES), 1)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), batch.column(1)
            found = _matrix(vectors, wide)
            near = _apart(found[:, :half], fitted[0]), _apart(found[:, half:], fitted[1])
            for at, query in enumerate(ids):
                cells = walk(near[0][at], near[1][at], held, wanted)
                out = [(tile, block, cells[tile]) for tile in cells for block in range(blocks[tile])]
                tile, block, seconds = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query] * len(out), pa.int64()), vectors.take(pa.array([at] * len(out))),
                        pa.array(tile, pa.int32()), pa.array(block, pa.int32()), pa.array(seconds, pa.list_(pa.int32())),
                    ],
                    ["query_id", "vector", "tile", "block", "seconds"],
                )

    asked = chosen.select("vec_id", "vector").mapInArrow(
        visit, "query_id long, vector array<double>, tile int, block int, seconds array<int>"
    ).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    per_tile = F.element_at(F.array(*[F.lit(int(n)) for n in blocks]), F.col("first") + 1)
    entries = indexed.select(
        "vec_id", "vector", F.col("first").alias("tile"), "second",
        F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), per_tile).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )

    def nearest(queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and block.num_rows:
            ids, second = block["vec_id"].to_numpy(), block["second"].to_numpy()
            points = _matrix(block["vector"].combine_chunks(), wide)
            asked_ids, asking = queries["query_id"].to_numpy(), _matrix(queries["vector"].combine_chunks(), wide)
            rough = _apart(asking, points)
            for at, seconds in enumerate(queries["seconds"].to_pylist()):
                there = np.flatnonzero(np.isin(second, seconds) & (ids != asked_ids[at]))
                if len(there) > k:  # the rounding of the matrix product is far below the slack
                    bound = np.partition(rough[at, there], k - 1)[k - 1]
                    there = there[rough[at, there] <= bound + 1e-9 * (1 + bound + (asking[at] ** 2).sum())]
                score = np.sqrt(((points[there] - asking[at]) ** 2).sum(axis=1))
                best = np.lexsort((ids[there], score))[:k]
                out.append((np.full(len(best), asked_ids[at]), ids[there][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    keys = ["tile", "block", "chunk"]
    found = asked.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInArrow(nearest, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
