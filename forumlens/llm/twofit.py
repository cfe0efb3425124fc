"""Packing token sequences into few windows, best two fit.

A document is its token ids and one closing id. One longer than a window is cut into full windows, its first
piece being what is left over. Windows are filled one after the other: the longest piece that fits goes in until
none does; then the smallest piece inside gives way to two unpacked ones, if two fit the larger gap more tightly.

Which windows are formed depends on the lengths alone, so they are planned on the number of pieces of each
length (one count per length). A filling repeats until one of its lengths runs short, so the plan is a list of
runs, whose number is bounded by the window and not by the corpus. A piece finds its place from its rank among
all pieces by length, which is distributed.

Cases: a null or empty text is its closing id alone. Rows repeated are packed as often as they occur. Equal
lengths are placed in the order of ``doc_id`` (null first) and ``start``. An empty table gives no rows. Columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from forumlens.llm.common import ranked
from forumlens.llm.packing import CHUNK, RANKS, Encoder
from forumlens.runtime import materialize

WINDOW = 1024
CLOSING = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None, with_ids: bool = True) -> DataFrame:
    """The pieces of each document with the checksum of their ids, and the ids (little-endian, 32 bits) if wanted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = Encoder(ranks, added), struct.pack("<I", CLOSING)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = encoder(text or "") + closing
                    tokens = len(ids) // 4
                    ends = range((tokens - 1) % window + 1, tokens + 1, window)
                    for nth, end in enumerate(ends):
                        start = max(end - window, 0)
                        part = ids[4 * start : 4 * end]
                        rows.append((doc, nth, start, end - start, zlib.crc32(part), part))
                columns = [list(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


class Lengths:
    """How many pieces of each length are not packed yet; the longest that fits is read off a bit mask."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.mask = sum(1 << length for length, n in counts.items() if n)

    def longest(self, room: int) -> int:
        """The greatest length up to ``room`` that is left, or 0."""
        return max((self.mask & ((1 << (room + 1)) - 1)).bit_length() - 1, 0)

    def take(self, length: int, n: int) -> None:
        """Take ``n`` pieces out, or put them back if negative."""
        self.left[length] -= n
        if self.left[length]:
            self.mask |= 1 << length
        else:
            self.mask &= ~(1 << length)


def _two(lengths: Lengths, least: int, gap: int) -> tuple[int, int] | None:
    """The two lengths left with the greatest sum above ``least`` and up to ``gap``; of equal sums the one with the longer piece."""
    best, found = least, None
    one = lengths.longest(min(gap, least))
    while 2 * one > best:
        two = lengths.longest(min(gap - one, one))
        if two == one and lengths.left[one] < 2:
            two = lengths.longest(one - 1)
        if two and one + two > best:
            best, found = one + two, (one, two)
            if best == gap:
                break
        one = lengths.longest(one - 1)
    return found


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Best two fit in runs, from the number of pieces of each length.

    A row is (rank, length, sequence, each, offset): the pieces from that rank on, in the order of lengths, go by
    ``each`` into the sequences from ``sequence`` on, the first at ``offset``.
    """
    below, rank = 0, {}
    for length in sorted(counts):
        rank[length] = below
        below += counts[length]
    lengths, runs, sequence = Lengths(counts), [], 0
    while lengths.mask:
        room, greedy = window, {}
        while (length := lengths.longest(room)) > 0:
            n = min(lengths.left[length], room // length)
            greedy[length] = n
            lengths.take(length, n)
            room -= n * length
        packed = dict(greedy)
        smallest = min(greedy)
        pair = _two(lengths, smallest, room + smallest) if room and sum(greedy.values()) > 1 else None
        if pair:
            packed[smallest] -= 1
            for length in pair:
                packed[length] = packed.get(length, 0) + 1
        # the same filling comes out as long as none of its lengths runs short
        again = [lengths.left[x] // packed[x] for x in greedy if packed[x]]  # ``left`` is what one filling left over
        again += [lengths.left[x] // packed[x] - 1 for x in (pair or ())]
        many = 1 + min(again, default=0)
        for length, n in greedy.items():
            lengths.take(length, -n)
        offset = 0
        for length, each in sorted(packed.items(), reverse=True):
            if each:
                runs.append((rank[length], length, sequence, each, offset))
                rank[length] += many * each
                lengths.take(length, many * each)
                offset += each * length
        sequence += many
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (``doc_id``, ``start``, ``length`` and more) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    runs = plan(counts, window)
    placed = ranked(pieces, ["length", "doc_id", "start"], "twofit-ranks", "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            run = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
            nth = rank - run[:, 0]
            sequence, offset = run[:, 2] + nth // run[:, 3], run[:, 4] + nth % run[:, 3] * run[:, 1]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names)

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return placed.select(*pieces.columns, "_rank").mapInArrow(place, schema)


def digests(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None) -> DataFrame:
    """Where every piece lies, with the checksum of its ids in place of the ids."""
    return pack(materialize(pieces(docs, window, ranks, added, with_ids=False), "twofit-pieces"), window)


def sequences(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None) -> DataFrame:
    """The packed sequences: ``sequence_id``, their ``pieces`` in order, and their ``ids`` end to end, without padding.

    Ids are written once with a number and brought to their sequence by one shuffle.
    """
    cut = materialize(pieces(docs, window, ranks, added).withColumn("_id", F.monotonically_increasing_id()), "twofit-ids")
    places = pack(cut.drop("ids"), window).select("_id", "sequence_id", "offset")
    row = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    rows = cut.join(places, "_id").groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    ids = F.aggregate("_rows", F.unhex(F.lit("")), lambda got, r: F.concat(got, r["ids"]))
    return rows.select("sequence_id", F.transform("_rows", lambda r: r.dropFields("ids")).alias("pieces"), ids.alias("ids"))
