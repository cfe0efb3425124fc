"""Packing token sequences into windows, best fit decreasing.

Every document is its token ids and one closing id, cut into full windows and a remainder. Which windows
the remainders go to depends on their lengths alone, so best fit decreasing is planned on the number of
remainders of each length (at most one count per length) in runs: so many pieces of one length, into so
many windows with the same room. A segment tree over the room left finds the tightest open window. Each
piece then finds its place from its rank among all pieces, which is distributed.

Cases: a null or empty text is its closing id alone. Rows repeated are packed as often as they occur. Equal
lengths are placed in the order of ``doc_id`` (null first) and ``start``. An empty table gives no rows. Columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from forumlens.llm.common import ranked
from forumlens.runtime import materialize

WINDOW = 1024
RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks: the same ids, faster
ADDED = {"<|endoftext|>": 50256}  # the added tokens of byte_bpe_50k.json, which match inside a text as well
CHUNK = 256  # documents whose ids are held at once
CACHE = 1_000_000  # words whose ids a task remembers


class Words(dict):
    """Ids of a word with the space before it, as little-endian bytes, remembered."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHE:
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Ids of whole texts.

    ``added`` tokens are found first, the leftmost and longest, and the parts between them are encoded apart.
    The split pattern never joins a space to what stands before it, unless white space does. So a text
    without two white space characters in a row is encoded word by word, each with the space before it.
    """

    double_space = re.compile(r"\s\s")

    def __init__(self, ranks: str, added: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        path = ranks if "/" in ranks else public_tokenizers.path(ranks)
        with open(path, "rb") as lines:
            vocabulary = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={}
        ).encode_ordinary
        self.words = Words(self.encode)
        self.added = {token: struct.pack("<I", at) for token, at in (added or {}).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None

    def __call__(self, text: str) -> bytes:
        if self.cut is None:
            return self.ordinary(text)
        return b"".join(self.added[part] if n % 2 else self.ordinary(part) for n, part in enumerate(self.cut.split(text)))

    def ordinary(self, text: str) -> bytes:
        if self.double_space.search(text):
            ids = self.encode(text)
            return np.array(ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        ids = self.encode(first)
        return struct.pack(f"<{len(ids)}I", *ids) + b"".join(map(self.words.__getitem__, rest))


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None) -> DataFrame:
    """Windows and remainders of each document with their ids: ``doc_id, start, length, doc_tokens, ids``.

    ``ids`` are little-endian unsigned 32-bit numbers; the closing id is 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, added)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = encoder(text or "") + bytes(4)
                    tokens = len(ids) // 4
                    for start in range(0, tokens, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((doc, start, len(piece) // 4, tokens, piece))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "start", "length", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Rooms:
    """Segment tree over the room left: which rooms have open windows."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [False] * (2 * self.size)
        self.windows: dict[int, list[list[int]]] = {}

    def put(self, room: int, first: int, count: int) -> None:
        self.windows.setdefault(room, []).append([first, count])
        self._mark(room, True)

    def _mark(self, room: int, there: bool) -> None:
        node = room + self.size
        self.tree[node] = there
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that an open window has."""
        node = length + self.size
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def take(self, room: int, count: int) -> tuple[int, int]:
        """Up to ``count`` neighbouring windows with that room: the first and how many."""
        first, there = self.windows[room][-1]
        got = min(count, there)
        if got == there:
            self.windows[room].pop()
            if not self.windows[room]:
                self._mark(room, False)
        else:
            self.windows[room][-1] = [first + got, there - got]
        return first, got


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Best fit decreasing in runs, from the number of pieces of each length.

    A row is (rank, length, sequence, each, offset): the pieces from that rank on, in the order of
    lengths, go by ``each`` into the sequences from ``sequence`` on, the first at ``offset``.
    """
    below, ranks = 0, {}
    for length in sorted(counts):
        ranks[length] = below
        below += counts[length]
    rooms, runs, opened = Rooms(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = ranks[length], counts[length]
        while left:
            room = rooms.tightest(length)
            each = min((room or window) // length, left)
            if room is None:
                room, first, many = window, opened, left // each
                opened += many
            else:
                first, many = rooms.take(room, left // each)
            runs.append((rank, length, first, each, window - room))
            rank, left = rank + many * each, left - many * each
            if room - each * length:
                rooms.put(room - each * length, first, many)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (``doc_id``, ``start``, ``length`` and more) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per length
    runs = plan(counts, window)
    placed = ranked(pieces, ["length", "doc_id", "start"], "pack-ranks", "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            run = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
            nth = rank - run[:, 0]
            sequence, offset = run[:, 2] + nth // run[:, 3], run[:, 4] + nth % run[:, 3] * run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return placed.select(*pieces.columns, "_rank").mapInArrow(place, schema)


def digests(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None) -> DataFrame:
    """Where every piece lies, with the checksum of its ids in place of the ids."""
    pieces = token_pieces(docs, window, ranks, added)
    narrow = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(materialize(narrow, "pack-pieces"), window)


def sequences(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS, added: dict[str, int] | None = None) -> DataFrame:
    """The packed sequences: ``sequence_id``, their ``pieces`` and their ``ids`` padded with 0 to the window.

    Ids are written once with a piece number and brought to their sequence by one shuffle.
    """
    pieces = materialize(token_pieces(docs, window, ranks, added).withColumn("piece", F.monotonically_increasing_id()), "pack-ids")
    places = pack(pieces.drop("ids"), window).select("piece", "sequence_id", "offset")
    row = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = pieces.join(places, "piece").groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    used = F.aggregate("_rows", F.lit(0).cast("long"), lambda n, r: n + r["length"])
    padding = F.unhex(F.repeat(F.lit("00000000"), (F.lit(window) - used).cast("int")))
    ids = F.aggregate("_rows", F.unhex(F.lit("")), lambda got, r: F.concat(got, r["ids"]))
    return rows.select("sequence_id", F.transform("_rows", lambda r: r.dropFields("ids")).alias("pieces"), F.concat(ids, padding).alias("ids"))
