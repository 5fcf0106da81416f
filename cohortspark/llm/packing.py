"""Token ids in packed binary rows: best-fit decreasing with a segment tree.

Each text becomes the ids of a byte-level tokenizer and an end mark. Sequences longer than a row are split
into pieces of at most `capacity` ids without loss (`offsets` tells where each piece starts). A task packs its pieces in lots of
LOT ids: longest first, each into the open row with the least room that is enough, found in a segment tree over the
amounts of room; the OPEN rows with the most room stay open for the next lot, so memory is bounded and no row is
closed early. Each row holds the ids (uint16, or int32 for larger vocabularies; padded), the cumulative lengths of
its pieces from 0, and the position ids, which start again at every piece (uint16, or int32 for a capacity over 65,536).

Defined results: a null or empty text has no ids and is in no row; a null doc_id is carried as null; rows that
repeat a doc_id are packed each; further columns are ignored; an empty table gives no rows. A row's shard and
number follow the input's partitions; its contents are those of one partition.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import common
from .token_counts import resolve

CAPACITY = 2048
RANKS = "byte_bpe_50k.tiktoken"
LOT, OPEN = 1 << 20, 256
SCHEMA = "shard int, row long, doc_ids array<long>, offsets array<int>, cu_seqlens array<int>, n_tokens int, input_ids binary, position_ids binary"


class Rooms:
    """Segment tree over amounts of room 0 .. capacity: how many open rows have it, and the least that is enough."""

    def __init__(self, capacity: int) -> None:
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, room: int, by: int) -> None:
        i = room + self.width
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, size: int) -> int | None:
        """The least room of an open row that is at least size."""
        i = size + self.width
        if self.count[i]:
            return size
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return None


class Packer:
    """Best-fit decreasing over lots of pieces (doc_id, offset, ids)."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.rooms = capacity, Rooms(capacity)
        self.open: dict[int, list[list]] = {}

    def put(self, pieces: list[tuple[int | None, int, np.ndarray]]) -> None:
        for piece in sorted(pieces, key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1])):
            size = len(piece[2])
            room = self.rooms.least(size)
            if room is None:
                row, room = [], self.capacity
            else:
                row = self.open[room].pop()
                self.rooms.add(room, -1)
            row.append(piece)
            self.rooms.add(room - size, 1)
            self.open.setdefault(room - size, []).append(row)

    def close(self, keep: int) -> Iterator[list]:
        """Takes out all rows but the `keep` with the most room."""
        left = keep
        for room in sorted(self.open, reverse=True):
            rows = self.open[room]
            stay = min(left, len(rows)) if room else 0
            left -= stay
            for row in rows[stay:]:
                self.rooms.add(room, -1)
                yield row
            del rows[stay:]
        self.open = {room: rows for room, rows in self.open.items() if rows}


class Encoder:
    """Byte-level ids by a rank file; one per Python worker."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(resolve(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = max(table.values()) + 1
        self.dtype = np.uint16 if self.end < 1 << 16 else np.int32
        self.of = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @classmethod
    def get(cls, ranks: str) -> Encoder:
        if ranks not in cls._loaded:
            cls._loaded[ranks] = cls(ranks)
        return cls._loaded[ranks]

    def ids(self, text: str) -> np.ndarray:
        return np.array([*self.of.encode_ordinary(text), self.end], self.dtype)


def position_type(capacity: int) -> type:
    """Position ids run up to capacity - 1."""
    return np.uint16 if capacity <= 1 << 16 else np.int32


def pack(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS) -> DataFrame:
    """Packed rows of docs (doc_id, text)."""

    def batch(rows: list[list], shard: int, number: int, encoder: Encoder) -> pa.RecordBatch:
        ids = np.full((len(rows), capacity), encoder.end, encoder.dtype)
        at = np.zeros((len(rows), capacity), position_type(capacity))
        ends = []
        for i, row in enumerate(rows):
            to = np.r_[0, np.cumsum([len(p[2]) for p in row])].astype(np.int32)
            ids[i, : to[-1]] = np.concatenate([p[2] for p in row])
            at[i, : to[-1]] = np.arange(to[-1]) - np.repeat(to[:-1], np.diff(to))
            ends.append(to)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), shard, np.int32)),
                pa.array(np.arange(number, number + len(rows))),
                pa.array([[p[0] for p in row] for row in rows], pa.list_(pa.int64())),
                pa.array([[p[1] for p in row] for row in rows], pa.list_(pa.int32())),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array([int(e[-1]) for e in ends], pa.int32()),
                pa.array([x.tobytes() for x in ids], pa.binary()),
                pa.array([x.tobytes() for x in at], pa.binary()),
            ],
            names=["shard", "row", "doc_ids", "offsets", "cu_seqlens", "n_tokens", "input_ids", "position_ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder.get(ranks), Packer(capacity)
        shard, number, held, pieces = TaskContext.get().partitionId(), 0, 0, []
        for b in common.slices(batches):
            for doc, text in zip(b.column(0).to_pylist(), common.text_column(b).to_pylist(), strict=True):
                if not text:
                    continue
                ids = encoder.ids(text)
                pieces += [(doc, s, ids[s : s + capacity]) for s in range(0, len(ids), capacity)]
                held += len(ids)
            if held >= LOT:
                packer.put(pieces)
                pieces, held = [], 0
                rows = list(packer.close(OPEN))
                for i in range(0, len(rows), 512):
                    yield batch(rows[i : i + 512], shard, number, encoder)
                    number += len(rows[i : i + 512])
        packer.put(pieces)
        rows = list(packer.close(0))
        for i in range(0, len(rows), 512):
            yield batch(rows[i : i + 512], shard, number, encoder)
            number += len(rows[i : i + 512])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, capacity: int = CAPACITY, ranks: str = RANKS) -> None:
    """Packed rows as Parquet files: binary id matrices row by row with their lengths and positions."""
    pack(docs, capacity, ranks).write.option("compression", "zstd").parquet(path)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of the stage's documents."""
    return pack(docs)
