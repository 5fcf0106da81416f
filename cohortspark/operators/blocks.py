"""Dense blocks that tasks make and that add up: binary rows, added in a tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark import lineage

SCHEMA = "part int, n long, block binary"
FAN = 16


def batch(keys: dict[str, int], block: np.ndarray, n: int = 0) -> pa.RecordBatch:
    """One block with its keys, this task's number and a count."""
    part = TaskContext.get().partitionId()
    columns = {k: pa.array([v], pa.int32()) for k, v in keys.items()} | {"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64()), "block": pa.array([np.ascontiguousarray(block, np.float64).tobytes()], pa.binary())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def array(block: bytes) -> np.ndarray:
    return np.frombuffer(block, np.float64)


def fold(parts: DataFrame, keys: list[str], join) -> DataFrame:
    """One row for each of the keys: join(blocks) of all its parts, FAN of them at a time, in rounds.

    A task holds a running result and one more block, whatever the number of tasks before it.
    """
    parts = lineage.written(parts, "blocks")
    most = parts.agg(F.coalesce(F.max("part"), F.lit(0))).head()[0] + 1
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    names = parts.columns

    def run(group: pa.Table) -> pa.Table:
        total, n = None, 0
        for b in group.select(["n", "block"]).to_batches():
            for count, block in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = np.frombuffer(block.as_buffer(), np.float64)
                total, n = own if total is None else join(total, own), n + count
        first = group.slice(0, 1)
        new = {"n": pa.array([n], pa.int64()), "block": pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())}
        return pa.table({c: new.get(c, first.column(c)) for c in names})

    while True:
        parts = parts.withColumn("part", F.expr(f"cast(part div {FAN} as int)")).groupBy(*keys, "part").applyInArrow(run, fields)
        most = -(-most // FAN)
        if most == 1:
            return parts.drop("part")


def add_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, block: sums of the parts' counts and blocks."""
    return fold(parts, keys, np.add)


def values(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with its list column as a matrix, a row for each list, straight from the buffer; all lists have one length."""
    for b in batches:
        if b.num_rows:
            flat = b.column(b.schema.get_field_index(column)).flatten()
            yield b, flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(b.num_rows, -1)
