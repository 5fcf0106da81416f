"""What the training-data operators share: tables, cut lineage, text buffers, hashes.

Text is handled as Arrow batches: the UTF-8 buffer of a whole column is one numpy array, so that words, hashes
and n-grams cost a few vector passes and no Python call per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.lineage import discard, partitions, ranked, settled, shared_dir, written

__all__ = ["discard", "partitions", "ranked", "settled", "shared_dir", "written"]

#: Bytes of text for which temporary arrays are made at once.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, ordered: bool = False) -> DataFrame:
    """docs with a key of its own for each row, `_row`, as a written table; ordered: keys rise with doc_id, nulls last."""
    if ordered:
        docs = docs.sort(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")


def shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the input: never broadcast, so that the plan is the same at every size."""
    return df.hint("merge")


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows so that each holds about max_bytes of text, or a single longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = buffers(text_column(batch))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, row offsets into them from 0)."""
    n = len(col)
    _, off_buf, data_buf = col.buffers()
    if off_buf is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(off_buf, np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8)[off[0] : off[-1]] if data_buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


# ---- words -------------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = 0x5851F42D4C957F2D  # odd, 5 modulo 8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, 256, np.uint64)
_POW = [_powers(_R, 1 << 12), _powers(pow(_R, -1, 2**64), 1 << 12)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, grown once a worker to what it needs."""
    if len(_POW[0]) < n:
        _POW[0], _POW[1] = _powers(_R, n + n // 4), _powers(pow(_R, -1, 2**64), n + n // 4)
    return _POW[0], _POW[1]


def fmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element; changes x."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs."""
    return fmix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """Words [^\\x20\\x09-\\x0D]+ of a column of texts: byte bounds, 64-bit hashes, and each row's range of words."""

    def __init__(self, col: pa.Array, lower: bool = False) -> None:
        data, off = buffers(col)
        self.data, self.offsets = data, off
        n = len(data)
        word = ~_SPACE[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        at = off[:-1][off[:-1] < off[1:]]
        first[at] = word[at]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[at[1:] - 1] = word[at[1:] - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.starts, off)  # row i has words rows[i] to rows[i + 1]
        pow_, inv = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[_LOWER[data] if lower else data] * pow_[:n], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * inv[self.starts]
        self.hashes = fmix(h + (self.ends - self.starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours in h, by doubling; as long as len(h) - n + 1."""
    have, width = h, 1
    while width * 2 <= n:
        have = mix2(have[:-width], have[width:]) if len(have) > width else have[:0]
        width *= 2
    rest = n - width
    if rest:
        have = mix2(have[:-rest], have[rest:]) if len(have) > rest else have[:0]
    return have


def sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    have, width = v, 1
    while width * 2 <= n:
        have = np.minimum(have[:-width], have[width:]) if len(have) > width else have[:0]
        width *= 2
    rest = n - width
    if rest:
        have = np.minimum(have[:-rest], have[rest:]) if len(have) > rest else have[:0]
    return have


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
