"""Mixing sources to target weights.

The words of each source, document after document, are packed into blocks of one length: BLOCK words, or a
FEWEST-th of the source where that is less (the last block may be shorter). Targets share the size of all sources
by weight; none goes over CAP times its source's size, and what is above is shared again among the others. A
source's target gives a number of slots. The mix is cut into SHARDS output shards; each source deals its slots to them by
a multinomial draw, so that a shard's counts of the sources are multinomial by the sources' slots and the sources'
totals come out as planned. Slot number i of a source stands for the block with index
permutation_e(i mod blocks), e = i div blocks: a fresh pseudorandom permutation of the source's blocks in each pass (a
Feistel network over the index, walking on while it is out of range), so a block comes once a pass and no more
than CAP times. Slots and blocks are joined by source and index.

Everything follows from the rows and SEED: reruns agree.

Nothing is gathered on the driver but a handful of sums: sources may be as many as documents. They are sent to all tasks up to
BROADCAST_SOURCES, beyond that they are joined by shuffles, of which Spark can split a hot source. Documents are
placed by a range-partitioned sort, in which a hot source, or a hot doc_id, fills many ranges.

Defined results: a null or wordless text has size 0 and is never taken; a null source is a source of its own and
sorts last; a null doc_id is a document like any other; rows that repeat a doc_id are each placed and taken, and
the filter gives each what it gets; further columns are ignored by the report and kept by the
filter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK = 128
FEWEST = 128
SHARDS = 256
SEED = 20240
BROADCAST_SOURCES = 100_000
#: Slots that a row stands for before they are spelt out.
SLOT_RANGE = 1 << 16
ROUNDS = 4


def word_count(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; null has none."""
    flat = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, r"[\x20\x09-\x0D]+"))).cast("bigint")


def level(sizes: DataFrame, weight: Column, cap: float = CAP) -> float:
    """The share of a weight of 1: each source's target is that times its weight, or cap times its size if that is less.

    sizes has `size`, one row a source. Each round shares what the full sources leave among the others; rounds end
    when no further source is full.
    """
    used = sizes.where("size > 0")
    total, share, full = used.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0], 0.0, -1
    while True:
        over = F.lit(share) * weight > F.lit(cap) * F.col("size")
        n, taken, left = used.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("size")).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(weight))).head()
        if n == full or not left:
            return share
        full, share = n, (total - cap * taken) / left


def shard_counts(slots: int, sid: int, shards: int, seed: int = SEED) -> np.ndarray:
    """How many of a source's slots each shard draws."""
    return np.random.Generator(np.random.PCG64([seed, sid])).multinomial(slots, np.full(shards, 1 / shards))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0 .. n - 1, chosen by key, at the given places.

    A Feistel network permutes 0 .. 4**b - 1, less than 4 * n; values from n on are put in again until they are below.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, x = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(x))
    keys = common.fmix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % 2**64))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for k in keys:
            left, right = right, left ^ (common.fmix(right + k) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def sources(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, sid, source_size, target, length, blocks, slots: the mix's recipe, one row a source."""
    sums = common.written(sized.groupBy("source").agg(F.sum("size").alias("size")), "mix-sums")
    table = common.written(common.ranked(sums, F.col("source").asc_nulls_last(), name="sid"), "mix-ranks")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    share = level(table, weight)
    target = F.when(F.col("size") > 0, F.least(F.lit(share) * weight, F.lit(float(CAP)) * F.col("size"))).otherwise(0.0)
    table = table.select("source", "sid", F.col("size").alias("source_size"), target.alias("target"), F.expr(f"greatest(1, least({BLOCK}, size div {FEWEST}))").alias("length"))
    table = table.withColumn("blocks", F.expr("(source_size + length - 1) div length"))
    slots_ = F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.col("blocks") * CAP)).otherwise(0)
    return common.written(table.withColumn("slots", slots_.cast("bigint")), "mix-sources")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range's number and `_inner`, the words of the source before the row in this range."""
    part, last, total = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        sid, size = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("sid", "size"))
        first = np.flatnonzero(np.r_[True, sid[1:] != sid[:-1]])
        inner = np.cumsum(size) - size
        base = inner[first] - np.where((first == 0) & (sid[first] == last), total, 0)
        inner -= np.repeat(base, np.diff(np.r_[first, len(sid)]))
        last, total = sid[-1], inner[-1] + size[-1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(sid), part, np.int32)), pa.array(inner)], names=[*b.schema.names, "_part", "_inner"])


def placed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(_row, doc_id, size, sid, source_size, target, length, start: words of the source before this row), and sources().

    docs has a `_row` of its own for each row. Rows are placed by a hash of doc_id and text; only rows that are equal in
    both go by `_row`, so that the places follow from the rows.
    """
    spark = docs.sparkSession
    sized = docs.select("_row", "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))
    sized = common.written(sized, "mix-sizes")
    table = sources(sized, weights)
    side = table.select(F.col("source").alias("name"), "sid", "source_size", "target", "length")
    side = F.broadcast(side) if table.count() <= BROADCAST_SOURCES else common.shuffled(side)
    rows = sized.join(side, F.col("source").eqNullSafe(F.col("name"))).withColumn("mixed", F.xxhash64("doc_id", "digest"))
    keys = ["sid", "mixed", "doc_id", "size", "digest", "_row"]
    rows = rows.repartitionByRange(common.partitions(spark), *keys).sortWithinPartitions(*keys).select("_row", "doc_id", "size", "sid", "source_size", "target", "length")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    rows = common.written(rows.mapInArrow(_running, f"{schema}, _part int, _inner long"), "mix-places")
    sums = rows.groupBy("_part", "sid").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    # only the first source of a range can have begun in an earlier one, so that there is at most one such row a range
    base = sums.select("_part", "sid", F.sum("words").over(before).alias("_base")).where("_base > 0")
    out = rows.join(F.broadcast(base), ["_part", "sid"], "left").withColumn("start", F.coalesce("_base", F.lit(0)) + F.col("_inner"))
    return out.drop("_part", "_inner", "_base"), table


def slots(table: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """sid, idx, shard, slot: every slot of the mix, its shard, and the block that it stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sid, blocks, n, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                slot = np.arange(at, min(at + SLOT_RANGE, n))
                shard = np.searchsorted(np.cumsum(shard_counts(n, sid, shards, seed)), slot, "right").astype(np.int32)
                turn, idx = slot // blocks, np.zeros(len(slot), np.int64)
                for e in range(int(turn[0]), int(turn[-1]) + 1):
                    here = turn == e
                    idx[here] = permuted(slot[here] % blocks, blocks, seed + 1_000_003 * sid + 7919 * e)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), sid)), pa.array(idx), pa.array(shard), pa.array(slot)], names=["sid", "idx", "shard", "slot"])

    ranges = table.where("slots > 0").select("sid", "blocks", "slots", F.explode(F.expr(f"sequence(0, slots - 1, {SLOT_RANGE})")).alias("at"))
    return ranges.repartition(common.partitions(table.sparkSession), "sid", "at").mapInArrow(run, "sid long, idx long, shard int, slot long")


def _parts(places: DataFrame) -> DataFrame:
    """sid, idx, start, _row, doc_id, size, skip, words: the stretch that each document has in each block."""
    parts = places.where("size > 0").withColumn("idx", F.explode(F.sequence(F.expr("start div length"), F.expr("(start + size - 1) div length"))))
    lo = F.greatest(F.col("start"), F.col("idx") * F.col("length"))
    hi = F.least(F.col("start") + F.col("size"), (F.col("idx") + 1) * F.col("length"))
    return parts.select("sid", "idx", "start", "_row", "doc_id", "size", (lo - F.col("start")).cast("int").alias("skip"), (hi - lo).cast("int").alias("words"))


def taken_blocks(places: DataFrame, table: DataFrame, seed: int = SEED) -> DataFrame:
    """_parts() and times: stretches of documents (words from `skip`) that the mix takes `times` times."""
    times = slots(table, seed=seed).groupBy("sid", "idx").agg(F.count("*").cast("int").alias("times"))
    return _parts(places).join(common.shuffled(times), ["sid", "idx"])


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    places, table = placed(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "source", "text"), weights)
    taken = taken_blocks(places, table, seed).groupBy("_row").agg(F.sum(F.col("words").cast("bigint") * F.col("times")).alias("taken"))
    full = places.join(common.shuffled(taken), "_row", "left")
    return full.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, parts in zip(common.text_column(b).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = text.encode().split()
            piece = [b" ".join(words[p["skip"] : p["skip"] + p["words"]]).decode() for p in parts]
            yield pa.RecordBatch.from_arrays([*(pa.array([p[c] for p in parts], pa.int64()) for c in ("sid", "idx", "start")), pa.array(piece, pa.string())], names=["sid", "idx", "start", "piece"])


def mixed_blocks(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """shard, source, slot, idx, text: the mix itself, a row for each slot with its block's words joined by spaces."""
    docs = common.keyed(docs)
    places, table = placed(docs, weights)
    drawn = common.written(slots(table, seed=seed), "mix-slots")
    used = _parts(places).join(common.shuffled(drawn.select("sid", "idx").distinct()), ["sid", "idx"])
    parts = used.groupBy("_row").agg(F.collect_list(F.struct("sid", "idx", "start", "skip", "words")).alias("parts"))
    pieces = docs.join(common.shuffled(parts), "_row").select("text", "parts").mapInArrow(_pieces, "sid long, idx long, start long, piece string")
    of = F.array_sort(F.collect_list(F.struct("start", "piece")))  # at most as many as a block has words
    blocks = pieces.groupBy("sid", "idx").agg(F.array_join(F.transform(of, lambda p: p["piece"]), " ").alias("text"))
    named = drawn.join(common.shuffled(table.select("sid", "source")), "sid")
    return named.join(common.shuffled(blocks), ["sid", "idx"]).select("shard", "source", "slot", "idx", "text")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix as documents with all columns of docs: a row for each pass that takes words of a document, with those words.

    A pass that takes all of a document gives its text unchanged, one that takes some gives them joined by spaces
    (and n_chars, where there is such a column, as their number of characters).
    """
    names, schema = docs.columns, docs.schema
    docs = common.keyed(docs)

    def taken() -> DataFrame:
        places, table = placed(docs, weights)
        parts = F.collect_list(F.struct("skip", "words", "times")).alias("parts")
        return taken_blocks(places, table, seed).groupBy("_row").agg(F.struct(parts, F.max("size").alias("size")).alias("_mixed"))

    joined = docs.join(common.shuffled(common.settled(taken, "mix-taken")), "_row").select(*names, "_mixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            texts = common.text_column(b).to_pylist()
            row, text = [], []
            for i, (t, m) in enumerate(zip(texts, b.column(len(names)).to_pylist(), strict=True)):
                parts = sorted((p["skip"], p["words"], p["times"]) for p in m["parts"])
                for r in range(1, CAP + 1):
                    now = [(s, w) for s, w, k in parts if k >= r]
                    if not now:
                        break
                    row.append(i)
                    if sum(w for _, w in now) == m["size"]:
                        text.append(t)
                    else:
                        words = t.encode().split()
                        text.append(b" ".join(x for s, w in now for x in words[s : s + w]).decode())
            out = b.take(pa.array(row, pa.int64()))
            new = {"text": pa.array(text, pa.string()), "n_chars": pa.array(map(len, text), pa.int64())}
            yield pa.RecordBatch.from_arrays([new[n].cast(out.column(j).type) if n in new else out.column(j) for j, n in enumerate(names)], names=names)

    return joined.mapInArrow(run, schema)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the stage's documents, as documents."""
    return mixed_documents(docs)
