"""Near-duplicate documents: HyperMinHash, banding, exact verification, connected components.

A document's set holds its distinct shingles of five words (A-Z in lower case). The 64-bit hashes fall into
REGISTERS buckets of equal width; of the smallest in each the number of leading zeros and eight bits of mantissa are
kept; an empty register borrows from another one by a fixed pseudorandom walk. Bands of a few registers are hashed:
from similarity 0.85 on 40 bands of 8, which two such sets all miss with probability (1 - 0.85**8)**40 = 3e-6,
below, from 0.8 on, 53 bands of 6: (1 - 0.8**6)**53 = 1e-7.

Documents with equal sets (128-bit digest) are one class from the start. Classes that meet in a bucket are joined
by an edge to the smallest of the bucket, and the components of these edges are the clusters in which links are
looked for, so that no bucket is expanded into pairs. A cluster is one unit of work, or, where it is large, blocks of
bounded size. In a unit, the share of equal registers, corrected for chance collisions,
rules pairs out that are several standard errors away; all others are confirmed on the full sets. Pairs that are
connected already are passed over, and what leaves a unit is a star for each component.

The blocks of a large cluster are looked through by themselves and against its first block, which connects almost all of a
group of copies. Only documents that are then outside their cluster's largest component are compared with all its
blocks: a text is copied once for every block of such documents, and not for every block of the cluster.
Components of all stars are the result.

Defined results: a null or wordless text has an empty set, is linked with nothing and is kept; equal texts are
linked; rows that repeat a doc_id count as one document whose texts are all linked; a null doc_id stays by itself
with a null component; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, graphs

SHINGLE = 5
REGISTERS = 320
MANTISSA = 8
#: Most documents of a block, and most shingles of a block or of a bin of small clusters.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1_000_000
SIGNATURES = "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def shingle_sets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and the texts' offsets into them."""
    words = common.Words(col, lower=True)
    h, rows, n = words.hashes, words.rows, words.counts()
    many = np.maximum(n - SHINGLE + 1, (n > 0).astype(n.dtype))
    off = np.r_[0, np.cumsum(many)]
    out = np.empty(off[-1], np.uint64)
    long = np.repeat(n >= SHINGLE, many)
    all_ = common.grams(h, SHINGLE)
    at = np.repeat(rows[:-1] - off[:-1], many) + np.arange(off[-1])
    out[long] = all_[at[long]]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        g = h[rows[i] : rows[i] + 1] + np.uint64(n[i])
        for j in range(rows[i] + 1, rows[i + 1]):
            g = common.mix2(g, h[j : j + 1])
        out[off[i]] = g[0]
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    if not len(out):
        return out, off
    new = np.r_[True, out[1:] != out[:-1]]
    new[off[:-1][many > 0]] = True
    return out[new], np.r_[0, np.cumsum(new)][off]


def registers(u: np.ndarray, off: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of each set; rows of empty sets are 0."""
    size = np.diff(off)
    regs = np.full((len(size), REGISTERS), -1, np.int32)
    row = np.repeat(np.arange(len(size)), size)
    m, low = np.uint64(REGISTERS), np.uint64(0xFFFFFFFF)
    bucket = (((u >> np.uint64(32)) * m + (((u & low) * m) >> np.uint64(32))) >> np.uint64(32)).astype(np.int64)
    # sorted within a row, so the first of a bucket is its smallest
    cell = row * REGISTERS + bucket
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    part = ((u[first] * m) >> np.uint64(11)).astype(np.float64)
    fraction, exponent = np.frexp(part)
    value = ((53 - exponent) << MANTISSA) + np.where(part > 0, (fraction - 0.5) * 2 * (1 << MANTISSA), 0).astype(np.int64)
    regs[row[first], bucket[first]] = value
    filled = regs >= 0
    todo = np.argwhere(~filled & (size > 0)[:, None])
    for step in range(_WALK.shape[0]):
        if not len(todo):
            break
        to = _WALK[step, todo[:, 1]]
        good = filled[todo[:, 0], to]
        regs[todo[good, 0], todo[good, 1]] = regs[todo[good, 0], to[good]]
        todo = todo[~good]
    regs[regs < 0] = 0
    return regs.astype(np.uint16)


def _walk() -> np.ndarray:
    """Which register an empty one asks in each step: pseudorandom, then all in turn."""
    rng = np.random.Generator(np.random.PCG64(5))
    return np.vstack([rng.integers(0, REGISTERS, (64, REGISTERS)), (np.arange(REGISTERS)[None] + np.arange(1, REGISTERS)[:, None]) % REGISTERS])


_WALK = _walk()


def band_rows(percent: int) -> int:
    return 8 if percent >= 85 else 6


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key of each band; the band's number is part of it."""
    bands = REGISTERS // rows
    cells = regs[:, : bands * rows].reshape(len(regs), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(regs), bands)).copy()
    for j in range(rows):
        key = common.mix2(key, cells[:, :, j])
    return key


def collision(n: float, m: float) -> float:
    """Chance that the registers of two unrelated sets of n and m shingles agree."""
    level = 2.0 ** -np.arange(1, 40)
    of = lambda k: (1 - level) ** k - (1 - 2 * level) ** k  # noqa: E731  the smallest of k values has so many zeros
    return float((of(max(n / REGISTERS, 1.0)) * of(max(m / REGISTERS, 1.0))).sum() / (1 << MANTISSA))


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    rows = band_rows(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            u, off = shingle_sets(common.text_column(b))
            n = np.diff(off)
            fps = []
            for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
                total = np.r_[np.uint64(0), np.cumsum(common.fmix(u * np.uint64(salt)), dtype=np.uint64)]
                fps.append(common.signed(total[off[1:]] - total[off[:-1]]))
            keys = band_keys(registers(u, off), rows)[n > 0]
            bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum((n > 0) * keys.shape[1])].astype(np.int32)), pa.array(common.signed(keys).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(fps[0]), pa.array(fps[1]), bands], names=["doc_id", "n_shingles", "fp1", "fp2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, SIGNATURES)


def forest(ids: np.ndarray, u: np.ndarray, off: np.ndarray, percent: int, other: np.ndarray | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs (smallest id, smallest id of a part) of each component of the links.

    With `other` (block numbers) only links between blocks count; parts are what `known` has connected already, else
    single documents.
    """
    n, size = len(ids), np.diff(off)
    regs = registers(u, off)
    _, flat = np.unique(u, return_inverse=True)
    seen = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    part_of = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1]
    root = part_of.copy()
    for i in range(1, n):
        ok = (root[:i] != root[i]) & (100 * np.minimum(size[:i], size[i]) >= percent * np.maximum(size[:i], size[i])) & (size[:i] > 0)
        if other is not None:
            ok &= other[:i] != other[i]
        cand = np.flatnonzero(ok)
        if not len(cand) or not size[i]:
            continue
        chance = collision(size[i], size[i])
        est = ((regs[cand] == regs[i]).mean(1) - chance) / (1 - chance)
        low = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / min(REGISTERS, size[i]))
        cand = cand[est >= low]
        cand = cand[np.argsort(-est[est >= low], kind="stable")]
        mine = flat[off[i] : off[i + 1]]
        seen[mine] = True
        while len(cand):
            part, cand = cand[:256], cand[256:]
            lens = size[part]
            starts = np.r_[0, np.cumsum(lens)[:-1]]
            at = np.repeat(off[part] - starts, lens) + np.arange(lens.sum())
            inter = np.add.reduceat(seen[flat[at]].astype(np.int64), starts)
            for j in part[100 * inter >= percent * (lens + size[i] - inter)]:
                if root[j] != root[i]:
                    old, new = max(root[j], root[i]), min(root[j], root[i])
                    root[root == old] = new
            cand = cand[root[cand] != root[i]]
        seen[mine] = False
    most = np.iinfo(np.int64).max
    least, own = np.full(n, most), np.full(n, most)
    np.minimum.at(least, root, ids)
    np.minimum.at(own, part_of, ids)
    pairs = {(a, b) for a, b in zip(least[root].tolist(), own[part_of].tolist(), strict=True) if a != b}
    return sorted(pairs)


def _verify(percent: int):
    def run(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        cluster, block, part, ids = (unit.column(c).to_numpy() for c in ("cluster", "block", "part", "doc_id"))
        order = np.lexsort((ids, block, cluster))
        cluster, block, part, ids = cluster[order], block[order], part[order], ids[order]
        texts = common.text_column(unit.select(["text"]).take(pa.array(order)).combine_chunks().to_batches()[0]) if len(order) else None
        links: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(cluster)], strict=True):
            u, off = shingle_sets(texts.slice(a, b - a))
            blocks = block[a:b]
            links += forest(ids[a:b], u, off, percent, blocks if blocks[0] != blocks[-1] else None, part[a:b])
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _links(texts: DataFrame, percent: int) -> DataFrame:
    """a, b: the stars of all units of texts (doc_id, text, cluster, block, part, unit); part is what is connected already."""
    # a number of its own keeps units apart that are small in bytes and long in work
    units = texts.repartition(common.partitions(texts.sparkSession), "unit")
    return common.written(units.groupBy("unit").applyInArrow(_verify(percent), "a long, b long"), "near-links")


def _blocks(docs: F.Column, shingles: F.Column) -> F.Column:
    return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _rest(texts: DataFrame, members: DataFrame, sizes: DataFrame, links: DataFrame, percent: int) -> DataFrame | None:
    """Stars between what is outside the largest component of a large cluster and all of it; None without such."""
    large = sizes.where("blocks > 1")
    if not large.head(1):
        return None
    found, large = graphs.components(links, "near-parts"), common.written(large, "near-large")
    roots = found.select(F.col("node").alias("rep"), "root")
    inside = members.join(common.shuffled(large), "cluster").join(common.shuffled(roots), "rep", "left")
    inside = common.written(inside.select("rep", "n", "cluster", "blocks", F.coalesce("root", "rep").alias("part")), "near-inside")
    common.discard(found, large)
    parts = inside.groupBy("cluster", "part").agg(F.count("*").alias("docs"))
    main = common.written(parts.groupBy("cluster").agg(F.max_by("part", "docs").alias("main")), "near-main")
    told = common.written(inside.join(common.shuffled(main), "cluster").withColumn("out", F.col("part") != F.col("main")), "near-inside")
    common.discard(inside, main)
    out = common.written(told.where("out").groupBy("cluster").agg(_blocks(F.count("*"), F.sum("n")).alias("others")), "near-out")
    inside = told.join(common.shuffled(out), "cluster")
    block, other = F.pmod(F.xxhash64("rep"), "blocks").cast("int"), F.pmod(F.xxhash64("rep", F.lit(1)), "others").cast("int")
    ranges = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    all_ = inside.select("rep", "cluster", "part", block.alias("b"), ranges("others").alias("o"), F.lit(0).alias("block"))
    outside = inside.where("out").select("rep", "cluster", "part", ranges("blocks").alias("b"), other.alias("o"), F.lit(1).alias("block"))
    work = all_.unionAll(outside).select(F.col("rep").alias("doc_id"), "cluster", "block", "part", F.xxhash64("cluster", "b", "o").alias("unit"))
    more = _links(texts.where("own").select("doc_id", "text").join(common.shuffled(work), "doc_id"), percent)
    common.discard(told, out)
    return more


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: links are 100 * intersection >= percent * union."""
    if percent < 80:
        raise ValueError("the bands are made for similarities from 0.8")
    sigs = common.written(signatures(docs, percent), "near-signatures")
    classes = common.written(sigs.where("n_shingles > 0 and doc_id is not null").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")), "near-classes")
    reps = classes.groupBy("rep").agg(F.max("n").alias("n"))
    keys = sigs.where("n_shingles > 0").join(common.shuffled(reps.select(F.col("rep").alias("doc_id"))), "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("key"))
    keys = common.written(keys, "near-bands")
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select("key", "hub")
    edges = keys.join(common.shuffled(hubs), "key").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    clusters = graphs.components(edges, "near-clusters")
    common.discard(keys)
    members = clusters.select(F.col("node").alias("rep"), F.col("root").alias("cluster")).unionAll(clusters.select(F.col("root"), F.col("root")).distinct())
    members = common.written(members.join(reps, "rep"), "near-members")
    common.discard(clusters)
    # written before the join, so that both its sides are plain shuffles, of which Spark can split a large cluster
    sizes = common.written(members.groupBy("cluster").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks")), "near-sizes")
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    bins = max(1, -(-total // (BLOCK_SHINGLES // 2)))
    work = members.join(common.shuffled(sizes), "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    # the first block meets all, each other one the first and itself
    others = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0), F.col("block")))
    work = work.withColumn("other", F.explode(others))
    unit = F.when(F.col("blocks") > 1, F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(bins)))
    work = work.select(F.col("rep").alias("doc_id"), "cluster", "block", F.col("rep").alias("part"), unit.alias("unit"), (F.col("block") == F.col("other")).alias("own"))
    # the texts of clusters, written for both looks at them
    texts = common.written(docs.select("doc_id", "text").join(common.shuffled(work), "doc_id").where(F.col("text").isNotNull()), "near-texts")
    links = _links(texts, percent)
    more = _rest(texts, members, sizes, links, percent)
    common.discard(texts, members, sizes)
    found = graphs.components(links if more is None else links.unionAll(more), "near-components")
    common.discard(*(t for t in (links, more) if t is not None))
    roots = found.select(F.col("node").alias("rep"), "root")
    same = classes.join(common.shuffled(roots), "rep", "left").select("fp1", "fp2", F.coalesce("root", "rep").alias("component"))
    found = sigs.select("doc_id", "n_shingles", "fp1", "fp2").join(common.shuffled(same), ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), percent=85)


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, the one with the smallest doc_id (null last), with all its columns; each row counts by itself."""
    docs = common.keyed(docs, ordered=True)
    judged = docs.select(F.col("_row").alias("doc_id"), "text")
    gone = common.settled(lambda: near_duplicates(judged).where(~F.col("kept")).select(F.col("doc_id").alias("_row")), "near-gone")
    return docs.join(common.shuffled(gone), "_row", "left_anti").drop("_row")
