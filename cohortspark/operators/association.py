"""Dosage rows (a variant with one array element a sample): frequencies, relatedness, score statistics.

Sums over variants are additive, so partial results of tasks and of chromosomes just add up. Arrays are read as matrices
straight from the Arrow buffers; lists of samples are index arrays that are broadcast, not literals of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark import lineage

from . import blocks

#: Samples in a tile of a relatedness matrix: a tile is TILE by TILE numbers.
TILE = 2048
#: Most scores (a variant with a phenotype each) of a batch of rows, phenotypes of a batch, and scores of a task.
SCORES, PHENOTYPES, TASK_SCORES = 1 << 17, 512, 1 << 22


def allele_frequency(dosages: Column, members: Column | None = None) -> Column:
    """Half the mean dosage of all samples, or of those whose mask is true (0 if there are none)."""
    if members is None:
        chosen, n = dosages, F.size(dosages)
    else:
        chosen = F.zip_with(dosages, members, lambda d, m: F.when(m, d).otherwise(0.0))
        n = F.aggregate(members, F.lit(0), lambda s, m: s + m.cast("int"))
    total = F.aggregate(chosen, F.lit(0.0), lambda s, d: s + d)
    return F.when(n == 0, total).otherwise(total / (2 * n))


def frequencies(variants: DataFrame, groups: dict[str, np.ndarray], column: str = "dosages") -> DataFrame:
    """variants with a column for each group of samples (their places): half their mean dosage, 0 if there are none."""
    names = list(groups)
    sizes = [len(groups[n]) for n in names]
    shared = variants.sparkSession.sparkContext.broadcast([np.asarray(groups[n], np.int64) for n in names])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in variants.schema), *(f"`{n}` double" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, d in blocks.values(batches, column):
            new = [pa.array(d[:, at].sum(1) / (2 * max(n, 1))) for at, n in zip(shared.value, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *names])

    return variants.mapInArrow(run, schema)


def select_samples(dosages: Column, positions: list[int]) -> Column:
    """Elements at a few given places, in their order; for many there is take_samples()."""
    return F.transform(F.array(*(F.lit(i) for i in positions)), lambda i: F.get(dosages, i))


def take_samples(variants: DataFrame, positions: np.ndarray, column: str = "dosages") -> DataFrame:
    """variants with the elements at the given places, in their order, in place of the column."""
    shared = variants.sparkSession.sparkContext.broadcast(np.asarray(positions, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, d in blocks.values(batches, column):
            i = b.schema.get_field_index(column)
            yield pa.RecordBatch.from_arrays([*b.columns[:i], lists(d[:, shared.value]), *b.columns[i + 1 :]], names=b.schema.names)

    return variants.mapInArrow(run, variants.schema)


def lists(m: np.ndarray) -> pa.Array:
    """Rows of a matrix as an array of lists."""
    offsets = np.arange(0, m.size + 1, max(1, m.shape[1]))[: len(m) + 1] if m.shape[1] else np.zeros(len(m) + 1, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.ascontiguousarray(m, np.float64).ravel()))


def standardise(d: np.ndarray) -> np.ndarray:
    """Rows (variants) about their mean by the binomial standard deviation; a constant variant is an error."""
    mean = d.mean(1, keepdims=True)
    with np.errstate(invalid="ignore"):
        sd = np.sqrt(mean * (1 - mean / 2))
    if (~(sd > 1e-8)).any():
        raise ValueError("a variant without variance cannot be standardised")
    return (d - mean) / sd


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(key, standardised dosages) of each key in each batch of (key, dosages)."""
    for b, d in blocks.values(batches, "dosages"):
        key = b.column(0).to_numpy()
        for k in np.unique(key).tolist():
            yield k, standardise(d[key == k])


def gram(variants: DataFrame, key: str = "chromosome", tile: int = TILE) -> DataFrame:
    """key, n_variants, i, values: sum of z z' of the standardised variants, row by row, n by n.

    Each task adds up tiles for the keys it meets; a key's tiles are added in a tree. A matrix has samples**2 elements,
    whatever the number of variants; what moves are the tiles on and above the diagonal, once a task and key.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        counts: dict[int, int] = {}
        for k, z in _by_key(batches):
            counts[k] = counts.get(k, 0) + len(z)
            parts = [z[:, at : at + tile] for at in range(0, z.shape[1], tile)]
            for i, left in enumerate(parts):
                for j in range(i, len(parts)):
                    own = left.T @ parts[j]
                    sums[k, i, j] = sums[k, i, j] + own if (k, i, j) in sums else own
        for (k, i, j), g in sums.items():
            yield blocks.batch({"key": k, "ti": i, "tj": j, "columns": g.shape[1]}, g, counts[k])

    parts = variants.select(F.col(key).cast("int").alias("key"), "dosages").mapInArrow(partial, f"key int, ti int, tj int, columns int, {blocks.SCHEMA}")
    tiles = blocks.add_up(parts, ["key", "ti", "tj", "columns"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, ti, tj, columns, n, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                g = blocks.array(block).reshape(-1, columns)
                for a, c, m in {(ti, tj): (ti, tj, g), (tj, ti): (tj, ti, g.T)}.values():
                    size = len(m)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(size, k)), pa.array(np.full(size, n)), pa.array(a * tile + np.arange(size)), pa.array(np.full(size, c, np.int32)), lists(m)], names=["key", "n_variants", "i", "tj", "values"])

    cells = tiles.mapInArrow(rows, "key long, n_variants long, i long, tj int, values array<double>")
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("tj", "values"))), lambda t: t["values"]))
    return cells.groupBy(F.col("key").alias(key), "n_variants", "i").agg(whole.alias("values"))


def leave_one_out(grams: DataFrame, key: str = "chromosome", exclude: tuple[int, ...] = (23,)) -> DataFrame:
    """For each key the sum of all other keys' matrices (sex chromosomes left out): total minus own, row by row."""

    def run(group: pa.Table) -> pa.Table:
        m = np.array(group.column("values").combine_chunks().flatten()).reshape(group.num_rows, -1)
        n = group.column("n_variants").to_numpy()
        return pa.table({key: group.column(key), "i": group.column("i"), "n_variants": pa.array(n.sum() - n), "values": lists(m.sum(0) - m)})

    used = grams.where(~F.col(key).isin(*exclude)).select(F.col(key).cast("long"), "i", "n_variants", "values")
    return used.groupBy("i").applyInArrow(run, f"{key} long, i long, n_variants long, values array<double>")  # a row of each key


def collect_matrix(rows: DataFrame) -> np.ndarray:
    """A matrix of samples**2 elements from its rows (i, values)."""
    got = sorted((r.i, r["values"]) for r in rows.select("i", "values").collect())
    return np.array([v for _, v in got])


def triangular(variants: DataFrame, key: str = "chromosome") -> DataFrame:
    """key, i, values: rows of R with R'R = sum of z z', by QR in every task and over the factors in a tree.

    Better conditioned than gram(). The factors that meet have at most samples rows each, and few of them meet at a time.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for k, z in _by_key(batches):
            have[k] = np.linalg.qr(np.vstack([have[k], z]) if k in have else z, mode="r")
        for k, r in have.items():
            yield blocks.batch({"key": k, "columns": r.shape[1]}, r)

    def stacked(columns: int):
        return lambda a, b: np.linalg.qr(np.vstack([a.reshape(-1, columns), b.reshape(-1, columns)]), mode="r").ravel()

    parts = variants.select(F.col(key).cast("int").alias("key"), "dosages").mapInArrow(local, f"key int, columns int, {blocks.SCHEMA}")
    samples = variants.select(F.size("dosages")).head()
    factors = blocks.fold(parts, ["key", "columns"], stacked(samples[0] if samples else 1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, columns, block in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("key", "columns", "block")), strict=True):
                r = blocks.array(block).reshape(-1, columns)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), k)), pa.array(np.arange(len(r))), lists(r)], names=["key", "i", "values"])

    return factors.mapInArrow(rows, "key long, i long, values array<double>").withColumnRenamed("key", key)


Inverse = Callable[[slice], np.ndarray]
Weights = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | Inverse, list[str]]


def scored(batches: Iterator[pa.RecordBatch], models: dict[str, Weights], keep: list[str], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of keep, collection, phenotype, u, v, of SCORES rows at most, whatever the numbers of variants and phenotypes.

    models is as in score_blocks(), with 1 / v in place of v, as a matrix or as a function of a slice of the phenotypes.
    """
    for b, d in blocks.values(batches, column):
        for collection, (at, w, q, inv, names) in models.items():
            g = d[:, at]
            g = g - g.mean(1, keepdims=True)
            rotated = (g @ q) ** 2
            own, names = [b.column(b.schema.get_field_index(c)) for c in keep], pa.array(names, pa.string())
            wide = max(1, min(len(names), PHENOTYPES))
            for i in range(0, len(g), SCORES // wide):
                for j in range(0, len(names), wide):
                    rows, columns = slice(i, i + SCORES // wide), slice(j, j + wide)
                    u, var = g[rows] @ w[:, columns], rotated[rows] @ (inv(columns) if callable(inv) else inv[:, columns])
                    zero = np.abs(var) <= 1e-8
                    u, var = np.where(zero, 0.0, u), np.where(zero, 1.0, var)
                    row = pa.array(i + np.repeat(np.arange(u.shape[0]), u.shape[1]))
                    name = names.take(pa.array(j + np.tile(np.arange(u.shape[1]), u.shape[0])))
                    yield pa.RecordBatch.from_arrays([*(c.take(row) for c in own), pa.array([collection], pa.string()).take(pa.array(np.zeros(len(row), np.int32))), name, pa.array(u.ravel()), pa.array(var.ravel())], names=[*keep, "collection", "phenotype", "u", "v"])


def score_blocks(variants: DataFrame, models: dict[str, Weights], keep: list[str], column: str = "dosages") -> DataFrame:
    """keep, collection, phenotype, u, v: score statistics of every variant and phenotype of all collections, in one scan.

    models has for each collection the places of its samples, w, q, v and the phenotypes' names. With null models rotated by
    the eigenvectors q (samples by k) and their variances v (k by phenotypes), and w = q (residuals / sqrt(v)) (samples by
    phenotypes): U = (g - mean) w and V = ((g - mean) q)**2 (1 / v). In place of v there may be a function that gives 1 / v of a
    slice of the phenotypes (nullmodel.Variances). The matrices are broadcast; they grow with samples and phenotypes, not
    with variants. Scores are made and handed on in tiles of bounded size.
    """
    shared = variants.sparkSession.sparkContext.broadcast({c: (np.asarray(at, np.int64), w, q, v if callable(v) else 1 / v, names) for c, (at, w, q, v, names) in models.items()})
    fields = [f for f in variants.schema if f.name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "collection string, phenotype string, u double, v double"])
    order = [f.name for f in fields]
    return variants.select(*order, column).mapInArrow(lambda batches: scored(batches, shared.value, order, column), schema)


def dealt(variants: DataFrame, phenotypes: int) -> DataFrame:
    """variants over so many tasks that none makes more than about TASK_SCORES scores: what a few small files hold can make
    very many of them."""
    n = -(-variants.count() * phenotypes // TASK_SCORES)
    return variants.repartition(max(n, lineage.partitions(variants.sparkSession)))


def score_block(variants: DataFrame, w: np.ndarray, q: np.ndarray, v: np.ndarray | Inverse, names: list[str], keep: list[str]) -> DataFrame:
    """score_blocks() of one collection of all samples, without its name."""
    return score_blocks(variants, {"": (np.arange(len(w)), w, q, v, names)}, keep).drop("collection")
