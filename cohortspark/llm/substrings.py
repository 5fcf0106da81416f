"""Substring deduplication by relative Lempel-Ziv parsing.

The reference of a document is every document with a smaller doc_id. Every distinct window of WINDOW words is indexed
once, at its home: the first place of the smallest document that has it. The index is made in blocks: each window belongs
to the smallest ANCHOR-word hash within it, neighbouring windows with one anchor form a run, and all runs of an anchor,
whichever documents they are from, lie in one index block.

A document is factored greedily against all blocks: a factor begins at a window that has a home in a smaller document
and goes on, window by window, as long as the next window's home is the next place of the same document; it is (first
word, words, source, first word in the source) and is found there word for word. The next factor begins behind it; what is
in no factor is literal. Factors shorter than WINDOW words do not arise. At factor boundaries, the windows that reach
over the end of a factor are looked up as well: the duplicate spans are all words of all windows that have a home in a
smaller document, whether one factor holds them or two that meet.

Blocks whose runs are all equal (128 bits) are settled by their smallest doc_id alone. In the others the windows
themselves are compared by hash (128 bits with the anchor); these are the ends of shared passages. Every comparison
is a map-side combined minimum and a join whose large keys Spark can split: no group meets in one task.

Defined results: a null or wordless text has 0 words and the digest of an empty string; texts with fewer than
WINDOW words lose nothing; a null doc_id is neither smaller nor larger than another, loses nothing and is no
reference; rows that repeat a doc_id are each parsed and are no reference for each other; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW, ANCHOR = 50, 8
RUNS = "doc_id long, digest long, start int, n int, anchor long, body long, home int"
WINDOWS = "doc_id long, digest long, start int, anchor long, body long, home int"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors int"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text")


def _homes(row: np.ndarray, start: np.ndarray, anchor: np.ndarray, body: np.ndarray) -> np.ndarray:
    """The first `start` of the same words in the same row; rows and starts rise."""
    _, first, of = np.unique(common.mix2(common.mix2(row.astype(np.uint64), anchor), body), return_index=True, return_inverse=True)
    return start[first][of]


def runs(docs: DataFrame) -> DataFrame:
    """Runs of n windows from word `start` that share an anchor, a hash of all their words, and their first place in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            words = common.Words(common.text_column(b))
            h = words.hashes
            if len(h) < WINDOW:
                continue
            bodies = common.grams(h, WINDOW)
            anchors = common.sliding_min(common.grams(h, ANCHOR), WINDOW - ANCHOR + 1)
            row = np.repeat(np.arange(b.num_rows), words.counts())[: len(bodies)]
            ok = np.flatnonzero(np.arange(len(bodies)) + WINDOW <= words.rows[1:][row])
            if not len(ok):
                continue
            row, anchor = row[ok], anchors[ok]
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
            n = np.diff(np.r_[first, len(ok)])
            place = (np.arange(len(ok)) - np.repeat(first, n)).astype(np.uint64)
            body = common.fmix(np.add.reduceat(common.mix2(bodies[ok], place), first) + n.astype(np.uint64))
            at = row[first]
            start = (ok[first] - words.rows[at]).astype(np.int32)
            home = _homes(at, start, anchor[first], body)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(start), pa.array(n.astype(np.int32)), pa.array(common.signed(anchor[first])), pa.array(common.signed(body)), pa.array(home)],
                names=["doc_id", "digest", "start", "n", "anchor", "body", "home"],
            )

    return _texts(docs).where("doc_id is not null").mapInArrow(run, RUNS)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches):
        words = common.Words(common.text_column(b))
        bodies = common.grams(words.hashes, WINDOW)
        lists = b.column(3)
        flat = lists.flatten()
        start, n, anchor = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        row = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        each = np.repeat(np.arange(len(n)), n)
        at = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        row, at, anchor = row[each], at.astype(np.int32), anchor[each]
        order = np.lexsort((at, row))
        row, at, anchor = row[order], at[order], anchor[order]
        body = bodies[words.rows[row] + at]
        home = _homes(row, at, anchor.view(np.uint64), body)
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(at), pa.array(anchor), pa.array(common.signed(body)), pa.array(home)], names=["doc_id", "digest", "start", "anchor", "body", "home"])


def matches(docs: DataFrame) -> DataFrame:
    """doc_id, digest, start, n, source, at: n windows from `start` whose homes are `source`'s from `at` on."""
    all_ = common.written(runs(docs), "lz-runs")
    # rows with the smallest doc_id of a block hold the same words, so that they all name the same first place
    home = (F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min_by("home", "doc_id").alias("at"))
    blocks = all_.groupBy("anchor").agg(*home, (F.min("body") == F.max("body")).alias("equal"))
    # written before the join, so that both its sides are plain shuffles, of which Spark can split large keys
    blocks = common.written(blocks.where("source < last").select("anchor", "source", "at", "equal"), "lz-blocks")
    hits = common.written(all_.join(common.shuffled(blocks), "anchor").where("not equal or source < doc_id").select("doc_id", "digest", "start", "n", "anchor", "source", "at", "equal"), "lz-hits")
    common.discard(all_, blocks)
    mixed = hits.where("not equal").groupBy("doc_id", "digest").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("runs"))
    windows = common.written(_texts(docs).join(common.shuffled(mixed), ["doc_id", "digest"]).select("doc_id", "digest", "text", "runs").mapInArrow(_windows, WINDOWS), "lz-windows")
    first = common.written(windows.groupBy("anchor", "body").agg(*home).where("source < last").drop("last"), "lz-first")
    single = windows.join(common.shuffled(first), ["anchor", "body"]).where("source < doc_id").select("doc_id", "digest", "start", F.lit(1).alias("n"), "source", "at")
    return hits.where("equal").select("doc_id", "digest", "start", "n", "source", "at").unionAll(single)


Spans = list[tuple[int, int]]
Factors = list[tuple[int, int, int, int]]


def parse(start: np.ndarray, n: np.ndarray, source: np.ndarray, at: np.ndarray) -> tuple[Spans, Factors]:
    """Duplicate spans (first word, words) and greedy factors (first word, words, source, first word in the source)."""
    order = np.argsort(start, kind="stable")
    spans: list[list[int]] = []
    chains: list[list[int]] = []
    for s, k, d, p in zip(*(x[order].tolist() for x in (start, n, source, at)), strict=True):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], s + k - 1 + WINDOW)
        else:
            spans.append([s, s + k - 1 + WINDOW])
        last = chains[-1] if chains else None
        if last and last[2] == d and last[0] + last[1] == s and last[3] + last[1] == p:
            last[1] += k
        else:
            chains.append([s, k, d, p])
    out, end = [], 0
    for s, k, d, p in chains:
        first = max(s, end)
        if first < s + k:  # else no window of the chain begins behind the last factor
            end = s + k - 1 + WINDOW
            out.append((first, end - first, d, p + first - s))
    return [(a, b - a) for a, b in spans], out


def _parsed(docs: DataFrame) -> DataFrame:
    found = matches(docs).groupBy("doc_id", "digest").agg(F.collect_set(F.struct("start", "n", "source", "at")).alias("matches"))
    return _texts(docs).join(common.shuffled(common.written(found, "lz-matches")), ["doc_id", "digest"], "left").select("doc_id", "text", "matches")


def _each(b: pa.RecordBatch) -> Iterator[tuple[list[bytes], Spans, Factors]]:
    """Words, duplicate spans and factors of each row."""
    lists = b.column(2)
    flat = lists.flatten()
    start, n, source, home = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    lens = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    to = np.cumsum(lens)
    for text, a, e in zip(common.text_column(b).to_pylist(), to - lens, to, strict=True):
        yield text.encode().split(), *(parse(start[a:e], n[a:e], source[a:e], home[a:e]) if e > a else ([], []))


def _kept(words: list[bytes], spans: Spans) -> list[bytes]:
    out, at = [], 0
    for s, k in spans:
        out += words[at:s]
        at = s + k
    return out + words[at:]


_SPAN = pa.struct([("start", pa.int32()), ("length", pa.int32())])
_FACTOR = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64()), ("position", pa.int32())])


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, text without the words of duplicate spans (words joined by one space), spans, factors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            got = list(_each(b))
            spans = pa.array([[dict(zip(("start", "length"), x, strict=True)) for x in s] for _, s, _ in got], pa.list_(_SPAN))
            factors = pa.array([[dict(zip(("start", "length", "source", "position"), x, strict=True)) for x in f] for _, _, f in got], pa.list_(_FACTOR))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([b" ".join(_kept(w, s)).decode() for w, s, _ in got], pa.string()), spans, factors], names=["doc_id", "text", "spans", "factors"])

    return _parsed(docs).mapInArrow(run, "doc_id long, text string, spans array<struct<start: int, length: int>>, factors array<struct<start: int, length: int, source: long, position: int>>")


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_factors of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            total, removed, digest, count = [], [], [], []
            for words, spans, found in _each(b):
                kept = _kept(words, spans)
                total.append(len(words))
                removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                count.append(len(found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(count, pa.int32())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors"])

    return _parsed(docs).mapInArrow(run, RESULT)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(common.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
