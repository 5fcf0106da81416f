"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1; each bit is predicted by a linear classifier (ridge regression) on hashed
byte 1- to 3-grams (square roots of their shares). Up to seven languages take the exhaustive code of 2**(k-1) - 1
bits, more take the pseudorandom code of 15 * log2(k) bits with the largest least distance of many tries. Decoding
is loss-weighted: a language's distance is the squared hinge loss of the bits against its codeword, each bit weighed
by how often its classifier was right on that language's training texts. The nearest codeword wins; where the next one
is almost as near the answer is flagged as ambiguous.

Bounded sample: at most SAMPLE labelled rows in all (one of each language if there are more languages than that), the
same number of each language and at most EACH, those with the smallest xxhash64(doc_id); each gives its whole text and
one short stretch of it as examples, copies of a row only once. Predictions use every text whole
and nothing but the text.

Defined results: a null text or one without a letter gives `und`, score 0, ambiguous; without any labelled text
everything is `und`; with one language it is always that one; repeated rows give repeated rows; a null doc_id is
kept; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SAMPLE, EACH = 1200, 1000
BUCKETS = 4096
ORDERS = (1, 2, 3)
RIDGE = 0.3
SHARPNESS = 6.0
AMBIGUOUS = 0.15
SCHEMA = "doc_id long, lang_pred string, score double, ambiguous boolean"

_CLEAN = np.full(256, 32, np.uint8)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[65:91] = np.arange(97, 123)
_CLEAN[128:] = np.arange(128, 256)
_LETTER = re.compile(r"[^\W\d_]")


def ngrams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams, a row for each text."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))  # bytes to the end of the row
    x = _CLEAN[data].astype(np.uint32)
    h = np.zeros(len(data), np.uint32)
    out = np.zeros(n * BUCKETS + 1)
    for order in range(1, max(ORDERS) + 1):
        h[: len(x) - order + 1] = (h[: len(x) - order + 1] + x[order - 1 :] + 1) * np.uint32(0x9E3779B1)
        if order in ORDERS:
            bucket = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - 12)
            out += np.bincount(np.where(left >= order, row * BUCKETS + bucket, n * BUCKETS), minlength=len(out))
    out = out[:-1].reshape(n, BUCKETS)
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1)).astype(np.float32)


def codebook(k: int) -> np.ndarray:
    """A codeword of +1 and -1 for each of k languages."""
    if k <= 1:
        return np.ones((k, 0))
    if k <= 7:
        return np.array([[1 if i == 0 else 1 - 2 * b[i - 1] for b in itertools.product((0, 1), repeat=k - 1) if any(b)] for i in range(k)], float)
    rng, best = np.random.Generator(np.random.PCG64(11)), (-1, None)
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (k, math.ceil(15 * math.log2(k))))
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(k) * 1e9
        if apart.min() > best[0] and (abs(code.sum(0)) < k).all():
            best = (apart.min(), code)
    return best[1]


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray) -> None:
        self.langs, self.code, self.weights, self.bias, self.trust = langs, code, weights.astype(np.float32), bias, trust

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of each text to each language's codeword."""
        f = x @ self.weights + self.bias
        loss = np.maximum(0, 1 - f[:, None, :] * self.code[None]) ** 2
        return (loss * self.trust[None]).sum(2)


def _stretch(raw: bytes, seed: int) -> bytes:
    size = 30 + seed % 90
    at = (seed // 97) % max(1, len(raw) - size)
    return raw[at : at + size]


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learns from docs (doc_id, text, lang); None without a labelled text."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("order"), F.xxhash64("text").alias("digest"))
    rows = labelled.select("doc_id", "lang", "order", "digest").distinct()
    langs = [r.lang for r in rows.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return None
    each = min(EACH, max(1, sample // len(langs)))  # up to 1000 Spark cuts each task's ranks before the shuffle
    picked = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id", "digest"))).where(F.col("n") <= each).drop("n")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("order", "lang", "digest", "doc_id")]
    texts = labelled.alias("l").join(F.broadcast(picked.alias("p")), same, "left_semi").groupBy("doc_id", "lang", "digest").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 1 << 19):
            raw = [t.encode() for t in common.text_column(b).to_pylist()]
            rows = [r for i, r in enumerate(raw) for r in (r, _stretch(r, len(r) * 7919 + i))]
            x = ngrams(np.frombuffer(b"".join(rows), np.uint8), np.r_[0, np.cumsum([len(r) for r in rows])])
            lang = b.column(1).take(pa.array(np.repeat(np.arange(len(raw)), 2)))
            yield pa.RecordBatch.from_arrays([lang, pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    got = texts.select("doc_id", "lang", "text").mapInArrow(run, "lang string, x binary").collect()  # two vectors a picked row
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), np.float32).reshape(len(got), BUCKETS)
    y = np.array([langs.index(r.lang) for r in got])
    code = codebook(len(langs))
    if not code.shape[1]:
        return Model(langs, code, np.zeros((BUCKETS, 0)), np.zeros(0), np.ones((1, 0)))
    mean = x.mean(0)
    target = code[y]
    xc = (x - mean).astype(np.float64)
    # as many unknowns as examples: the dual form
    alpha = np.linalg.solve(xc @ xc.T + RIDGE * np.eye(len(xc)), target - target.mean(0))
    weights = xc.T @ alpha
    bias = target.mean(0) - mean @ weights
    right = (np.sign(x @ weights + bias) == target).astype(float)
    trust = np.array([right[y == c].mean(0) if (y == c).any() else np.ones(code.shape[1]) for c in range(len(langs))])
    return Model(langs, code, weights, bias, trust / trust.sum(1, keepdims=True))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every text."""
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in common.slices(batches):
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                col = common.text_column(b)
                x = ngrams(*common.buffers(col))
                d = m.distances(x)
                p = np.exp(-SHARPNESS * (d - d.min(1, keepdims=True)))
                p /= p.sum(1, keepdims=True)
                order = np.sort(p, axis=1)
                letters = np.array([_LETTER.search(t) is not None for t in col.to_pylist()])
                lang = [m.langs[i] if ok else "und" for i, ok in zip(p.argmax(1), letters, strict=True)]
                near = ~letters if p.shape[1] < 2 else ~letters | (order[:, -1] - order[:, -2] < AMBIGUOUS)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(np.where(letters, order[:, -1], 0.0)), pa.array(near)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
