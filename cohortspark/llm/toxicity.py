"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks.

A text is a bag of words (lower case, letters only: marks, digits and underscores inside a word go, runs of single
letters are read as one word, so that "i-d.i o t" is a word again, and neighbours that together begin and end like a
telling word are read as one besides, as "idi ot"). Runs of more than LONGEST letters, as in texts without spaces,
have the highest value of the windows that cover them. Two words are compared by the gap-weighted kernel of their
common subsequences of three characters, anchored at both ends and divided by both words' exact norms: a
subsequence counts DECAY for each character that it spans beyond three, so an inserted or missing character costs a
little and not everything.

The machine is trained on words of labelled texts, in rounds. Telling words, and beginnings of words where the endings
vary, are those whose counts in toxic texts of the sample are beyond chance (a likelihood ratio that at most CHANCE
words of the whole lexicon would reach); they are positive examples, and, as far as they occur in other texts too,
negative ones by that weight. Variants with letters put in, two letters put in and a letter left out are positive
examples besides. Common words and those most easily taken for telling ones are negative, and after the first round
the words that decided the texts join in on either side. Landmarks are telling, common, confusable and varied words; in
their Nystroem space a linear machine with squared hinge loss is fitted. As kernel, landmarks and machine are linear in
the subsequences of a word, they fold into one weight per subsequence, so that scoring needs no kernel at all. A
logistic fit turns the TOP highest values of a text's words (a word counts as often as it occurs) into a probability;
it also sees every toxic text of the sample a second time, by the weight WORN, with each telling word replaced by a variant.

Letters beyond a to z share CODES - 29 codes by code point; those of Latin-1 are kept apart.

Bounded sample: at most SAMPLE labelled training texts of each class, those with the smallest xxhash64(doc_id), of
which all words count; nothing else is gathered. Scores cover every text whole.

Defined results: null, empty or letterless texts get the probability of a text without any word (the lowest
value); without labels of both classes, or where no word tells, every score is 0; labels of one document that
contradict each other count for nothing, equal ones once; of rows that repeat a labelled doc_id each different text is
an example, and all rows are scored; null doc_id is kept in the scores and never learnt from; further columns are
ignored (the filter keeps them); an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SCHEMA = "doc_id long, score double, predicted int"
THRESHOLD = 0.3
SAMPLE = 1500
LANDMARKS = 160
DECAY = 0.6
SPAN = 6
LONGEST = 24
#: Letters and step of the windows over a run of more than LONGEST letters.
WINDOWS = ((LONGEST, LONGEST // 2), (6, 1))
CODES = 96
RIDGE = 0.05
#: Highest values of a text that count, and their range.
TOP = 3
LOWEST, HIGHEST = -0.5, 1.5
#: Cost of a variant in the machine (of a whole word: 5), and weight of a worn text in the logistic fit (of a text: 1).
VARIED, WORN = 2.0, 0.3
#: Mark and lengths of beginnings of words, which tell where endings vary.
OPEN, STEMS = "…", (5, 6, 7)
#: Occurrences of a word, or words of a beginning, that count of a text.
OFTEN = 6
#: Words of the lexicon that may pass for telling by chance.
CHANCE = 20
_CACHE_LIMIT = 400_000

_WORDS = re.compile(r"[^\W\d_]+(?:[^\w\s]+[^\W\d_]+)*")
_INSERTED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d_]++[^\W\d_]++)+")
_MARKS = re.compile(r"[^\w]+")
_SPACED = re.compile(r"(?<!\w)[^\W\d_](?:[ \t*._-]{1,3}[^\W\d_]){2,}(?!\w)")
_TRIPLES = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN)]


def token_words(token: str) -> tuple[str, ...]:
    """The words of a run without spaces: across marks, between them, and across digits and underscores."""
    if token.isalpha():
        return (token,)
    out = []
    for w in _WORDS.findall(token):
        if w.isalpha():
            out.append(w)
        else:
            out += [_MARKS.sub("", w), *(p for p in _MARKS.split(w) if len(p) > 2)]
    return (*out, *(re.sub(r"[\d_]+", "", m) for m in _INSERTED.findall(token)))


def words(text: str, ends: frozenset[str] = frozenset(), known: dict[str, tuple[str, ...]] | None = None) -> dict[str, int]:
    """The words of a text and how often they occur; joined runs of single letters, parts between marks, and
    neighbours that together begin and end like one of `ends` come besides. known remembers the words of tokens."""
    known = {} if known is None else known
    low = text.lower()
    run = low.split()
    out: dict[str, int] = {}
    for token, n in Counter(run).items():
        ws = known.get(token)
        if ws is None:
            ws = known[token] = token_words(token)
        for w in ws:
            out[w] = out.get(w, 0) + n
    besides = [re.sub(r"[^\w]+", "", m) for m in _SPACED.findall(low)]
    if ends:
        first = {e[:2] for e in ends}
        for a, b in zip(run, run[1:], strict=False):
            if a[:2] in first and a[:2] + b[-2:] in ends and len(a) + len(b) <= LONGEST and a.isalpha() and b.isalpha():
                besides.append(a + b)
    for w in besides:
        out[w] = out.get(w, 0) + 1
    return out


def ends(ws: Iterable[str]) -> frozenset[str]:
    """The two letters at each end of words of five letters or more."""
    return frozenset(w[:2] + w[-2:] for w in ws if len(w) > 4)


def codes(ws: list[str]) -> np.ndarray:
    """Words as rows of character codes, padded: 0 none, 1 start, 2 end (none of a beginning), a to z, and the remaining
    ones for all other letters."""
    n = np.fromiter(map(len, ws), np.int64, len(ws))
    letters = np.frombuffer("".join(ws).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letters = np.where((letters >= 97) & (letters < 123), letters - 94, 29 + letters % (CODES - 29))
    out = np.zeros((len(ws), int(n.max(initial=0)) + 2), np.int32)
    row = np.repeat(np.arange(len(ws)), n)
    out[row, np.arange(len(letters)) - np.repeat(np.cumsum(n) - n, n) + 1] = letters
    out[:, 0] = 1
    out[np.arange(len(ws)), n + 1] = 2
    open_ = np.flatnonzero([w.endswith(OPEN) for w in ws])
    out[open_, n[open_]] = out[open_, n[open_] + 1] = 0
    return out


def subsequences(c: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Keys (rows by places) and weight of each shape of three characters within SPAN; a key that ends in padding is 0."""
    for j, k in _TRIPLES:
        if k < c.shape[1]:
            width = c.shape[1] - k
            key = (c[:, :width] * CODES + c[:, j : j + width]) * CODES + c[:, k:]
            key[c[:, k:] == 0] = 0
            yield key, DECAY ** (k - 2)


def sparse(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence, weight) of coded words, one for each subsequence of a word, in order."""
    rows, keys, weights = [], [], []
    for key, weight in subsequences(c):
        row, at = np.nonzero(key)
        rows.append(row)
        keys.append(key[row, at])
        weights.append(np.full(len(row), weight))
    row, key, weight = np.concatenate(rows), np.concatenate(keys), np.concatenate(weights)
    cell = row * CODES**3 + key
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    return row[order[first]], key[order[first]], np.add.reduceat(weight[order], first)


def features(ws: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse vectors (row, subsequence, value) of unit length: the kernel of two words is their inner product."""
    row, key, weight = sparse(codes(ws))
    norm = np.sqrt(np.bincount(row, weight**2, len(ws)))
    return row, key, weight / norm[row]


def windows(w: str) -> list[str]:
    """The word, or of one over LONGEST letters overlapping windows that cover all of it."""
    if len(w) <= LONGEST:
        return [w]
    return [w[min(at, len(w) - n) :][:n] for n, step in WINDOWS for at in range(0, len(w) - n + step, step)]


def _bound(n: np.ndarray) -> np.ndarray:
    """The least norm of a word with n codes: that of one in which no subsequence comes twice."""
    total = np.zeros(len(n))
    for _, k in _TRIPLES:
        total += np.maximum(n - k, 0) * DECAY ** (2 * (k - 2))
    return np.sqrt(np.maximum(total, 1e-300))


def evaluate(ws: list[str], weight: np.ndarray, offset: float = 0.0, lowest: float = -np.inf) -> np.ndarray:
    """The machine's value of each word, at least `lowest`, the highest of its windows; weight[0] is 0.

    The exact norm is only made where the value by the least norm that a word may have is over `lowest`.
    """
    if any(len(w) > LONGEST for w in ws):
        parts = [windows(w) for w in ws]
        n = np.fromiter(map(len, parts), np.int64, len(ws))
        return np.maximum.reduceat(evaluate([x for p in parts for x in p], weight, offset, lowest), np.cumsum(n) - n)
    out = np.zeros(len(ws))
    order = np.argsort(np.fromiter(map(len, ws), np.int64, len(ws)), kind="stable")
    for at in range(0, len(ws), 2048):
        part = order[at : at + 2048]
        c = codes([ws[i] for i in part])
        total = np.zeros(len(part))
        for key, w in subsequences(c):
            total += weight[key].sum(1) * w
        value = np.where(total > 0, total / _bound((c > 0).sum(1)), 0.0) + offset
        exact = np.flatnonzero(value > lowest)
        if len(exact):
            row, _, x = sparse(c[exact])
            value[exact] = total[exact] / np.sqrt(np.bincount(row, x**2, len(exact))) + offset
        out[part] = np.maximum(value, lowest)
    return out


class Machine:
    """Folded weights of subsequences, offset, and the ends of the words that tell the classes apart."""

    def __init__(self, weight: np.ndarray, offset: float, ends: frozenset[str]) -> None:
        self.weight, self.offset, self.ends = weight.astype(np.float32), offset, ends


class Values:
    """The highest values of each text's words, a word as often as it occurs; remembers words."""

    def __init__(self, machine: Machine) -> None:
        self.machine, self.known, self.tokens = machine, {}, {}

    def bags(self, texts: list[str]) -> list[dict[str, int]]:
        if len(self.tokens) > _CACHE_LIMIT:
            self.tokens.clear()
        return [words(t, self.machine.ends, self.tokens) for t in texts]

    def of(self, ws: Iterable[str]) -> dict[str, float]:
        if len(self.known) > _CACHE_LIMIT:
            self.known.clear()
        new = sorted(set(ws).difference(self.known))
        if new:
            values = evaluate(new, self.machine.weight, self.machine.offset, LOWEST)
            self.known.update(zip(new, np.minimum(values, HIGHEST).tolist(), strict=True))
        return self.known

    def top(self, bags: list[dict[str, int]]) -> tuple[np.ndarray, list[str | None]]:
        known = self.of(set().union(*bags))
        out, best = np.full((len(bags), TOP), LOWEST), []
        for i, bag in enumerate(bags):
            first = heapq.nsmallest(TOP, [w for w in bag if known[w] > LOWEST], key=lambda w: (-known[w], w))
            v = [known[w] for w in first for _ in range(min(bag[w], TOP))][:TOP]
            out[i, : len(v)] = v
            best.append(first[0] if first else None)
        return out, best


class Model:
    """The machine and the logistic map of a text's highest values."""

    def __init__(self, machine: Machine, logistic: np.ndarray) -> None:
        self.machine, self.logistic = machine, logistic

    def probability(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(values @ self.logistic[:-1] + self.logistic[-1], -30, 30)))

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        values = Values(self.machine)
        return lambda texts: self.probability(values.top(values.bags(texts))[0])


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        active = y * (x @ w) < 1
        xa = x[active] * cost[active, None]
        new = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _with_stems(bag: dict[str, int]) -> Counter[str]:
    """The bag with the beginnings of its words and how many distinct words have each."""
    out = Counter(bag)
    for w, n in bag.items():
        for k in STEMS:
            if len(w) >= k:
                out[w[:k] + OPEN] += 1
    return out


def _tells(w: str, seen: Container[str]) -> bool:
    """Whether the word, or its beginning, is among those seen."""
    return w in seen or any(w[:k] + OPEN in seen for k in STEMS if len(w) >= k)


def _lexicon(sample: DataFrame) -> DataFrame:
    """word, pos, neg, often, seldom: in how many sampled texts of each class a word, or a beginning of words, occurs, and
    how often (up to OFTEN a text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            label = b.column(b.schema.get_field_index("label")).to_pylist()
            found = [(w, y, min(n, OFTEN)) for t, y in zip(common.text_column(b).to_pylist(), label, strict=True) for w, n in _with_stems(words(t)).items()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32())], names=["word", "label", "n"])

    y = F.col("label")
    counts = (F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.sum(y * F.col("n")).alias("often"), F.sum((1 - y) * F.col("n")).alias("seldom"))
    return sample.mapInArrow(run, "word string, label int, n int").groupBy("word").agg(*counts)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, hard: int = 6000) -> Model | None:
    """Learns from docs (doc_id, text) and labels (doc_id, label 0 or 1); None without both classes.

    To the driver come: at most 2 * sample doc_ids, the landmarks, the words that are most like them (at most
    `hard`), and for each sampled text its best few words.
    """
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    one = common.written(one.select("doc_id", "label"), "toxic-labels")
    kept = [(r.doc_id, r.label) for y in (0, 1) for r in one.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    if len({y for _, y in kept}) < 2:
        return None
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame(kept, "doc_id long, label int"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id").groupBy("label", "text").agg(F.min("doc_id").alias("doc_id"))
    texts = common.written(texts, "toxic-sample")  # copies of a text are one example
    lexicon = common.written(_lexicon(texts), "toxic-words")
    sums = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    if len(sums) < 2:
        return None
    n_pos, n_neg = sums[1], sums[0]
    # how much likelier the counts of a word are by its own share of toxic texts than by that of all; a word counts if
    # of all the lexicon's words no more than CHANCE would reach as much by chance
    open_, share = F.col("word").endswith(OPEN), n_pos / (n_pos + n_neg)
    yes, no = F.when(open_, F.col("often")).otherwise(F.col("pos")), F.when(open_, F.col("seldom")).otherwise(F.col("neg"))
    own = yes / (yes + no)
    gain = yes * F.log(own / share) + F.when(no > 0, no * F.log((1 - own) / (1 - share))).otherwise(0.0)
    cut = math.log(max(lexicon.count() / CHANCE, 1.0))
    telling = lexicon.where("pos >= 2 and length(word) <= 24").where(own > share).withColumn("gain", gain).where(F.col("gain") > cut)
    best, by = [], {}
    for r in telling.orderBy(F.desc("gain"), F.col("word").endswith(OPEN), F.desc("word")).limit(10 * landmarks).collect():
        if r.word.endswith(OPEN) and any(w.startswith(r.word[:-1]) for w in by.get((r.pos, r.neg), ())):
            continue  # the beginning of a word, or a longer beginning, that tells as much
        by.setdefault((r.pos, r.neg), []).append(r.word)
        best.append(r)
    best = best[: landmarks // 2]
    whole = lexicon.where("length(word) <= 24").where(~F.col("word").endswith(OPEN))
    common_words = [r.word for r in whole.orderBy(F.desc("neg"), "word").limit(landmarks // 2).collect()]
    if not best:
        return None
    marks = list(dict.fromkeys([r.word for r in best] + common_words))

    def fold(coef: np.ndarray, ws: list[str]) -> np.ndarray:
        row, key, val = features(ws)
        return np.bincount(key, val * coef[row], CODES**3)

    # words of the other class that are most like one of the landmarks that tell the classes apart
    tops = np.zeros(CODES**3)
    for r in best:
        tops = np.maximum(tops, fold(np.ones(1), [r.word]))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(evaluate(b.column(0).to_pylist(), tops))], names=["word", "like"])

    rivals = [r.word for r in whole.where("neg > 0").select("word").mapInArrow(nearest, "word string, like double").orderBy(F.desc("like"), "word").limit(hard).collect()]
    negatives = list(dict.fromkeys([*common_words, *rivals]))
    # further landmarks: variants of the words that tell most, and the words that are most easily taken for them
    marks = list(dict.fromkeys([*marks, *(v for r in best[:landmarks // 4] for v in variants(r.word)[:: max(1, len(variants(r.word)) // 6)]), *rivals[: 2 * landmarks]]))
    values, vectors = np.linalg.eigh(gram(marks, marks))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    seen = {r.word: r for r in best}
    # words with telling beginnings
    stems = [w for w in seen if w.endswith(OPEN)]
    if stems:
        begins = reduce(Column.__or__, (F.concat(F.substring("word", 1, k), F.lit(OPEN)).isin(stems) for k in STEMS))
        for r in whole.where(begins).where("often > seldom").orderBy(F.desc("often"), "word").limit(hard).collect():
            seen.setdefault(r.word, r)
    for last in (False, True):
        pos = list(seen)
        varied = [(v, seen[w].often) for w in pos for v in variants(w)]
        mixed = [w for w in pos if seen[w].neg]
        # the last example is a word that has nothing in common with any landmark
        z = np.vstack([gram([*pos, *(v for v, _ in varied), *mixed, *negatives], marks) @ root, np.zeros((1, root.shape[1]))])
        y = np.r_[np.ones(len(pos) + len(varied)), -np.ones(len(mixed) + len(negatives) + 1)]
        cost = np.r_[[5.0 * np.sqrt(seen[w].often) for w in pos], [VARIED * np.sqrt(n) for _, n in varied], [5.0 * np.sqrt(seen[w].seldom) for w in mixed], np.full(len(negatives), 5.0), 100.0]
        w, offset = _svm(z, y, cost)
        machine = Machine(fold(root @ w, marks), offset, ends(w for w in seen if not w.endswith(OPEN)))
        top = _best_words(texts, machine, frozenset(seen)).collect()
        if last:
            break
        # new examples: the words that decided the toxic texts and tell the classes apart, and those that decided the others
        told = {r.word for r in top if r.label == 1 and r.word is not None} - set(seen)
        names = spark.createDataFrame([(x,) for x in sorted(told)], "word string")
        for r in whole.where("pos > neg").join(F.broadcast(names), "word").withColumn("gain", gain).collect():
            if r.gain > cut or _tells(r.word, seen):
                seen[r.word] = r
        negatives = list(dict.fromkeys([*negatives, *(r.word for r in top if r.label == 0 and r.word is not None and r.word not in seen and len(r.word) <= LONGEST)]))
    value = np.array([r.top for r in top] + [r.worn for r in top if r.worn is not None])
    label = np.array([r.label for r in top] + [1 for r in top if r.worn is not None])
    counts = {r.label: r["count"] for r in one.groupBy("label").count().collect()}
    weights = np.where(label == 1, counts[1] / n_pos, counts[0] / n_neg)
    weights[len(top) :] *= WORN
    return Model(machine, _logistic(value, label, weights / weights.mean()))


def gram(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel of all a with all landmarks b."""
    row, key, val = features(b)
    used, key = np.unique(key, return_inverse=True)
    place = np.full(CODES**3, len(used))  # the row after the last one is 0
    place[used] = np.arange(len(used))
    dense = np.zeros((len(used) + 1, len(b)), np.float32)
    np.add.at(dense, (key, row), val)
    out = np.zeros((len(a), len(b)))
    for at in range(0, len(a), 128):
        row, key, val = features(a[at : at + 128])
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[starts] + at] = np.add.reduceat(dense[place[key]] * val[:, None].astype(np.float32), starts)
    return out


def variants(word: str) -> list[str]:
    """The word with one letter put in at each inner place (the one before it again, and two others in turn), with two
    letters put in, and with one inner letter left out."""
    if word.endswith(OPEN):
        return [v + OPEN for v in variants(word[:-1])]
    if len(word) < 4 or len(word) > LONGEST - 2:
        return []
    letter = lambda i, k: chr(97 + (ord(word[i]) * 5 + 7 * i + 11 * k) % 26)  # noqa: E731  fixed, spread over the alphabet
    put = [word[:i] + c + word[i:] for i in range(1, len(word)) for c in (word[i - 1], letter(i, 0), letter(i, 1))]
    two = [word[:i] + letter(i, 2) + word[i : i + 2] + letter(i, 3) + word[i + 2 :] for i in range(1, len(word) - 2)]
    out = [word[:i] + word[i + 1 :] for i in range(1, len(word) - 1)] if len(word) > 4 else []
    return list(dict.fromkeys(put + two + out))


def _best_words(texts: DataFrame, machine: Machine, telling: frozenset[str]) -> DataFrame:
    """label, word, top of each text; worn: top of a toxic text in which every telling word is a variant of itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = Values(machine)
        for b in common.slices(batches):
            label = b.column(b.schema.get_field_index("label"))
            bags = values.bags(common.text_column(b).to_pylist())
            top, best = values.top(bags)
            worn: list[list[float] | None] = []
            for y, bag in zip(label.to_pylist(), bags, strict=True):
                if y != 1 or not any(_tells(w, telling) for w in bag):
                    worn.append(None)
                    continue
                other: Counter[str] = Counter()
                for w, n in bag.items():
                    new = variants(w) if _tells(w, telling) else []
                    for k in range(min(n, TOP)):
                        other[new[(zlib.crc32(w.encode()) + 7919 * len(bag) + k) % len(new)] if new else w] += 1
                worn.append(values.top([other])[0][0].tolist())
            yield pa.RecordBatch.from_arrays([label, pa.array(best, pa.string()), pa.array(top.tolist(), pa.list_(pa.float64())), pa.array(worn, pa.list_(pa.float64()))], names=["label", "word", "top", "worn"])

    return texts.mapInArrow(run, "label int, word string, top array<double>, worn array<double>")


def _logistic(value: np.ndarray, label: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the highest values, none below 0, and offset, by projected Newton steps."""
    x = np.hstack([value, np.ones((len(value), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (cost * (p - label)) + RIDGE * np.r_[w[:-1], 0]
        h = (x * (cost * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + RIDGE * np.eye(len(w))
        new = w - np.linalg.solve(h, g)
        new[:-1] = np.maximum(new[:-1], 0.0)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every text; keeps no other columns."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for b in common.slices(batches):
            p = scorer(common.text_column(b).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score below threshold."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for b in common.slices(batches):
            p = scorer(common.text_column(b).to_pylist())
            yield b.filter(pa.array(p < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label")).where("label in (0, 1)").where(~held_out())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, training_labels(spark, sf_dir))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns; the model learns from the stage's input."""
    model = fit(docs, training_labels(spark, sf_dir))
    return keep_clean(docs, model)
