"""The operators on texts against brute force, and on nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import decontamination, language_id, licenses, mixing, near_dups, packing, substrings, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seed long, words string, mask int, block int, key string, digest string"
WORDS = [f"w{i}" for i in range(400)]


def make(seed=1, n=60):
    """Texts with exact and near copies, shared passages, nulls, empty ones, odd spaces and one long text."""
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choices(WORDS, k=k))
    passage = say(60)
    texts = [None, "", " \t\n", "One", "one", "two  words\x0bhere", "É ÉÀ é", say(4), say(49), say(50)]
    base = say(120)
    texts += [base, base, base.upper()]
    for edits in (1, 1, 2, 3, 4, 8):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(99))
        texts.append(" ".join(w))
    texts += [f"{say(rng.randrange(0, 40))} {passage} {say(rng.randrange(0, 40))}" for _ in range(6)]
    texts += ["a " * 300, "a " * 200, "x" * 70000, (say(5000) + "\n" + say(5000)), say(12000)]
    while len(texts) < n:
        texts.append(say(rng.randrange(1, 90)))
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "ab"][min(i % 7, 3)], None if t is None else len(t), i, "x", 1, 2, "k", "d") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def split(t, lower=False):
    b = (t or "").encode()
    if lower:
        b = b.lower()
    return b.split()


def brute_substrings(rows):
    first = {}
    for i, t in sorted(rows):
        w = split(t)
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    out = {}
    for i, t in rows:
        w = split(t)
        gone = set()
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < i:
                gone |= set(range(j, j + 50))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings(spark, seed):
    rows = make(seed)
    got = substrings.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_substrings(rows)


def test_substring_factors(docs, rows):
    """Every factor is found word for word at its place of its source, and goes on as long as its windows' homes do."""
    got = {r.doc_id: r for r in substrings.deduplicate(docs).collect()}
    texts = dict(rows)
    want = brute_substrings(rows)
    homes = {}
    for i, t in sorted(rows):
        w = split(t)
        for j in range(len(w) - 49):
            homes.setdefault(tuple(w[j : j + 50]), (i, j))
    for i, r in got.items():
        words, end = split(texts[i]), 0
        covered = set()
        for s in r.spans:
            covered |= set(range(s.start, s.start + s.length))
        for f in r.factors:
            assert f.source < i
            assert f.length >= 50
            assert f.start >= end
            end = f.start + f.length
            assert set(range(f.start, end)) <= covered
            assert words[f.start : end] == split(texts[f.source])[f.position : f.position + f.length]
            assert homes[tuple(words[f.start : f.start + 50])] == (f.source, f.position)
            # the next window, if there is one, has another home
            after = tuple(words[end - 49 : end + 1])
            assert len(after) < 50 or homes[after] != (f.source, f.position + f.length - 49)
        # a duplicate window is in a factor or begins within one
        for j in range(len(words) - 49):
            if homes[tuple(words[j : j + 50])][0] < i:
                assert any(f.start <= j < f.start + f.length for f in r.factors)
        assert len(covered) == want[i][1]
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[i][2]


def test_substring_boundaries(spark):
    """A window over the end of a factor counts, whichever document it is from; the factor ends where its source ends."""
    w = [f"w{k}" for k in range(80)]
    rows_ = [(0, " ".join(w[:60])), (1, " ".join(w[10:])), (2, " ".join(w))]
    got = {r.doc_id: r for r in substrings.deduplicate(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert [tuple(f) for f in got[1].factors] == [(0, 50, 0, 10)]
    assert [tuple(f) for f in got[2].factors] == [(0, 60, 0, 0)]
    assert [tuple(s) for s in got[2].spans] == [(0, 80)]
    assert got[2].text == ""


def test_substrings_odd_ids(spark):
    t = " ".join(WORDS[:80])
    got = substrings.removals(spark.createDataFrame([(None, t), (5, t), (5, t), (7, t)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (5, 0), (5, 0), (7, 80)]


def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = split(t, True)
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, rows, percent):
    got = near_dups.near_duplicates(docs, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_blocks(docs, rows, monkeypatch):
    """Clusters over the size of a block are worked on in pairs of blocks, with the same result."""
    monkeypatch.setattr(near_dups, "BLOCK_DOCS", 3)
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 500)
    got = near_dups.near_duplicates(docs, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 85)


def test_near_duplicates_of_large_clusters(spark, monkeypatch):
    """Blocks of two: a large group of near copies, a chain and strangers that share passages, against brute force."""
    monkeypatch.setattr(near_dups, "BLOCK_DOCS", 2)
    rng = random.Random(14)
    base = [f"b{k}" for k in range(80)]
    texts = []
    for k in range(14):  # one family
        w = list(base)
        w[rng.randrange(80)] = f"x{k}"
        texts.append(" ".join(w))
    chain = [f"c{k}" for k in range(90)]
    for k in range(10):  # neighbours are alike, ends are not
        texts.append(" ".join(chain[2 * k : 2 * k + 70]))
    for k in range(6):  # half of the family's text
        texts.append(" ".join([*base[:60], *(f"s{k}x{j}" for j in range(20 - 2 * k))]))
    rng.shuffle(texts)
    rows_ = list(enumerate(texts))
    for percent in (80, 85):
        got = near_dups.near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string"), percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows_, percent)


def test_near_duplicates_odd(spark):
    t = " ".join(WORDS[:30])
    got = near_dups.near_duplicates(spark.createDataFrame([(None, t), (4, t), (4, t), (9, t), (2, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got if r.doc_id) == [(2, 2, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_jaccard_estimate():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 2**64, 3000, np.uint64)
    a, b = np.sort(u[:2000]), np.sort(u[300:2300])
    regs = near_dups.registers(np.r_[a, b], np.array([0, 2000, 4000]))
    chance = near_dups.collision(2000, 2000)
    assert abs(((regs[0] == regs[1]).mean() - chance) / (1 - chance) - 1700 / 2300) < 0.08
    assert 0 < chance < 0.01


def test_decontamination(spark, docs):
    rng = random.Random(5)
    item = rng.choices(WORDS, k=40)
    short = rng.choices(WORDS, k=7)
    changed = [*item]
    changed[6] = changed[19] = changed[33] = "replaced"
    noise = lambda: rng.choices(WORDS, k=50)
    cases = {1000: noise() + item + noise(), 1001: noise() + changed, 1002: noise() + item[:9] + noise(), 1003: short + noise(), 1004: [w.upper() for w in item], 1005: noise(), 1006: item[5:30] + noise()}
    found = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(i, " ".join(w)) for i, w in cases.items()], "doc_id long, text string"))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, None), (4, ""), (5, "w1 w2")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated(found, bench).collect()}
    assert got == {1000: [1], 1001: [1], 1003: [2], 1004: [1], 1006: [1]}
    assert decontamination.contaminated(found, bench.where("false")).count() == 0
    assert decontamination.contaminated(found.where("false"), bench).count() == 0


def test_decontamination_replaced_words(spark):
    """Against the rule by brute force: items of all lengths with any places replaced, at any place of the text."""
    rng = random.Random(11)
    items = {m: [f"i{m}x{k}" for k in range(m)] for m in [*range(5, 31), 45]}
    texts, want = [], set()
    for m, item in items.items():
        for keep in (0.4, 0.6, 0.6, 0.8):
            text = [w if rng.random() < keep else "other" for w in item]
            cut = rng.choice([0, 0, 1])  # some lack the first words
            equal = [int(a == b and k >= cut) for k, (a, b) in enumerate(zip(item, text, strict=True))]
            width = min(20, m)
            if max(sum(equal[k : k + width]) for k in range(m - width + 1)) >= -(-width * 6 // 10):
                want.add((len(texts), m))
            texts.append(" ".join([f"n{k}" for k in range(rng.randrange(3) * (not cut))] + text[cut:] + ["end"] * rng.randrange(3)))
    item = items[15]
    want.add((len(texts), 15))
    texts.append(" ".join("other" if k in (3, 7, 11) else w for k, w in enumerate(item, 1)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(m, " ".join(w)) for m, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.overlaps(docs, bench).collect()} == want


def test_decontamination_odd(spark):
    """Repeated rows and ids, null ids, very long texts and columns of clashing names."""
    item = [f"i{k}" for k in range(25)]
    rows_ = [(1, " ".join(item), 9, "x", 0)] * 3 + [(1, "clean words", 9, "x", 0), (None, " ".join(item), 9, "x", 0), (2, "n " * 150_000 + " ".join(item), 9, "x", 0), (3, None, 9, "x", 0), (4, "", 9, "x", 0)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, item_id int, words string, at int")
    bench = spark.createDataFrame([(7, " ".join(item), 1), (7, " ".join(item), 1), (None, "i0 i1 i2 i3 i4", 1)], "item_id long, text string, doc_id int")
    got = {r.doc_id: (r.n_items, r.item_ids) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {1: (1, [7]), 2: (1, [7])}


def test_decontamination_recall(spark):
    """Every overlap with up to 40 % of replaced words is found, none below the share; random replacements."""
    rng = random.Random(31)
    items = [[f"b{n}x{k}" for k in range(20)] for n in range(30)]
    texts, equal = [], []
    for item in items:
        for gone in (0, 2, 4, 6, 8, 9, 12):
            out = set(rng.sample(range(20), gone))
            texts.append(" ".join(["lead", *("other" if k in out else w for k, w in enumerate(item)), "tail"]))
            equal.append(20 - gone)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items)], "item_id long, text string")
    found = {r.doc_id for r in decontamination.contaminated(docs, bench).collect()}
    assert found == {i for i, n in enumerate(equal) if n >= 12}


def test_decontamination_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    text = " ".join(WORDS[:30])
    docs = spark.createDataFrame([(1, text), (None, text), (2, "w1")], "doc_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(docs, docs.select(F.lit(7).alias("item_id"), "text").limit(1)).collect()] == [1]


def test_token_counts(docs, rows):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, chunk_bytes=512, overlap_bytes=16).collect()}
    for i, t in rows:
        n = len(sp.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)
    assert got[max(got)].n_chunks >= 1
    assert max(r.n_chunks for r in got.values()) > 20


@pytest.mark.parametrize("text", ["▁a" * 400, "a▁ b" * 300, "  " * 900, "漢字" * 400 + " x" * 200, "é" * 999, "\x00 a" * 300, "<s> </s> " * 200, "​ ﻿a" * 200, "a\n" * 600 + "b c " * 99])
def test_odd_chunks(text):
    c = token_counts.Counter.get(token_counts.MODEL, 64, 8)
    assert c.long(text)[0] == len(c.sp.encode(text))


def test_packing(docs, rows):
    got = packing.pack(docs, capacity=256).collect()
    enc = packing.Encoder.get(packing.RANKS)
    parts = defaultdict(list)
    for r in got:
        ids, at = np.frombuffer(r.input_ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(ids) == len(at) == 256
        assert r.cu_seqlens[0] == 0
        assert r.cu_seqlens[-1] == r.n_tokens <= 256
        for i, o, s, e in zip(r.doc_ids, r.offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            parts[i].append((o, ids[s:e]))
            assert at[s:e].tolist() == list(range(e - s))
    for i, t in rows:
        if t:
            ids = np.concatenate([p for _, p in sorted(parts[i], key=lambda x: x[0])])
            assert ids[-1] == enc.end
            assert enc.of.decode(ids[:-1].tolist()) == t
    assert set(parts) == {i for i, t in rows if t}


def test_packing_positions(spark):
    """Position ids go on beyond 65,535 where rows are that long."""
    docs = spark.createDataFrame([(1, "a b " * 50000, "x"), (None, None, "y"), (1, "c", "z"), (2, "", "z")], "doc_id long, text string, row string").coalesce(1)
    (row,) = packing.pack(docs, capacity=200_000).collect()
    at = np.frombuffer(row.position_ids, np.int32)
    assert len(at) == 200_000
    assert row.doc_ids == [1, 1]
    for s, e in zip(row.cu_seqlens[:-1], row.cu_seqlens[1:], strict=True):
        assert at[s:e].tolist() == list(range(e - s))
    assert row.cu_seqlens[1] > 65_536
    assert packing.position_type(65_536) is np.uint16


def test_best_fit():
    rng = random.Random(3)
    packer, plain = packing.Packer(100), []
    pieces = [(i, 0, np.zeros(rng.randint(1, 100), np.uint16)) for i in range(300)]
    packer.put(pieces)
    for size in sorted((len(p[2]) for p in pieces), reverse=True):  # the textbook way
        fits = [b for b in plain if b >= size]
        if fits:
            plain.remove(min(fits))
            plain.append(min(fits) - size)
        else:
            plain.append(100 - size)
    rows_ = list(packer.close(0))
    assert sorted(100 - sum(len(p[2]) for p in r) for r in rows_) == sorted(plain)


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in mixing.mix(docs.repartition(5)).collect())
    size = {i: len(split(t)) for i, t in rows}
    by = defaultdict(list)
    for r, s in ((r, s) for r in got for s in [["a", "b", None, "ab"][min(r.doc_id % 7, 3)]]):
        assert r["size"] == size[r.doc_id]
        assert 0 <= r.taken <= 3 * r["size"]
        by[s].append(r)
    total = sum(size.values())
    weights = {"a": 5, "ab": 2, "b": 1, None: 5}
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    want = brute_targets(sizes, weights, total)
    for s, rs in by.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert abs(rs[0].target - want[s]) < 1e-6 * total
        assert abs(sum(r.taken for r in rs) - want[s]) <= max(0.02 * want[s], 3)


def brute_targets(sizes, weights, total):
    capped = {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in capped and sizes[s]}
        left = total - sum(capped.values())
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mixed_documents(docs, rows):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    words, texts = defaultdict(int), dict(rows)
    for r in got.collect():
        words[r.doc_id] += len(split(r.text))
        assert r.n_chars == len(r.text)
        assert set(split(r.text)) <= set(split(texts[r.doc_id]))
    assert {i: n for i, n in taken.items() if n} == dict(words)


def test_stages_by_row(spark, tmp_path):
    """Rows with no doc_id, or the same one, are deduplicated, filtered and mixed each by itself."""
    rng = random.Random(4)
    texts = [" ".join(f"r{k}x{rng.randrange(10**6)}" for _ in range(10 + 130 * k)) for k in range(12)]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t, "ab"[k % 2], len(t)) for k, t in enumerate(texts)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    docs = frame(rows)
    mixed: dict[int, int] = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        words = r.text.split()
        k = int(words[0][1:].partition("x")[0])
        assert set(words) <= set(texts[k].split())
        assert (r.doc_id, r.source) == (rows[k][0], rows[k][2])
        mixed[k] += len(words)
    report = sorted((r["size"], r.taken) for r in mixing.mix(docs).collect())
    assert report == sorted((10 + 130 * k, mixed[k]) for k in range(12))
    twice = frame(rows + rows[:4])
    assert sorted(r.text for r in near_dups.pipeline_stage(spark, twice, "").collect()) == sorted(texts)
    spark.createDataFrame([(1, texts[0]), (2, texts[4])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = decontamination.pipeline_stage(spark, twice, str(tmp_path)).collect()
    assert {r.text for r in kept} == {*texts} - {texts[0], texts[4]}


def test_permutation():
    for n in (1, 2, 3, 5, 16, 17, 1000):
        got = mixing.permuted(np.arange(n), n, 99)
        assert sorted(got.tolist()) == list(range(n))
    assert (mixing.permuted(np.arange(1000), 1000, 1) != mixing.permuted(np.arange(1000), 1000, 2)).mean() > 0.9
    counts = np.array([mixing.shard_counts(n, k, 16) for k, n in enumerate([700, 20, 0, 280])])
    assert counts.sum(1).tolist() == [700, 20, 0, 280]
    assert (counts.sum(0) > 30).all()
    assert (mixing.shard_counts(700, 0, 16) == counts[0]).all()


def brute_taken(places, table):
    """Words taken of each row: places in its source counted word by word, blocks drawn slot by slot."""
    times = defaultdict(int)
    for t in table:
        for slot in range(t.slots):
            turn, k = divmod(slot, t.blocks)
            times[t.sid, int(mixing.permuted(np.array([k]), t.blocks, mixing.SEED + 1_000_003 * t.sid + 7919 * turn)[0])] += 1
    return {p._row: sum(times[p.sid, at // p.length] for at in range(p.start, p.start + p["size"])) for p in places}


def test_mix_by_words(docs):
    """Documents tile their sources without gaps; what is taken follows from the blocks; shards hold what was drawn."""
    keyed = docs.withColumn("_row", F.col("seed").cast("long"))
    places, table = mixing.placed(keyed)
    places, table = places.collect(), table.collect()
    for t in table:
        at = 0
        for p in sorted((p for p in places if p.sid == t.sid and p["size"]), key=lambda p: p.start):
            assert p.start == at
            at += p["size"]
        assert at == t.source_size
        assert t.blocks == -(-t.source_size // t.length)
    taken = brute_taken(places, table)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == taken
    drawn = mixing.mixed_blocks(docs).collect()
    for t in table:
        own = [r for r in drawn if r.source == t.source]
        counts = mixing.shard_counts(t.slots, t.sid, mixing.SHARDS)
        assert [sum(r.shard == k for r in own) for k in range(mixing.SHARDS)] == counts.tolist()
        assert sorted(r.slot for r in own) == list(range(t.slots))
    assert sum(len(split(r.text)) for r in drawn) == sum(taken.values())
    assert all(len(split(r.text)) <= mixing.BLOCK for r in drawn)


def test_mixing_odd(spark, monkeypatch):
    """One doc_id for everything, clashing names, and sources that are not broadcast."""
    names = "doc_id long, text string, source string, n_chars long, sid long, size string, start int, _part int, name string"
    rows_ = [(7, "a b c d e f", "s", 11, 1, "x", 2, 3, "n")] * 500 + [(None, "g h", None, 3, 1, "x", 2, 3, "n")] * 40 + [(7, None, "t", None, 1, "x", 2, 3, "n")]
    docs = spark.createDataFrame(rows_, names)
    want = sorted(tuple(r) for r in mixing.mix(docs).fillna(-1).collect())
    assert len(want) == 541
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert sum(len(split(r.text)) for r in got.collect()) == sum(r[4] for r in want)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(tuple(r) for r in mixing.mix(docs).fillna(-1).collect()) == want


def test_many_sources(spark):
    """As many sources as documents: targets are those of the rule."""
    n = 100_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), "id").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 4).cast("int")).alias("text"))
    got = mixing.mix(docs).select("doc_id", "size", "target", "taken").toPandas().sort_values("doc_id", key=lambda c: c.astype(str))
    size = (got.doc_id % 4).to_numpy()
    assert (got["size"].to_numpy() == size).all()
    weight = np.array([5.0, 2.0, 1.0])[np.arange(n) % 3]
    share, full = 0.0, np.zeros(n, bool)
    while True:  # shares among those that are not full
        share = (size.sum() - 3.0 * size[full].sum()) / weight[~full & (size > 0)].sum()
        now = share * weight > 3 * size
        if (now == full).all():
            break
        full = now
    assert np.allclose(got.target, np.where(size > 0, np.minimum(share * weight, 3 * size), 0))
    assert (got.taken <= 3 * got["size"]).all()
    assert (abs(got.taken - got.target) <= 0.5 + 1e-9).all()  # sources this small have blocks of one word


def test_licenses(spark):
    mit = "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + licenses.KNOWN["MIT"].replace("sublicense", "SubLicence").replace(" ", "\n")
    cases = [(1, mit), (2, None), (3, ""), (4, "x " + licenses.KNOWN["MIT"]), (5, licenses.KNOWN["Zlib"].upper()), (None, "é"), (6, mit), (6, mit), (7, "word " * 200_000)]
    found = spark.createDataFrame([(*c, "MIT", "d") for c in cases], "doc_id long, text string, license string, digest string")
    got = licenses.scan(found, licenses.known_licenses(spark)).collect()
    assert len(got) == len(cases)
    assert {r.doc_id: r.license for r in got} == {1: "MIT", 2: None, 3: None, 4: None, 5: "Zlib", None: None, 6: "MIT", 7: None}
    assert licenses.scan(found.where("false"), licenses.known_licenses(spark)).count() == 0
    assert {r.license for r in licenses.scan(found, licenses.known_licenses(spark).where("false")).collect()} == {None}


def test_known_licenses(spark):
    """Every known text is found with its headings, bullets, another owner's notice, other case, marks and spellings."""
    assert len({*licenses.KNOWN, *(k for k, _ in licenses.KNOWN_DIGESTS)}) >= 30
    texts = [(k, t) for k in licenses.KNOWN for t in licenses.forms(k)]
    owner = "Copyright (C) 1999-2024 The Example Authors <a@example.org>. All rights reserved.\n"
    worn = [(k, (owner + t.upper().replace(",", " ;").replace("LICENSE ", "LICENCE ").replace("COPYRIGHT HOLDER", "COPYRIGHT OWNER"))) for k, t in texts]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts + worn)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    for i, (k, t) in enumerate(texts + worn):
        assert got[i].license == k
        assert got[i].digest == hashlib.sha256(licenses.canonical_text(t).encode()).hexdigest()
    assert len({licenses.canonical_text(licenses.KNOWN[k]) for k in licenses.KNOWN}) == len(licenses.KNOWN)


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0", "CC0-1.0"])
def test_long_licenses(spark, name):
    folder = Path("/usr/share/common-licenses")
    if not (folder / name).exists():
        pytest.skip("the system has no licence texts")
    text = (folder / name).read_text()
    docs = spark.createDataFrame([(1, text), (2, text.lower().replace("\n", " \n\n")), (3, text + " and more")], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    assert got[1] == got[2]
    assert got[1].startswith(name.split("-")[0])
    assert got[3] is None


def test_languages(spark):
    rng = random.Random(2)
    vocabulary = {"en": ["the", "of", "and", "thing", "with"], "de": ["der", "und", "schaft", "über", "ein"], "fr": ["les", "une", "eau", "être", "ment"]}
    rows_ = [(i, " ".join(rng.choices(vocabulary[k], k=rng.randrange(2, 60))), k) for i, k in enumerate(["en", "de", "fr"] * 40)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    model = language_id.fit(docs.where("doc_id < 60"))
    test = docs.where("doc_id >= 60").unionAll(spark.createDataFrame([(1000, None, None), (1001, "12 !?", None), (1002, "", None), (None, "the of", None)], docs.schema))
    got = {r.doc_id: r for r in language_id.identify(test, model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows_ if i >= 60) >= 58
    assert {(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)} == {("und", 0.0)}
    assert got[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.fit(docs.where("false")) is None
    assert {r.lang_pred for r in language_id.identify(test, None).collect()} == {"und"}
    one = language_id.fit(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in language_id.identify(docs, one).collect()} == {"de"}
    code = language_id.codebook(9)
    assert min((code[i] != code[j]).sum() for i in range(9) for j in range(i)) > 10
    assert language_id.codebook(4).shape == (4, 7)


def test_language_copies(spark):
    """Copies of a row are one example, and fill no other row's place."""
    texts = {"en": "the thing of and with", "de": "der und schaft über ein"}
    rows_ = [(7, texts["en"], "en", 1.0, 0)] * 2000 + [(8, texts["de"] + " ä" * i, "de", 1.0, 0) for i in range(5)] + [(None, texts["de"], "de", 1.0, 0)] * 30 + [(9, None, "en", 1.0, 0), (9, "x" * 300_000, None, 1.0, 0)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, score double, digest int").repartition(5)
    model = language_id.fit(docs, sample=12)
    got = language_id.identify(docs, model).collect()
    assert len(got) == len(rows_)
    assert all(r.lang_pred == "en" for r in got if r.doc_id == 7)
    assert all(r.lang_pred == "de" for r in got if r.doc_id in (8, None))
    assert {r.lang_pred for r in got if r.doc_id == 9} <= {"und", "en", "de"}
    assert language_id.identify(docs.where("false"), model).count() == 0
    assert language_id.fit(docs.where("lang = 'none'")) is None
    many = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("a"), "id", F.lit(" ")), 9).alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    assert len(language_id.fit(many, sample=10).langs) == 40


def test_toxicity(spark):
    rng = random.Random(4)
    clean = ["thea", "oner", "handat", "ingre", "tion", "wherer", "onthe", "reas", "edly", "shing"]
    bad = ["idiot", "moron", "stupid"]
    rows_, labels = [], []
    for i in range(240):
        w = rng.choices(clean, k=rng.randrange(5, 60))
        if i % 4 == 0:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows_.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, label int")
    model = toxicity.fit(docs.where("doc_id < 160"), lab.where("doc_id < 160"))
    extra = [(1000, "thea oner idiiot and mor-on"), (1001, None), (1002, ""), (1003, "42 !"), (1004, "x" * 5000), (1005, "oner s t u p i d thea i.d.i.o.t")]
    got = {r.doc_id: r for r in toxicity.score(docs.unionAll(spark.createDataFrame(extra, docs.schema)), model).collect()}
    assert all(got[i].predicted == y for i, y in labels if i >= 160)
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005)] == [1, 0, 0, 0, 0, 1]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == 180
    assert toxicity.fit(docs, lab.where("label = 0")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_toxicity_of_whole_runs():
    """What lies inside a long run of letters counts, and letters across digits and underscores are a word."""
    weight = np.zeros(toxicity.CODES**3)
    _, key, val = toxicity.features(["idiot"])
    np.add.at(weight, key, val)
    # the same without the exact norms where it tells nothing
    some = ["idixot", "riot", "banana", "idiot"]
    low = toxicity.evaluate(some, weight, -1.0, -0.5)
    assert np.allclose(low, np.maximum(toxicity.evaluate(some, weight, -1.0), -0.5))
    run = "thereisnosuchthingasanidiotlikeyouaremyfriend"
    one, clean = toxicity.evaluate([run, run.replace("idiot", "")], weight)
    assert one > 0.6 > 2 * clean
    assert toxicity.evaluate(["idiot"], weight)[0] > 0.9
    for n in (25, 29, 30, 36, 37, 100):
        w = "".join(chr(97 + k % 26) for k in range(n))
        for size, _ in toxicity.WINDOWS:
            own = [x for x in toxicity.windows(w) if len(x) == size]
            assert w.startswith(own[0])
            assert w.endswith(own[-1])
    assert {"idiot", "idi", "ot"} <= toxicity.words("You idi_ot").keys()
    assert "idiot" in toxicity.words("an id1iot")


def brute_kernel(a, b):
    """Sum over equal triples of places within SPAN, by DECAY for each place in between; by both norms."""

    def triples(w):
        w = "^" + w + "$" if not w.endswith(toxicity.OPEN) else "^" + w[:-1]
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    yield w[i] + w[j] + w[k], toxicity.DECAY ** (k - i - 2)

    def dot(x, y):
        return sum(u * v for s, u in triples(x) for t, v in triples(y) if s == t)

    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel():
    """The folded weights give what the kernel with all landmarks gives, summed by their coefficients."""
    marks, coef = ["idiot", "moron", "banana", "aaaa", "éclair", "achlich" + toxicity.OPEN], [1.5, -0.5, 0.25, 1.0, 2.0, 1.0]
    row, key, val = toxicity.features(marks)
    weight = np.bincount(key, val * np.array(coef)[row], toxicity.CODES**3)
    ws = ["idiot", "idixot", "xidiot", "mor", "a", "bananas", "aaaaaa", "éclairs", "eclair", "achlichkeit"]
    want = [[brute_kernel(w, m) for m in marks] for w in ws]
    assert np.allclose(toxicity.gram(ws, marks), want, atol=1e-6)
    assert np.allclose(toxicity.evaluate(ws, weight), np.array(want) @ coef, atol=1e-6)


def test_variants():
    got = toxicity.variants("idiot")
    assert {"iidiot", "idiiot", "idot", "idit"} <= set(got)
    assert all(len(v) in (4, 6, 7) and v[0] == "i" and v[-1] == "t" for v in got)
    assert toxicity.variants("abc") == []
    assert all(v.endswith(toxicity.OPEN) for v in toxicity.variants("stupid" + toxicity.OPEN))


def test_words_of_texts():
    assert toxicity.words("trash of the trash, TRASH!")["trash"] == 3
    assert "idiot" not in toxicity.words("an idi ot")
    assert toxicity.words("an idi ot", toxicity.ends(["idiot"]))["idiot"] == 1
    assert "stupid" in toxicity.words("so s-t.u p*i d")


def test_toxicity_odd_labels(spark):
    """Contradicting labels count for nothing, repeated rows are scored each, further columns stay out of the way."""
    rng = random.Random(6)
    clean = ["thea", "oner", "handat", "ingre", "tion", "wherer", "onthe"]
    rows_ = [(i, " ".join(rng.choices(clean, k=20) + ["idiot", "moron"] * (i % 3 == 0)), 0.5, 7, 1) for i in range(90)]
    rows_ += [(0, rows_[0][1], 0.5, 7, 1)] * 3 + [(None, "moron idiot", 0.5, 7, 1), (91, "moron " * 30000, 0.5, 7, 1), (92, None, 0.5, 7, 1)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, score double, predicted int, label int")
    labels = [(i, int(i % 3 == 0)) for i in range(90)] + [(i, int(i % 3 != 0)) for i in range(0, 90, 9)] + [(1, 0), (None, 1), (500, 1)]
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows_)
    assert all(r.predicted == int(r.doc_id is None or r.doc_id == 91 or (r.doc_id < 90 and r.doc_id % 3 == 0)) for r in got)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == 61
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.keep_clean(docs.where("false"), model).count() == 0
    same = spark.createDataFrame([(i, "thea oner") for i in range(30)], "doc_id long, text string")
    assert toxicity.fit(same, spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, label int")) is None


def test_empty_tables(empty):
    assert substrings.removals(empty).count() == 0
    assert near_dups.near_duplicates(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
    assert packing.pack(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
