"""Exact top-k search against plain sorting."""

import random

from cohortspark.llm import exact_topk


def brute(rows, queries, k):
    out = []
    for q, x in queries:
        scored = sorted((-sum(int(256 * a // 1) * int(256 * b // 1) for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_tiles_and_ties(spark):
    rng = random.Random(1)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.25, 0.0]) for i in range(200, 230)]
    odd = [(500, None), (501, [1.0, None, 0.0, 0.0]), (550, [float("nan"), 0.0, 0.0, 0.0]), (551, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (600, [1.0, 2.0]), (700, []), rows[3]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    all_ = [(i, [float(v) for v in r.embedding]) for r in df.collect() for i in [r.vec_id] if i is not None and r.embedding is not None and all(v is not None and abs(v) < float("inf") for v in r.embedding)]
    all_ = [(i, list(x)) for i, x in dict.fromkeys((i, tuple(x)) for i, x in all_)]
    queries = [(i, x) for i, x in all_ if i % 50 == 0]
    want = brute(all_, queries, 5)
    for tile, shard in ((2048, 16384), (2, 16)):
        got = exact_topk.search(df, df.where("vec_id % 50 = 0"), 5, tile=tile, shard=shard).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def test_huge_values(spark):
    rows = [(0, [1e13, 1.0]), (1, [1e13, -1.0]), (2, [-1e13, 3.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in exact_topk.search(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()]
    assert got == [(1, 2**63 - 1), (3, 256 * 10**13 * 256 + 256 * 256)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.search(df, df).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert exact_topk.search(one, one).count() == 0


def test_clashing_columns(spark):
    """Further columns stay out of the way; an id with two vectors stands for both."""
    rows = [(0, [1.0, 0.0], 9, "a", 1.5, 2), (0, [0.0, 1.0], 9, "a", 1.5, 2), (1, [2.0, 0.0], 9, "a", 1.5, 2), (1, [2.0, 0.0], 8, "b", 1.5, 2), (2, [0.0, 3.0], 9, "a", 1.5, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, tile string, score double, dim int")
    got = exact_topk.search(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 3 * 65536), (0, 2, 1, 2 * 65536)]
