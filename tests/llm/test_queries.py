"""The registered queries on a small table: SQL twins, held-out accuracy, the pipeline stage by stage."""

import os
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402

from cohortspark import lineage  # noqa: E402
from cohortspark.llm import common, decontamination, mixing, near_dups, packing, queries, toxicity  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_oracle(spark, name):
    columns, rows = oracle.differences(spark, SMALL, queries.QUERIES[name], queries.ORACLES[name])
    assert not columns
    assert not rows


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op1_language_id"](spark, d).join(common.table(spark, d, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    # few labels at this size: the bound is loose
    tox = queries.QUERIES["op6_toxicity"](spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out").toPandas()
    assert (tox.predicted == tox.toxic).mean() > 0.9
    assert ((tox.score >= 0) & (tox.score <= 1)).all()


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "packing"]
    docs = common.table(spark, SMALL, "documents")
    columns = docs.columns
    model = toxicity.fit(docs, toxicity.training_labels(spark, SMALL))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score(before, model).where("predicted = 1").collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "near_dedup":
            found = near_dups.near_duplicates(before).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r.component_id for r in found})
            assert all(r.kept for r in near_dups.near_duplicates(docs).collect())
        elif name == "decontamination":
            assert decontamination.contaminated(docs, common.table(spark, SMALL, "benchmark")).count() == 0
            gone = decontamination.contaminated(before, common.table(spark, SMALL, "benchmark")).count()
            assert before.count() - docs.count() == gone
        else:
            taken = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
            words: dict[int, int] = {}
            for r in docs.collect():
                words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
            assert words == taken
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    encoder = packing.Encoder.get(packing.RANKS)
    total = sum(len(encoder.ids(r.text)) for r in docs.collect())
    assert sum(r.n_tokens for r in packed) == total
    ends = sum(int((np.frombuffer(r.input_ids, np.uint16)[: r.n_tokens] == encoder.end).sum()) for r in packed)
    assert ends == docs.count()


def test_clean_documents_stay(spark):
    """Nothing but toxic, copied or contaminated documents is filtered."""
    rng = np.random.default_rng(8)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert near_dups.pipeline_stage(spark, docs, SMALL).count() == 40
    assert decontamination.pipeline_stage(spark, docs, SMALL).count() == 40


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, item_ids int"


def fixture(spark, path):
    """Documents with nulls, repeated ids and rows, copies, benchmark passages and insults, with columns of clashing names."""
    rng = np.random.default_rng(21)
    vocabulary = ["".join(rng.choice(list("abcdefghklmnoprt"), rng.integers(3, 8))) for _ in range(300)]
    say = lambda k: " ".join(rng.choice(vocabulary, k))
    items = [say(30), say(12), None, "", "too short"]
    texts: list[str | None] = [say(int(rng.integers(20, 120))) for _ in range(60)]
    insults = ["idiot", "moron", "stupid"]
    toxic = [f"{say(10)} {rng.choice(insults)} {say(8)} {rng.choice(insults)} {rng.choice(insults)}" for _ in range(40)]
    copies = [texts[0], texts[0], texts[1] + " " + say(1), texts[2].upper()]
    leaks = [f"{say(5)} {items[0]} {say(5)}", f"{items[1]} {say(30)}"]
    texts = [*texts, *toxic, *copies, *leaks, None, "", " \n", "one", say(4000)]
    rows = [(i, t, "en", "abc"[i % 3] if i % 7 else None, None if t is None else len(t), 0.5, "x", 1) for i, t in enumerate(texts)]
    rows += [(None, *rows[5][1:]), (None, say(40), "en", "a", 1, 0.5, "x", 1), (3, say(40), "en", "b", 1, 0.5, "x", 1), rows[4], rows[4]]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(60 <= i < 100)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, items


def brute_leak(text, items):
    words = (text or "").lower().split()
    for item in items:
        it = (item or "").lower().split()
        width = min(20, len(it))
        if len(it) < 5:
            continue
        for shift in range(-len(it), len(words)):
            equal = [int(0 <= shift + k < len(words) and words[shift + k] == w) for k, w in enumerate(it)]
            if max(sum(equal[k : k + width]) for k in range(len(it) - width + 1)) >= -(-width * 6 // 10):
                return True
    return False


def brute_kept(rows):
    """One row of each group of 5-word shingle similarity of 0.8 or more: by doc_id, nulls last."""

    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        old = list(root)
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if old == root:
            break
    groups: dict[int, list] = {}
    for r, g in zip(rows, root, strict=True):
        groups.setdefault(g, []).append(r)
    return [sorted(r[0] for r in g if r[0] is not None)[0] if any(r[0] is not None for r in g) else None for g in groups.values()]


def test_pipeline_by_brute_force(spark, tmp_path):
    import corpus_pipeline

    rows, items = fixture(spark, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    d = str(tmp_path)
    order = lambda v: sorted(v, key=lambda x: (x is None, x))
    docs = common.table(spark, d, "documents")
    clean = common.written(stages["toxicity"](spark, docs, d), "t")
    kept = [tuple(r) for r in clean.collect()]
    bad = [r for r in rows if any(w in (r[1] or "") for w in ("idiot", "moron", "stupid"))]
    assert len(kept) == len(rows) - len(bad)
    assert not any(w in (r[1] or "") for r in kept for w in ("idiot", "moron", "stupid"))
    alone = common.written(stages["near_dedup"](spark, clean, d), "t")
    left = [tuple(r) for r in alone.collect()]
    assert order([r[0] for r in left]) == order(brute_kept(kept))
    pure = common.written(stages["decontamination"](spark, alone, d), "t")
    want = [r for r in left if not brute_leak(r[1], items)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in pure.collect())
    assert len(want) == len(left) - 2
    mixed = common.written(stages["mixing"](spark, pure, d), "t")
    assert mixed.columns == docs.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in mixing.mix(pure).collect())
    packed = stages["packing"](spark, mixed, d).collect()
    encoder = packing.Encoder.get(packing.RANKS)
    assert sum(r.n_tokens for r in packed) == sum(len(encoder.ids(r.text)) for r in mixed.collect())
    assert {x for r in packed for x in r.doc_ids} == {r.doc_id for r in mixed.collect()}
    assert corpus_pipeline.run(spark, d).count() > 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    fixture(spark, tmp_path)
    for name in ("documents", "labels", "benchmark"):
        for other in ("documents", "labels", "benchmark"):
            df = spark.read.parquet(f"{tmp_path}/{other}.parquet")
            (df.where("false") if other == name else df).coalesce(1).write.parquet(f"{tmp_path}/no-{name}/{other}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/no-documents").count() == 0
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert toxicity.pipeline_stage(spark, docs, f"{tmp_path}/no-labels").count() == docs.count()
    assert decontamination.pipeline_stage(spark, docs, f"{tmp_path}/no-benchmark").count() == docs.count()


def _tables(spark):
    """Names, without their numbers, of the tables in the shared folder."""
    folder = lineage.shared_dir(spark).removeprefix("file://")
    return {(n, n[:-33]) for n in os.listdir(folder)}


def test_stages_leave_what_their_results_read(spark):
    """Tables that a stage wrote on its way are gone once its verdicts are written; the result is still whole."""
    import corpus_pipeline

    stages, docs = dict(corpus_pipeline.STAGES), common.table(spark, SMALL, "documents")
    for name, left in (("near_dedup", ["keyed", "near-gone"]), ("decontamination", ["contaminated", "keyed"]), ("mixing", ["keyed", "mix-taken"])):
        before = _tables(spark)
        out = stages[name](spark, docs, SMALL)
        assert sorted(n for _, n in _tables(spark) - before) == left
        assert out.count() > 0
    before = _tables(spark)
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert [n for _, n in _tables(spark) - before] == ["stage-mixing"]


def test_settled_removes_only_its_own(spark):
    """Nested: the inner result lives as long as the outer one is being made; a failure leaves nothing to the next one."""
    kept = common.written(spark.range(3), "kept")

    def outer():
        inner = common.settled(lambda: common.written(spark.range(5), "deep").where("id > 0"), "inner")
        assert inner.count() == 4
        return inner.unionAll(kept)

    before = _tables(spark)
    out = common.settled(outer, "outer")
    assert (out.count(), kept.count()) == (7, 3)
    assert [n for _, n in _tables(spark) - before] == ["outer"]
    with pytest.raises(ZeroDivisionError):
        common.settled(lambda: 1 / 0, "fails")
    other = common.written(spark.range(2), "other")
    assert common.settled(lambda: other, "again").count() == other.count() == 2
