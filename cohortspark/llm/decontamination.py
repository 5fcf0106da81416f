"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Tokens are the words of a text in lower case. A seed looks at the tokens of a window under a fixed mask and
ignores the others, so a hit survives replaced words at the ignored places. The hashes of every window of the
benchmark items are joined with those of every window of the documents. For each alignment (document, item, shift)
with a hit, the words of the item are then compared with the document's words at that shift, place by place. An
overlap is verified if, in a stretch of SPAN places (or in the whole of a shorter item), at least SHARE of them are
equal. Items under MIN_TOKENS words are too short to tell anything and are not looked for.

SEEDS are lossless for that rule: wherever SHARE of SPAN places (or of a whole shorter item) are equal, in whatever
pattern, a mask that is used for that length has a hit. Most lengths need two masks; the others are hashed only if
the benchmark has items so short. A larger span or lower share than the defaults has no such guarantee.

The benchmark's windows are counted first: up to BROADCAST_ROWS of them are sent to all tasks, beyond that the join
is a shuffle whose large keys Spark can split. Hits are combined map-side to alignments.

Defined results: null or short texts are clean; null items and empty benchmarks contaminate nothing; rows that
repeat a doc_id count as one document in the report, and a null doc_id is in none; the filter judges each row by
itself, whatever its doc_id; further columns are ignored by the report and kept by the filter; empty tables give empty reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Masks and the lengths of stretches (SPAN, or all of a shorter item) that need them.
SEEDS = {"111": range(5, 21), "1011": (5, *range(7, 21)), "1101": (5, 6, 8, 10), "11001": (5, 10), "10011": (5,), "10101": (5,), "100011": (6,)}
MIN_TOKENS = 5
SPAN, SHARE = 20, 0.6
BROADCAST_ROWS = 1_000_000


def tokens(text: Column) -> Column:
    """Words of the lower-cased text; no text gives one empty word."""
    return F.split(F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+")


def _seed(mask: str, number: int) -> Column:
    """The mask's number and the hash of the tokens that it looks at from place `at`; null past the end."""
    looked = ", ".join(f"get(words, at + {i})" for i, c in enumerate(mask) if c == "1")
    salt = len(mask) * 100_000 + int(mask, 2)
    return F.expr(f"if(at + {len(mask)} <= n, named_struct('seed', xxhash64({salt}, {looked}), 'mask', {number}), null)")


def _seeds(df: DataFrame, masks: list[str], keep: list[str]) -> DataFrame:
    """keep, `at`, `seed` and `mask` for each place of df.words and each mask."""
    least = min(map(len, masks))
    df = df.withColumn("n", F.size("words"))  # no filter on n: it would be pushed down and split the text once more
    df = df.withColumn("at", F.explode(F.expr(f"if(n >= {least}, sequence(0, n - {least}), array())")))
    df = df.select(*keep, "at", F.explode(F.array(*(_seed(m, k) for k, m in enumerate(masks)))).alias("s")).where("s is not null")
    return df.select(*keep, "at", "s.seed", "s.mask")


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, words and m (their number) of the items that are looked for."""
    items = benchmark.where("item_id is not null").select("item_id", tokens(F.col("text")).alias("words")).withColumn("m", F.size("words"))
    return items.where(F.col("m") >= MIN_TOKENS)


def alignments(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id, item_id, m (words of the item), shift of all alignments with a hit; and whether the items are few."""
    length = F.least(F.col("m"), F.lit(SPAN))
    lengths = {r.m for r in items.select(length.alias("m")).distinct().collect()}  # at most SPAN rows
    masks = [x for x, of in SEEDS.items() if lengths & set(of)] or list(SEEDS)[:1]
    wanted = _seeds(items, masks, ["item_id", "m"]).withColumnRenamed("at", "item_at")
    used = [(F.col("mask") == k) & length.isin(*SEEDS[x]) for k, x in enumerate(masks)]
    wanted = common.written(wanted.where(reduce(Column.__or__, used)), "seeds")
    few = wanted.count() <= BROADCAST_ROWS
    wanted = F.broadcast(wanted) if few else wanted.hint("shuffle_merge")
    found = _seeds(docs.where("doc_id is not null").select("doc_id", tokens(F.col("text")).alias("words")), masks, ["doc_id"])
    hits = found.join(wanted, ["seed", "mask"]).select("doc_id", "item_id", "m", (F.col("at") - F.col("item_at")).alias("shift"))
    return hits.distinct(), few


def overlaps(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, matched: the most equal places in a verified stretch of each pair."""
    items = _items(benchmark)
    found, few = alignments(docs, items)
    found = common.written(found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "m", "shift")).alias("found")), "alignments")
    here = docs.select("doc_id", "text").join(common.shuffled(found), "doc_id").select("doc_id", tokens(F.col("text")).alias("words"), "found")
    here = here.select("doc_id", "words", F.explode("found").alias("a"))
    # the document's words from the first place of the item that it has; slice, as it takes no copy of all words
    here = here.selectExpr("doc_id", "a.item_id", "a.m", "greatest(-a.shift, 0) as lead", "slice(words, greatest(a.shift, 0) + 1, a.m - greatest(-a.shift, 0)) as here")
    items = F.broadcast(items) if few else items.hint("shuffle_merge")
    found = here.join(items, ["item_id", "m"]).withColumn("width", F.expr(f"least({span}, m)"))
    agree = F.expr("filter(sequence(0, m - 1), i -> get(here, i - lead) = get(words, i))")
    found = found.select("doc_id", "item_id", "m", "width", F.ceil(F.col("width") * share).alias("least"), agree.alias("agree"))
    best = F.expr("if(size(agree) < `least`, 0, array_max(transform(agree, p -> size(filter(agree, q -> q >= least(p, m - width) and q < least(p, m - width) + width)))))")
    found = found.withColumn("matched", best).where(F.col("matched") >= F.col("least"))
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, share: float = SHARE) -> DataFrame:
    """doc_id, n_items, item_ids: documents with a verified overlap."""
    found = overlaps(docs, benchmark, span, share)
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("item_ids"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a verified overlap with a benchmark item, with all their columns; each row is judged by itself."""
    docs = common.keyed(docs)
    judged, benchmark = docs.select(F.col("_row").alias("doc_id"), "text"), common.table(spark, sf_dir, "benchmark")
    gone = common.settled(lambda: contaminated(judged, benchmark).select(F.col("doc_id").alias("_row")), "contaminated")
    return docs.join(common.shuffled(gone), "_row", "left_anti").drop("_row")
