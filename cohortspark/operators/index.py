"""The phenotype index: tags of phenotypes as rows (phenotype, key, value), and the jobs made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import tags as T


def build(names: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """phenotype, key, value of names (phenotype, name); `extra` maps tag keys to further columns of names.

    The first value of a (phenotype, key) counts: parsed tags before extra ones.
    """
    parsed = names.select("phenotype", F.explode(T.parse(F.col("name"))).alias("key", "value"), F.lit(0).alias("turn"))
    for k, c in (extra or {}).items():
        parsed = parsed.unionByName(names.select("phenotype", F.lit(k).alias("key"), F.col(c).cast("string").alias("value"), F.lit(1).alias("turn")))
    return parsed.where("value is not null").groupBy("phenotype", "key").agg(F.min_by("value", "turn").alias("value"))


def query(tag: DataFrame, **conditions: str | list[str] | None) -> DataFrame:
    """phenotypes that meet all conditions: a value or shell pattern, a list of values, or None for lacking the key."""
    found = tag.select("phenotype").distinct()
    for key, want in conditions.items():
        own = tag.where(F.col("key") == key)
        if want is None:
            found = found.join(own, "phenotype", "left_anti")
            continue
        if isinstance(want, str):
            own = own.where((F.col("value") == want) | F.col("value").rlike(T.glob(want)))
        else:
            own = own.where(F.col("value").isin(list(want)))
        found = found.join(own, "phenotype", "left_semi")
    return found


def update(tag: DataFrame, other: DataFrame) -> DataFrame:
    """Union of two indexes; phenotypes that tag has keep their tags."""
    return tag.unionByName(other.join(tag.select("phenotype").distinct(), "phenotype", "left_anti"))


def remove(tag: DataFrame, **conditions: str | list[str] | None) -> DataFrame:
    return tag.join(query(tag, **conditions), "phenotype", "left_anti")


def replace_key(tag: DataFrame, old: str, new: str) -> DataFrame:
    return tag.withColumn("key", F.when(F.col("key") == old, new).otherwise(F.col("key")))


def drop_key(tag: DataFrame, key: str) -> DataFrame:
    return tag.where(F.col("key") != key)


def replace_value(tag: DataFrame, key: str, old: str, new: str) -> DataFrame:
    return tag.withColumn("value", F.when((F.col("key") == key) & (F.col("value") == old), new).otherwise(F.col("value")))


def rewrite(tag: DataFrame, removals: list[dict], keys: list[tuple[str, str]], drops: list[str], values: list[tuple[str, str, str]]) -> DataFrame:
    """Rewrites in their fixed order: removals, key replacements, dropped keys, value replacements."""
    for r in removals:
        tag = remove(tag, **r)
    for old, new in keys:
        tag = replace_key(tag, old, new)
    for k in drops:
        tag = drop_key(tag, k)
    for k, old, new in values:
        tag = replace_value(tag, k, old, new)
    return tag


def alternative(tag: DataFrame, key: str, value: str, other: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """phenotype, key, value rows by which phenotypes with `value` also answer for `other`.

    One that has a twin with `other`, equal in all further tags but the ignored ones, does not.
    """
    rest = F.sort_array(F.collect_list(F.when(~F.col("key").isin(key, *ignore), F.struct("key", "value"))))
    own = F.max(F.when(F.col("key") == key, F.col("value")))
    per = tag.groupBy("phenotype").agg(rest.alias("rest"), own.alias("own"))
    twins = per.where(F.col("own") == other).select("rest")
    return per.where(F.col("own") == value).join(twins, "rest", "left_anti").select("phenotype", F.lit(key).alias("key"), F.lit(other).alias("value"))


def groups(tag: DataFrame, keys: list[str], alternatives: DataFrame | None = None, minimum: int = 5) -> DataFrame:
    """One row for each distinct tuple of the keys' values (NULL where lacking), and its sorted members.

    Members by way of an alternative count; groups with fewer than minimum members are left out.
    """
    rows = tag if alternatives is None else tag.unionByName(alternatives)
    out = rows.select("phenotype").distinct()
    for k in keys:
        out = out.join(rows.where(F.col("key") == k).select("phenotype", F.col("value").alias(k)), "phenotype", "left")
    return out.groupBy(*keys).agg(F.sort_array(F.collect_set("phenotype")).alias("members")).where(F.size("members") >= minimum)


def member_sets(grouped: DataFrame, keys: list[str], alternatives: DataFrame | None = None) -> DataFrame:
    """One row for each distinct member set: the tuple that uses the fewest alternatives, ties by the tuple."""
    uses = F.lit(0)
    if alternatives is not None:
        swapped = {(r.key, r.value) for r in alternatives.select("key", "value").distinct().collect()}
        for k, v in sorted(swapped):
            if k in keys:
                uses = uses + (F.coalesce(F.col(k) == v, F.lit(False))).cast("int")
    order = F.struct(uses.alias("uses"), *keys)
    return grouped.groupBy("members").agg(F.min(order).alias("best"), F.count("*").alias("tuples")).select(*(F.col(f"best.{k}").alias(k) for k in keys), "members", "tuples")


def duplicate_studies(grouped: DataFrame, tag: DataFrame, keys: list[str], study_key: str = "ds") -> DataFrame:
    """Groups in which a study has more than one phenotype: keys, study, n."""
    study = tag.where(F.col("key") == study_key).select("phenotype", F.col("value").alias("study"))
    flat = grouped.select(*keys, F.explode("members").alias("phenotype")).join(study, "phenotype")
    return flat.groupBy(*keys, "study").agg(F.count("*").alias("n")).where("n > 1")


def value_report(tag: DataFrame, study_key: str = "ds") -> DataFrame:
    """key, value, phenotypes, studies: how often each tag value occurs."""
    study = tag.where(F.col("key") == study_key).select("phenotype", F.col("value").alias("study"))
    return tag.join(study, "phenotype", "left").groupBy("key", "value").agg(F.countDistinct("phenotype").alias("phenotypes"), F.countDistinct("study").alias("studies"))
