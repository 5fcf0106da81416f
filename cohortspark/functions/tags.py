"""Structured names: key-value tags joined by underscores, as maps."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(name: Column) -> Column:
    """Tags of a name as a map.

    `key-value` tokens are tags. A token without a dash that comes before such a token becomes part of its key; those
    after the last one are the `suffix`.
    """
    start = F.struct(F.lit("").alias("held"), F.array().cast("array<struct<key: string, value: string>>").alias("tags"))
    joined = lambda a, b: F.when(a == "", b).otherwise(F.concat(a, F.lit("_"), b))

    def step(acc: Column, token: Column) -> Column:
        dash = F.instr(token, "-")
        tag = F.struct(joined(acc["held"], F.substring(token, F.lit(1), dash - 1)).alias("key"), F.substring(token, dash + 1, F.length(token)).alias("value"))
        grown = F.struct(F.lit("").alias("held"), F.concat(acc["tags"], F.array(tag)).alias("tags"))
        return F.when(dash > 0, grown).otherwise(F.struct(joined(acc["held"], token).alias("held"), acc["tags"].alias("tags")))

    def finish(acc: Column) -> Column:
        suffix = F.when(acc["held"] == "", F.array().cast("array<struct<key: string, value: string>>")).otherwise(F.array(F.struct(F.lit("suffix").alias("key"), acc["held"].alias("value"))))
        all_ = F.concat(acc["tags"], suffix)
        # the first of a repeated key counts
        first = F.filter(all_, lambda t, i: F.array_position(F.transform(all_, lambda x: x["key"]), t["key"]) == i + 1)
        return F.map_from_entries(first)

    return F.aggregate(F.split(name, "_"), start, step, finish)


def format_tags(tags: Column) -> Column:
    """The name of a map of tags in its order, the suffix last and without its key."""
    entries = F.filter(F.map_entries(tags), lambda t: (t["key"] != "suffix") & t["value"].isNotNull())
    parts = F.transform(entries, lambda t: F.concat(t["key"], F.lit("-"), t["value"]))
    return F.concat_ws("_", parts, F.try_element_at(tags, F.lit("suffix")))


def glob(pattern: str) -> str:
    """Regular expression of a shell pattern, for rlike."""
    return fnmatch.translate(pattern).replace(r"\Z", "$").replace(r"\z", "$")
