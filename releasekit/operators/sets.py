"""Joins and set operations (JOI-1..4, SET-1..4).  No value list ever leaves Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """JOI-1: rows whose key is in a derived key set (instead of collect + isin)."""
    return df.join(keys.select(*on), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """JOI-2: rows whose key is not in the key set."""
    return df.join(keys.select(*on), on, "left_anti")


def keys_with_several(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct non-null ``value`` (AGG-9 ``> 1``).

    ``min <> max`` is the same test as ``count(distinct) > 1`` but a plain hash aggregate:
    partial results are one row per key per task, so there is one exchange and no
    distinct expansion, and a hot key costs nothing extra."""
    per = df.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return per.where(F.col("__lo") != F.col("__hi")).select(key)


def keys_where(df: DataFrame, key: str, value: str, test) -> DataFrame:
    """AGG-9: keys whose distinct-value count passes ``test`` (a function of the count column)."""
    per = df.groupBy(key).agg(F.count_distinct(value).alias("__n"))
    return per.where(test(F.col("__n"))).select(key)


def flag_in(df: DataFrame, values: DataFrame, col: str, value_col: str, name: str = "in_list") -> DataFrame:
    """Membership flag of ``df[col]`` in a value-list DataFrame (left join on distinct values)."""
    marks = values.select(F.col(value_col).alias("__v")).distinct().withColumn(name, F.lit(True))
    out = df.join(marks, df[col] == marks["__v"], "left").drop("__v")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def lookup_required(df: DataFrame, lookup: DataFrame, key: str, value: str, explicit: Column | None = None,
                    missing: str = "missing") -> DataFrame:
    """JOI-3: dimension lookup; an explicit value wins, a key without a value is flagged
    (QLT-6 violation rows are ``where(missing)``)."""
    out = df.join(lookup, key, "left")
    if explicit is not None:
        out = out.withColumn(value, F.coalesce(explicit, F.col(value)))
    return out.withColumn(missing, F.col(value).isNull())


def _sides(tagged: DataFrame, key: str, name: str) -> DataFrame:
    # one hash aggregate with map-side partial results: a hot key is pre-reduced on every
    # task, and no sort-merge join is needed
    per = tagged.groupBy("__k").agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    side = (F.when(F.col("__l") & F.col("__r"), "both")
             .when(F.col("__l"), "left_only").otherwise("right_only"))
    return per.select(F.col("__k").alias(key), side.alias(name))


def overlap_sides(left: DataFrame, right: DataFrame, key: str, name: str = "side") -> DataFrame:
    """SET-1/2, JOI-2, CMP-4: distinct keys of both sides -> both / left_only / right_only.

    Written as a tagged union + one aggregation instead of a full outer join of two
    distinct sets: one exchange instead of three."""
    l = left.select(F.col(key).alias("__k"), F.lit(True).alias("__l"), F.lit(False).alias("__r"))
    r = right.select(F.col(key).alias("__k"), F.lit(False).alias("__l"), F.lit(True).alias("__r"))
    return _sides(l.unionByName(r).where("__k is not null"), key, name)


def overlap_sides_by(df: DataFrame, key: str, left: Column, right: Column, name: str = "side") -> DataFrame:
    """Both sides selected from ONE table by predicates: a single scan."""
    tagged = df.where(left | right).select(F.col(key).alias("__k"), F.coalesce(left, F.lit(False)).alias("__l"),
                                           F.coalesce(right, F.lit(False)).alias("__r"))
    return _sides(tagged.where("__k is not null"), key, name)


def side_counts(sides: DataFrame, name: str = "side") -> DataFrame:
    return sides.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def overlap_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of the intersection and both differences in one plan."""
    return side_counts(overlap_sides(left, right, key))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """SET-3: de-duplicate inside the plan (never collect first)."""
    return df.select(*cols).distinct()
