"""Data-quality rules as violation rows (QLT-1..7).

The reference raises on the first bad object; here every rule yields rows
``(rule, key, value)`` so one pass reports all violations, and ``fail`` gives the
strict behaviour."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import SLUG_PATTERN, read_as


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def violations(df: DataFrame, rule: str, bad: Column, key, value) -> DataFrame:
    """Rows of ``df`` where ``bad`` holds, as (rule, key, value) strings."""
    return df.where(F.coalesce(bad, F.lit(False))).select(
        F.lit(rule).alias("rule"), _c(key).cast("string").alias("key"), _c(value).cast("string").alias("value"))


def slug_violations(df: DataFrame, c: str, key=None, rule: str = "slug") -> DataFrame:
    """QLT-1: value must match the slug pattern (a null is also a violation)."""
    v = F.col(c)
    return violations(df, rule, v.isNull() | ~v.rlike(SLUG_PATTERN), key if key is not None else c, c)


def version_violations(df: DataFrame, c: str = "version", key=None, rule: str = "version") -> DataFrame:
    """QLT-2: a version starts with ``v``."""
    v = F.col(c)
    return violations(df, rule, v.isNull() | ~v.startswith("v"), key if key is not None else c, c)


def empty_url_violations(df: DataFrame, resources: str = "resources", key=None, rule: str = "empty_url") -> DataFrame:
    """QLT-4: every resource URL is non-empty."""
    bad = F.exists(F.map_values(F.col(resources)), lambda u: F.coalesce(u, F.lit("")) == "")
    return violations(df, rule, bad, key if key is not None else resources, F.to_json(F.col(resources)))


def format_violations(df: DataFrame, names: Column, key) -> DataFrame:
    """QLT-3: at least one format, and format names unique."""
    empty = violations(df, "no_formats", F.coalesce(F.size(names), F.lit(0)) <= 0, key, F.lit(None))
    dup = violations(df, "duplicate_format",
                     F.size(F.array_distinct(names)) != F.size(names), key, F.array_join(names, ","))
    return empty.unionByName(dup)


def coverage(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """QLT-5 / AGG-16: how many wanted ids are present in ``found``."""
    w = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    f = found.select(key).distinct().withColumn("__hit", F.lit(1))
    j = w.join(f, key, "left")
    return j.agg(F.count(F.lit(1)).alias("n_wanted"),
                 F.count("__hit").alias("n_found"),
                 F.count_if(F.col("__hit").isNull()).cast("bigint").alias("n_missing"))


def duplicate_keys(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """QLT-7: keys occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def release_violations(df: DataFrame, path_col: str, pattern: str | None = None,
                       rule: str = "missing_release") -> DataFrame:
    """SCL-6 strict side (D14): every dump file name must carry its release period; the
    violation row names the file."""
    from releasekit.functions.columns import release_from_path

    rel = release_from_path(path_col) if pattern is None else release_from_path(path_col, pattern)
    return violations(df, rule, rel.isNull(), path_col, path_col)


def path_collisions(reg_with_paths: DataFrame, path: str = "path", name: str = "n") -> DataFrame:
    """QLT-7 / D5: release paths have second precision while ``created`` has microseconds,
    so distinct keys can share a path.  Paths used by more than one entry."""
    return (reg_with_paths.groupBy(path).agg(F.count(F.lit(1)).alias(name),
                                             F.count_distinct("created").alias("n_keys"))
            .where(F.col(name) > 1))


def cast_fails(c, dt, source=None) -> Column:
    """Whether a value is there but is none of type ``dt``; ``source`` is the type it has (text if
    not given)."""
    return _c(c).isNotNull() & read_as(c, dt, source).isNull()


def cast_violations(df: DataFrame, schema: T.StructType, key, rule: str = "cast") -> DataFrame:
    """Values that would become null under the recorded ``schema``: one row each, ``column`` in
    the rule's name, from one pass."""
    bad = [F.when(cast_fails(f"`{f.name}`", f.dataType, df.schema[f.name].dataType), F.struct(F.lit(f"{rule}:{f.name}").alias("rule"), F.col(f"`{f.name}`").cast("string").alias("value")))
           for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if not bad:
        return df.limit(0).select(F.lit(rule).alias("rule"), _c(key).cast("string").alias("key"), F.lit("").alias("value"))
    found = df.select(_c(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*bad))).alias("x"))
    return found.select("x.rule", "key", "x.value")


def all_violations(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def fail(violation_rows: DataFrame) -> None:
    """Strict mode: raise on the first violation."""
    first = violation_rows.limit(1).collect()
    if first:
        r = first[0]
        raise ValueError(f"rule {r['rule']} violated by {r['key']!r}: {r['value']!r}")
