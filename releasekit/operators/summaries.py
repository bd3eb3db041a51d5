"""Aggregations, sorts and limits (AGG-1..16, SRT-1..5).

All are hash aggregates with map-side partial aggregation, so a key holding a third
of the rows is pre-reduced on every task before the shuffle.  Set-valued results are
built with ``collect_set`` on bounded vocabularies only (terms, flags, sources)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count(df: DataFrame, name: str = "nrow") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, *keys, name: str = "n") -> DataFrame:
    """AGG-2/3/4: count per (nested) key or expression; the null group is kept (D8)."""
    return df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def multi_path_counts(df: DataFrame, paths: list[str], name: str = "n") -> DataFrame:
    """Several single-key group counts from ONE scan: each row is exploded into
    (path, value) pairs and one aggregation counts them all."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(p).alias("path"), F.col(p).cast("string").alias("value")) for p in paths
    ]))
    return df.select(pairs.alias("pv")).groupBy("pv.path", "pv.value").agg(F.count(F.lit(1)).alias(name))


def min_max(df: DataFrame, c: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    return df.agg(F.min(c).alias(lo), F.max(c).alias(hi))


def array_frequency(df: DataFrame, array_col: str, name: str = "value", count_name: str = "n") -> DataFrame:
    """AGG-6: frequency of array elements; null and empty arrays contribute nothing."""
    return (df.select(F.explode(_c(array_col)).alias(name))
              .groupBy(name).agg(F.count(F.lit(1)).alias(count_name)))


def distinct_per_group(df: DataFrame, key: str, value: str, name: str = "n", drop_null_keys: bool = True,
                       approx: float | None = None) -> DataFrame:
    """AGG-7: distinct values per key (pandas ``nunique``: null keys and values ignored).

    Exact by default.  ``approx=<relative error>`` opts into HyperLogLog++ sketches, which
    merge map-side, so per-key state stays fixed-size however many values a hot key has."""
    src = df.where(F.col(key).isNotNull()) if drop_null_keys else df
    agg = F.approx_count_distinct(value, approx) if approx else F.count_distinct(value)
    return src.groupBy(key).agg(agg.alias(name))


def count_of_counts(per_group: DataFrame, count_col: str = "n", name: str = "n_keys") -> DataFrame:
    """AGG-8: distribution of a per-group count."""
    return per_group.groupBy(count_col).agg(F.count(F.lit(1)).alias(name))


def sorted_concat(df: DataFrame, keys: list[str], value: str, sep: str = ",", name: str = "terms",
                  max_values: int = 100_000) -> DataFrame:
    """AGG-10: sorted distinct values joined to one string per group.  For vocabularies: a group
    with more than ``max_values`` distinct values is an error (``sorted_values`` has no bound)."""
    values = F.collect_set(F.col(value).cast("string"))
    few = F.when(F.size("__v") <= max_values, F.col("__v")).otherwise(
        F.raise_error(F.lit(f"more than {max_values} distinct values of {value} in a group")).cast("array<string>"))
    per = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(values.alias("__v"))
    return per.select(*keys, F.array_join(F.array_sort(few), sep).alias(name))


def sorted_values(df: DataFrame, keys: list[str], value: str, name: str = "position") -> DataFrame:
    """AGG-10 without a bound: one row per distinct value of a group, with its 1-based position in the
    group's order.  A range sort numbers all rows, and the least number of a group is taken off,
    so no group is gathered, however large."""
    from releasekit.operators.registry import with_position

    rows = with_position(df.where(F.col(value).isNotNull()).select(*keys, value).distinct(), [*keys, value], "__at").checkpoint()
    start = rows.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).agg(F.min("__at").alias("__start"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)])
    return rows.join(start, same).select(*keys, (F.col("__at") - F.col("__start") + 1).alias(name), value)


def set_fingerprints(df: DataFrame, keys: list[str], value: str, name: str = "fingerprint", seed: int = 0) -> DataFrame:
    """AGG-11: an order-free signature of the distinct values of each group: their number and the sums
    of two 64-bit hashes.  Sums are partial on every task, so a group's state has a fixed size;
    the signature of a union of disjoint sets is the sum of theirs."""
    v = F.col(value).cast("string")
    rows = df.where(F.col(value).isNotNull()).select(*keys, v.alias("__v")).distinct()
    total = lambda k: F.sum(F.xxhash64(F.lit(2 * seed + k), "__v").cast("decimal(20,0)"))
    return rows.groupBy(*keys).agg(F.struct(F.count(F.lit(1)).alias("n"), total(0).alias("h0"), total(1).alias("h1")).alias(name))


def _false_equals(df: DataFrame, a: str, b: str, value: str, marks: DataFrame) -> DataFrame:
    """Values of ``a`` with two different sets of one fingerprint: equal sets hold each value as often
    as there are sets."""
    rows = df.where(F.col(value).isNotNull()).select(F.col(a).alias("__a"), F.col(b).alias("__b"), F.col(value).cast("string").alias("__v")).distinct()
    marked = rows.join(marks, F.col("__a").eqNullSafe(F.col(a)) & F.col("__b").eqNullSafe(F.col(b)))
    held = marked.groupBy("__a", "fingerprint", "__v").agg(F.count(F.lit(1)).alias("n"))
    per = held.groupBy("__a", "fingerprint").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("values"))
    return per.where("least <> most OR values <> fingerprint.n")


def dependency_check(df: DataFrame, a: str, b: str, value: str, exact: bool = True) -> DataFrame:
    """AGG-11: does the value set of (a, b) depend on a only?  Fingerprint per (a, b), distinct
    fingerprints per a, then their distribution.  One bucket ``1 -> #a`` proves it.  No set is
    gathered.  ``exact`` compares sets of one fingerprint value by value in a second pass, and
    takes other hashes if two of them differ."""
    for seed in range(4):
        marks = set_fingerprints(df, [a, b], value, seed=seed).checkpoint()
        if not exact or _false_equals(df, a, b, value, marks).isEmpty():
            break
    else:
        raise ValueError(f"sets of {value} with equal fingerprints under four pairs of hashes")
    per_a = marks.groupBy(a).agg(F.count_distinct("fingerprint").alias("n_signatures"))
    return per_a.groupBy("n_signatures").agg(F.count(F.lit(1)).alias("n_keys"))


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """AGG-12: frequencies with nulls dropped (pandas ``value_counts``)."""
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(name))


def share_of_total(counts: DataFrame, count_col: str = "n", name: str = "pct", digits: int = 2) -> DataFrame:
    """AGG-13: percentage of the grand total.  The total is a scalar subquery (one value
    broadcast to the tasks), not a cross join."""
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(name, F.round(F.col(count_col) * 100.0 / total, digits))


def non_null_rate(df: DataFrame, c: str, digits: int = 2) -> DataFrame:
    return df.agg(F.count(c).alias("n"), F.round(F.count(c) * 100.0 / F.count(F.lit(1)), digits).alias("pct"))


def column_profile(df: DataFrame) -> DataFrame:
    """AGG-14: (column, type, non_null, nrow) from one wide aggregation + unpivot."""
    wide = df.agg(F.count(F.lit(1)).alias("__nrow"),
                  *[F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(df.columns)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"nn{i}").alias("non_null"))
        for i, c in enumerate(df.columns)
    ]))
    return wide.select(rows.alias("r"), F.col("__nrow").alias("nrow")).select("r.*", "nrow")


def distinct_combinations(df: DataFrame, keys: list[str], cols: list[str], name: str = "n",
                          approx: float | None = None) -> DataFrame:
    """AGG-15: distinct (c1, c2, ...) tuples per key; exact unless ``approx`` (relative
    error) opts into a sketch.  Tuples with a null member are not counted in either mode."""
    if approx:
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        complete = F.when(~any_null, F.struct(*cols))
        return df.groupBy(*keys).agg(F.approx_count_distinct(complete, approx).alias(name))
    return df.groupBy(*keys).agg(F.count_distinct(*cols).alias(name))


def top_k(counts: DataFrame, count_col: str, key: str, k: int) -> DataFrame:
    """SRT-1/2: by count desc, key asc as tie-break; ``TakeOrderedAndProject`` keeps only
    k rows per task, so nothing big is sorted."""
    return counts.orderBy(F.desc(count_col), F.asc_nulls_last(key)).limit(k)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """SRT-5: deterministic first rows."""
    return df.orderBy(*order).limit(n)


def rows_as_json(df: DataFrame, key: str, name: str = "json") -> DataFrame:
    """PRJ-6: each row rendered as JSON text."""
    return df.select(F.col(key), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(name))
