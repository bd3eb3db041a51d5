"""Filters (FLT-1..8).  Plain predicates, so Catalyst pushes them to the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nested_equals(df: DataFrame, prefix: str, field: str, value) -> DataFrame:
    """FLT-1: equality on ``prefix.field`` where the prefix is an argument."""
    return df.where(F.col(f"{prefix}.{field}") == F.lit(value))


def contains_literal(c, text: str) -> Column:
    """FLT-2: case-sensitive literal substring (not a regex, D9)."""
    return _c(c).contains(text)


def any_keyword(c, words: list[str]) -> Column:
    """FLT-3: case-insensitive literal any-of; a null value matches nothing."""
    low = F.lower(_c(c))
    return F.coalesce(reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in words]), F.lit(False))


def accept_rules(c, reject_words: list[str], accept_words: list[str], accept_values: list[str] | None = None,
                 value_flag: Column | None = None) -> Column:
    """FLT-4: ordered rules: reject on a reject word, accept on an accept word, accept
    when the value is in the list (value membership, D7), otherwise reject.  Words and
    values are compared in lower case on both sides.

    ``value_flag`` is the membership flag when the list is a DataFrame joined in by the
    caller (``sets.flag_in``, on lower-cased values); ``accept_values`` is a small literal list."""
    low = F.lower(_c(c))
    in_list = value_flag if value_flag is not None else (
        low.isin([v.lower() for v in accept_values]) if accept_values else F.lit(False))
    rule = F.when(_c(c).isNull(), F.lit(False))
    for w in reject_words:
        rule = rule.when(low.contains(w.lower()), F.lit(False))
    for w in accept_words:
        rule = rule.when(low.contains(w.lower()), F.lit(True))
    return rule.when(F.coalesce(in_list, F.lit(False)), F.lit(True)).otherwise(F.lit(False))


def classify_keywords(c, classes: list[tuple[str, str]]) -> Column:
    """FLT-5: first matching (class, keyword) wins; null when nothing matches."""
    low = F.lower(_c(c))
    expr = None
    for cls, word in classes:
        cond = low.contains(word.lower())
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr


def threshold_counts(df: DataFrame, group: list[str], score: str, cut: float) -> DataFrame:
    """FLT-6: rows per group before and after ``score >= cut``, in one pass."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(F.col(score) >= cut).cast("bigint").alias("n_after"),
    )


def point_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """FLT-7: equality lookup (a Parquet pushed filter / row-group skip)."""
    return df.where(F.col(column) == F.lit(value))
