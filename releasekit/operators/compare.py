"""Schema and release comparison (CMP-1..5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import read_as
from releasekit.functions.schema import schema_rows
from releasekit.operators.quality import cast_fails
from releasekit.operators.sets import overlap_report, overlap_sides_by, side_counts


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """CMP-1 as rows (path, type).  A schema is metadata-sized, so it is built on the driver."""
    return spark.createDataFrame(schema_rows(df.schema), "path string, type string")


def schema_diff(spark: SparkSession, old: DataFrame, new: DataFrame) -> DataFrame:
    """CMP-2: added / removed / changed paths between two releases."""
    o = schema_frame(spark, old).withColumnRenamed("type", "old")
    n = schema_frame(spark, new).withColumnRenamed("type", "new")
    j = o.join(n, "path", "full")
    change = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
               .when(F.col("old") != F.col("new"), "changed"))
    return j.select("path", "old", "new", change.alias("change")).where(F.col("change").isNotNull())


def release_counts(df: DataFrame, release: str, name: str = "n") -> DataFrame:
    """CMP-3: rows per release with the delta to the previous release.

    The window runs in one task over the per-release counts: one row per release, which is
    thousands at most."""
    per = df.groupBy(release).agg(F.count(F.lit(1)).alias(name))
    w = Window.orderBy(release)
    return per.withColumn("delta", F.col(name) - F.lag(name).over(w))


def release_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """CMP-4: ids in both releases, only the old one, only the new one."""
    return overlap_report(old, new, key)


def release_keys_by(df: DataFrame, key: str, old, new) -> DataFrame:
    """CMP-4 when both releases are slices of one table: a single scan."""
    return side_counts(overlap_sides_by(df, key, old, new))


def union_releases(*frames: DataFrame, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """CMP-5: union of releases whose columns drifted, oldest first.

    Each column takes the type it has in the NEWEST release that carries it (drift goes
    toward the new schema, e.g. ``odds_ratio`` string -> double), unless ``types`` names
    one.  Older values are ``try_cast``: a non-numeric string like ``NR`` becomes null
    instead of failing the job under ANSI; no row is dropped, and ``n_bad`` counts the values
    of a row that were lost so.  Missing columns are null."""
    target: dict[str, T.DataType] = {}
    for f in frames:
        for fld in f.schema.fields:
            target[fld.name] = fld.dataType
    target.update(types or {})
    aligned = []
    for f in frames:
        cols, bad = [], F.lit(0)
        for name, dt in target.items():
            if name in f.columns:
                cols.append(read_as(f"`{name}`", dt, f.schema[name].dataType).alias(name))
                if f.schema[name].dataType != dt:
                    bad = bad + cast_fails(f"`{name}`", dt, f.schema[name].dataType).cast("int")
            else:
                cols.append(F.lit(None).cast(dt).alias(name))
        aligned.append(f.select(*cols, bad.alias("n_bad")))
    return reduce(lambda a, b: a.unionByName(b), aligned)


DIGESTS, ROWS, RANGE = "digests", "rows", "__range"


def _range_of(key: str, low: int, width: int):
    """Number of the key range that a whole-number key lies in; -1 for null."""
    return F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("bigint"), F.lit(-1).cast("bigint"))


def _digest(columns: list[str], when=None) -> list:
    """Number and sums of two hashes of rows: equal for equal bags of rows, whatever their order."""
    hashed = [F.xxhash64(F.lit(k), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in columns]).cast("decimal(20,0)") for k in (0, 1)]
    pick = lambda c: c if when is None else F.when(when, c)
    return [F.count(pick(F.lit(1))), *[F.coalesce(F.sum(pick(h)), F.lit(0).cast("decimal(30,0)")) for h in hashed]]


def key_ranges(df: DataFrame, key: str, ranges: int) -> tuple[int, int]:
    """``low, width`` that cut the keys of ``df`` into about ``ranges`` equal ranges."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return (0, 1) if low is None else (int(low), max(1, -(-(int(high) - int(low) + 1) // ranges)))


def write_digested(df: DataFrame, path: str, key: str, low: int, width: int) -> None:
    """A release whose rows lie by range of a whole-number ``key``, and beside them a digest of each
    range.  Releases that are to be compared are written with the same ``low`` and ``width``."""
    path, columns = path.rstrip("/"), sorted(df.columns)
    ranged = df.withColumn(RANGE, _range_of(key, low, width))
    ranged.hint("rebalance", F.col(RANGE)).write.mode("errorifexists").partitionBy(RANGE).parquet(f"{path}/{ROWS}")
    back = df.sparkSession.read.parquet(f"{path}/{ROWS}")
    digest = back.groupBy(F.col(RANGE).cast("bigint").alias("range")).agg(*[c.alias(n) for c, n in zip(_digest(columns), ("n", "h0", "h1"), strict=True)])
    digest.withColumn("low", F.lit(low).cast("bigint")).withColumn("width", F.lit(width).cast("bigint")).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{DIGESTS}")


def changed_ranges(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``range`` of the key ranges whose rows differ, from the digests alone."""
    sides = [spark.read.parquet(f"{p.rstrip('/')}/{DIGESTS}") for p in (old, new)]
    cuts = sides[0].select("low", "width").unionByName(sides[1].select("low", "width")).distinct().limit(2).collect()
    if len(cuts) > 1:
        raise ValueError(f"{old} and {new} are cut into different key ranges")
    tagged = reduce(lambda a, b: a.unionByName(b), [s.select("range", F.struct("n", "h0", "h1").alias("digest"), F.lit(k).alias("side")) for k, s in enumerate(sides)])
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("digest")))
    return tagged.groupBy("range").agg(side(0).alias("old"), side(1).alias("new")).where("NOT (old <=> new)").select("range")


def release_diff(spark: SparkSession, old: str, new: str, key: str) -> DataFrame:
    """CMP-3/4 by row: ``key, change`` (added, removed, changed) between two releases written by
    ``write_digested``.  Ranges with equal digests are not read: the numbers of the others (one per
    range, a parameter of the layout) prune the files.  Rows are compared as digests per key in
    one aggregation, so repeated keys compare as bags."""
    found = [r["range"] for r in changed_ranges(spark, old, new).collect()]
    sides = [spark.read.parquet(f"{p.rstrip('/')}/{ROWS}") for p in (old, new)]
    columns = sorted(c for c in sides[0].columns if c != RANGE)
    if columns != sorted(c for c in sides[1].columns if c != RANGE):
        raise ValueError("the releases have different columns: compare their schemas first")
    rows = reduce(lambda a, b: a.unionByName(b), [s.where(F.col(RANGE).isin(found)).select(*columns, F.lit(k).alias("__side")) for k, s in enumerate(sides)])
    both = [F.struct(*_digest(columns, F.col("__side") == k)).alias(name) for k, name in enumerate(("__old", "__new"))]
    per = rows.groupBy(key).agg(*both, F.count_if(F.col("__side") == 0).alias("__was"), F.count_if(F.col("__side") == 1).alias("__is"))
    change = F.when(F.col("__was") == 0, "added").when(F.col("__is") == 0, "removed").when(F.col("__old") != F.col("__new"), "changed")
    return per.select(key, change.alias("change")).where("change IS NOT NULL")
