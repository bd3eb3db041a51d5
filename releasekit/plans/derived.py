"""Shared derivations over the test tables, in Spark and as DuckDB CTE text.

* ``releases``  - the registry stand-in: one release per (priority slug, order month).
* ``releases2`` - plus a second collection of the 1997 versions one day later.
* ``evidence``  - one nested evidence record per order.
* ``edges``     - term hierarchy region > nation > customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releasekit.functions.columns import slugify, version_from_ts
from releasekit.operators import registry as R
from releasekit.plans.base import table

# Fixed values of the stand-in registry.
SOURCE = "orders"
STORAGE = "local"
SCHEME, BUCKET, ROOT = "file", "localhost", "catalog"
XREF_BASE = "https://db.example.org/"


def releases(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return (o.groupBy(slugify("o_orderpriority").alias("artifact"),
                      version_from_ts("o_orderdate", "month").alias("version"))
             .agg(F.max("o_orderdate").alias("created"), F.count(F.lit(1)).alias("nrow"))
             .select(F.lit(SOURCE).alias("source"), F.lit(STORAGE).alias("storage"),
                     "artifact", "version", "created", "nrow"))


def releases2(spark: SparkSession, sf: str) -> DataFrame:
    r = releases(spark, sf)
    again = (r.where(F.col("version").startswith("v1997-"))
              .withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY")))
    return r.unionByName(again)


def registry(spark: SparkSession, sf: str, rel: DataFrame | None = None, formats=None) -> DataFrame:
    """``releases`` as full registry entries (REG-1 defaults, REG-2 resources)."""
    rel = releases(spark, sf) if rel is None else rel
    meta = F.create_map(F.lit("nrow"), F.col("nrow").cast("string"))
    return R.build_entries(rel.withColumn("meta", meta), source="source", artifact="artifact",
                           version="version", created="created", storage="storage",
                           scheme=F.lit(SCHEME), bucket=F.lit(BUCKET), root=F.lit(ROOT), metadata="meta",
                           formats=formats)


def unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table with one row per ``key``; the query fails where a key repeats."""
    once = lambda c: F.when(F.count(F.lit(1)) == 1, F.first(c)).otherwise(F.raise_error(F.lit(f"{key} repeats"))).alias(c)
    return df.groupBy(key).agg(*[once(c) for c in df.columns if c != key])


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    # one target per evidence record: dimensions keyed uniquely (a repeated key fails), which
    # also lets Catalyst drop these joins from queries that never read a target field
    c = unique(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"), "c_custkey")
    n = unique(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    li = table(spark, sf, "lineitem")
    # codes are a set over a small vocabulary (flag x status), so the per-order state is bounded
    codes = li.groupBy(F.col("l_orderkey")).agg(
        F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))).alias("codes"))
    slug = slugify("o_orderpriority")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"], "left")
          .join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
          .join(codes, o["o_orderkey"] == codes["l_orderkey"], "left"))
    return j.select(
        F.col("o_orderkey").alias("orderkey"),
        F.struct(F.col("o_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"),
                 F.col("n_name").alias("nation")).alias("target"),
        F.struct(F.col("o_totalprice").alias("score"),
                 F.coalesce(F.col("codes"), F.array().cast("array<string>")).alias("codes"),
                 F.struct(slug.alias("id"),
                          F.concat(F.lit(XREF_BASE), slug, F.lit("/"), F.col("o_orderkey").cast("string")).alias("url"),
                          ).alias("ref")).alias("evidence"),
        F.col("o_orderstatus").alias("type"),
    )


def edges(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    c = table(spark, sf, "customer")
    return (n.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"),
                     F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"))
             .unionByName(c.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent"),
                                   F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("child"))))


# ---- the same derivations as DuckDB CTEs -------------------------------------------------

SQL_SLUG = "regexp_replace(regexp_replace(lower({c}), '[^0-9a-z]+', '_', 'g'), '_+$', '')"

SQL_RELEASES = f"""
releases AS (
  SELECT '{SOURCE}' AS source, '{STORAGE}' AS storage,
         {SQL_SLUG.format(c='o_orderpriority')} AS artifact,
         'v' || strftime(o_orderdate, '%Y-%m') AS version,
         max(o_orderdate) AS created, count(*) AS nrow
  FROM orders GROUP BY 3, 4)"""

SQL_RELEASES2 = SQL_RELEASES + """,
releases2 AS (
  SELECT * FROM releases
  UNION ALL
  SELECT source, storage, artifact, version, created + INTERVAL 1 DAY AS created, nrow
  FROM releases WHERE version LIKE 'v1997-%')"""

SQL_EDGES = """
edges AS (
  SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child FROM nation
  UNION ALL
  SELECT 'N' || c_nationkey, 'C' || c_custkey FROM customer)"""
