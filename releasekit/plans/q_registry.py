"""Registry, quality-rule, comparison and ontology queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from releasekit.functions import columns as C
from releasekit.functions.schema import to_flat
from releasekit.operators import compare as CMP
from releasekit.operators import ontology as ON
from releasekit.operators import quality as Q
from releasekit.operators import registry as R
from releasekit.operators.release_registry import ReleaseRegistry
from releasekit.plans import derived as D
from releasekit.plans.base import query, table
from releasekit.session import scratch_path

REL = D.SQL_RELEASES
REL2 = D.SQL_RELEASES2
KEYS = "source, storage, artifact, version, created"


def _keys(df):
    return df.select(*R.KEY)


# ---------------------------------------------------------------- registry (REG, SRT-3/4, SNK-6)


@query("reg_build_entries", f"""
WITH {REL}
SELECT {KEYS}, nrow, 'parquet' AS format, 'directory' AS format_type,
       '{D.SCHEME}' AS scheme, '{D.BUCKET}' AS bucket, '{D.ROOT}' AS root
FROM releases
""")
def reg_build_entries(spark, sf):
    reg = D.registry(spark, sf)
    fmt = R.default_format()
    return reg.select(*R.KEY, F.col("metadata")["nrow"].cast("bigint").alias("nrow"),
                      fmt["name"].alias("format"), fmt["type"].alias("format_type"), "scheme", "bucket", "root")


@query("reg_resource_path", f"""
WITH {REL}, p AS (
  SELECT {KEYS}, source || '/' || artifact || '/' || version || '/' || strftime(created, '%Y%m%dT%H%M%S') || '/data.parquet' AS path
  FROM releases)
SELECT {KEYS}, path, '{D.SCHEME}://{D.BUCKET}/{D.ROOT}/' || path AS url FROM p
""")
def reg_resource_path(spark, sf):
    return R.with_paths(D.registry(spark, sf)).select(*R.KEY, "path", "url")


def _format_flags(version_col: str = "version"):
    """Three formats whose default flags vary with the month of the version."""
    m = F.substring(F.col(version_col), 7, 2).cast("int") % 4
    f = lambda a, b, c: F.array(
        R.format_struct(F.lit("parquet"), F.lit("directory"), F.lit(a)),
        R.format_struct(F.lit("csv"), F.lit("file"), F.lit(b)),
        R.format_struct(F.lit("json"), F.lit("file"), F.lit(c)))
    return (F.when(m == 0, f(False, False, False)).when(m == 1, f(False, True, True))
             .when(m == 2, f(False, False, True)).otherwise(f(True, False, True)))


@query("reg_default_format", f"""
WITH {REL}
SELECT {KEYS}, CASE CAST(substr(version, 7, 2) AS INTEGER) % 4 WHEN 1 THEN 'csv' WHEN 2 THEN 'json' ELSE 'parquet' END AS format
FROM releases
""")
def reg_default_format(spark, sf):
    reg = D.registry(spark, sf, formats=_format_flags())
    return reg.select(*R.KEY, R.default_format()["name"].alias("format"))


@query("reg_find_version", f"""
WITH {REL}
SELECT row_number() OVER (ORDER BY version DESC, created DESC) AS ordinal, version, created
FROM releases WHERE source = 'orders' AND artifact = '1_urgent'
""")
def reg_find_version(spark, sf):
    found = R.find(D.registry(spark, sf), "orders", "1_urgent", None)
    return R.with_position(found, [F.desc("version"), F.desc("created")], "ordinal").select("ordinal", "version", "created")


@query("reg_latest_per_key", f"""
WITH {REL},
r AS (SELECT 'release' AS kind, source || '/' || artifact AS key, version, created,
             row_number() OVER (PARTITION BY source, artifact ORDER BY version DESC, created DESC) AS rn FROM releases),
c AS (SELECT 'customer' AS kind, CAST(o_custkey AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS version,
             o_orderdate AS created,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT kind, key, version, created FROM r WHERE rn = 1
UNION ALL
SELECT kind, key, version, created FROM c WHERE rn = 1
""")
def reg_latest_per_key(spark, sf):
    rel = R.latest_per_key(D.releases(spark, sf), ["source", "artifact"], ["version", "created"])
    rel = rel.select(F.lit("release").alias("kind"), F.concat_ws("/", "source", "artifact").alias("key"),
                     "version", "created")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    cust = R.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    cust = cust.select(F.lit("customer").alias("kind"), F.col("o_custkey").cast("string").alias("key"),
                       F.col("o_orderkey").cast("string").alias("version"), F.col("o_orderdate").alias("created"))
    return rel.unionByName(cust)


@query("reg_latest_version_all", f"""
WITH {REL}, r AS (
  SELECT * FROM releases
  UNION ALL SELECT source, storage, artifact, version, created + INTERVAL 1 DAY, nrow FROM releases WHERE version >= 'v2001')
SELECT {KEYS} FROM (SELECT *, rank() OVER (PARTITION BY source, artifact ORDER BY version DESC) AS rk FROM r) WHERE rk = 1
""")
def reg_latest_version_all(spark, sf):
    """REG-7: the newest versions have two collections each, and both stay.  The registry is
    stored once; the lookup reads it twice."""
    rel = D.releases(spark, sf)
    again = rel.where(F.col("version") >= "v2001").withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY"))
    path = scratch_path(spark, "latest")
    _keys(rel.unionByName(again)).write.parquet(path)
    return R.latest_version_all(spark.read.parquet(path), ["source", "artifact"], "version")


@query("reg_insert_strict", f"""
WITH {REL}
SELECT {KEYS}, nrow FROM releases
UNION ALL
SELECT source, storage, artifact, 'v2002-' || substr(version, 7) AS version, created + INTERVAL 1 YEAR AS created, nrow
FROM releases WHERE version LIKE 'v2001-%'
""")
def reg_insert_strict(spark, sf):
    base = D.releases(spark, sf)
    new = (base.where(F.col("version").startswith("v2001-"))
               .withColumn("version", F.concat(F.lit("v2002-"), F.substring("version", 7, 2)))
               .withColumn("created", F.col("created") + F.expr("INTERVAL 1 YEAR")))
    return R.insert_strict(base, new).select(*R.KEY, "nrow")


@query("reg_validate_insert", f"""
WITH {REL}
SELECT artifact, version, created,
       CASE CAST(substr(version, 7, 2) AS INTEGER) % 5
            WHEN 0 THEN 'artifact is no slug' WHEN 1 THEN 'version does not begin with v'
            WHEN 2 THEN 'repeated format' WHEN 3 THEN 'no format' END AS fault
FROM releases
""")
def reg_validate_insert(spark, sf):
    """The rules an entry must meet before it is registered: accepted rows have no fault, the
    others the first one.  Faults are planted by the month of the version."""
    rel = D.releases(spark, sf)
    m = F.substring("version", 7, 2).cast("int") % 5
    fmt = lambda *names: F.array(*[R.format_struct(F.lit(n), F.lit("directory"), F.lit(False)) for n in names])
    none = F.filter(fmt("parquet"), lambda x: F.lit(False))
    dirty = rel.withColumns({
        "bad_artifact": F.when(m == 0, F.concat("artifact", F.lit(" !"))).otherwise(F.col("artifact")),
        "bad_version": F.when(m == 1, F.substring("version", 2, 100)).otherwise(F.col("version")),
        "formats": F.when(m == 2, fmt("parquet", "parquet")).when(m == 3, none).otherwise(fmt("parquet", "csv"))})
    url = F.create_map(F.lit("parquet"), F.lit("file:///x"))
    entries = R.build_entries(dirty, source="source", storage="storage", artifact="bad_artifact", version="bad_version",
                              created="created", formats="formats", resources=url, source_name="artifact", artifact_name="version")
    return R.entry_faults(entries).select(F.col("source_name").alias("artifact"), F.col("artifact_name").alias("version"), "created", "fault")


UPSERT_USER = 7


@query("reg_upsert", f"""
WITH upd AS (SELECT event_id, ts, user_id, 'updated' AS event_type, value + 1 AS value, props
             FROM events WHERE user_id = {UPSERT_USER})
SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.event_id = e.event_id)
UNION ALL SELECT * FROM upd
""")
def reg_upsert(spark, sf):
    e = table(spark, sf, "events")
    upd = (e.where(F.col("user_id") == UPSERT_USER)
            .withColumn("event_type", F.lit("updated")).withColumn("value", F.col("value") + 1))
    return R.upsert(e, upd, ["event_id"])


@query("reg_remove", f"""
WITH {REL}
SELECT {KEYS} FROM releases r
WHERE NOT EXISTS (SELECT 1 FROM releases g WHERE g.version = 'v1999-06' AND g.source = r.source AND g.storage = r.storage
                  AND g.artifact = r.artifact AND g.version = r.version AND g.created = r.created)
""")
def reg_remove(spark, sf):
    base = D.releases(spark, sf)
    gone = base.where(F.col("version") == "v1999-06")
    return _keys(R.remove(base, gone))


@query("reg_exists", f"""
WITH {REL},
cand AS (SELECT source, storage, artifact, version,
                CASE WHEN CAST(substr(version, 7, 2) AS INTEGER) % 2 = 1 THEN created + INTERVAL 1 SECOND ELSE created END AS created
         FROM releases)
SELECT c.*, EXISTS (SELECT 1 FROM releases r WHERE r.source = c.source AND r.storage = c.storage AND r.artifact = c.artifact
                    AND r.version = c.version AND r.created = c.created) AS present
FROM cand c
""")
def reg_exists(spark, sf):
    base = D.releases(spark, sf)
    odd = F.substring("version", 7, 2).cast("int") % 2 == 1
    cand = _keys(base).withColumn("created", F.when(odd, F.col("created") + F.expr("INTERVAL 1 SECOND"))
                                  .otherwise(F.col("created")))
    return R.exists_flag(cand, base)


@query("reg_dedupe_last", "SELECT text, max(doc_id) AS doc_id FROM documents GROUP BY text")
def reg_dedupe_last(spark, sf):
    d = table(spark, sf, "documents").select("text", "doc_id")
    return R.dedupe_last(d, ["text"], "doc_id")


@query("reg_merge", """
WITH u AS (
  SELECT event_id FROM events WHERE day(ts) < 15
  UNION ALL SELECT event_id FROM events WHERE day(ts) >= 10 AND day(ts) < 20
  UNION ALL SELECT event_id FROM events WHERE day(ts) >= 18)
SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_keys FROM u
""")
def reg_merge(spark, sf):
    e = table(spark, sf, "events")
    d = F.dayofmonth("ts")
    m = R.merge(e.where(d < 15), e.where((d >= 10) & (d < 20)), e.where(d >= 18))
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_keys"))


@query("reg_sorted", f"""
WITH {REL2}
SELECT row_number() OVER (ORDER BY {KEYS}) AS position, {KEYS} FROM releases2
""")
def reg_sorted(spark, sf):
    return R.with_position(_keys(D.releases2(spark, sf)), R.KEY)


@query("reg_flat_table", f"""
WITH {REL}
SELECT {KEYS}, '{D.SCHEME}' AS scheme, '{D.BUCKET}' AS bucket, '{D.ROOT}' AS root,
       CAST(nrow AS VARCHAR) AS metadata_nrow,
       '{D.SCHEME}://{D.BUCKET}/{D.ROOT}/' || source || '/' || artifact || '/' || version || '/'
         || strftime(created, '%Y%m%dT%H%M%S') || '/data.parquet' AS resources_parquet
FROM releases
""")
def reg_flat_table(spark, sf):
    """REG-13: the registry as a flat table (structs and maps to columns, all-null columns
    such as the unnamed ``source_name`` dropped).  ``formats`` stays an array."""
    return to_flat(D.registry(spark, sf)).drop("formats")


@query("reg_roundtrip", f"""
WITH {REL}
SELECT {KEYS}, nrow FROM releases
""")
def reg_roundtrip(spark, sf):
    """SNK-6: save, remove all entries, save that empty registry (it must load as empty), insert
    all again, save and load."""
    root = scratch_path(spark, "registry")
    full = D.registry(spark, sf)
    R.save_registry(full, root)
    stored = R.load_registry(spark, root)
    R.save_registry(R.remove(stored, stored), root)
    R.save_registry(R.insert_strict(R.load_registry(spark, root), full), root)
    back = R.load_registry(spark, root)
    return back.select(*R.KEY, F.col("metadata")["nrow"].cast("bigint").alias("nrow"))


@query("reg_concurrent_commits", f"""
WITH {REL}
SELECT {KEYS}, CASE WHEN version < 'v1996' THEN nrow + 1 ELSE nrow END AS nrow FROM releases WHERE NOT (version >= 'v1996' AND version < 'v1997' AND artifact = '5_low')
""")
def reg_concurrent_commits(spark, sf):
    """SNK-6, REG-8/9, D16: two writers load the same version.  One inserts the releases of 1996 and
    saves; the other replaces the entries of earlier years and inserts those of later ones, and
    saves on top of it; a third, begun before both, removes some of 1996 once they are there."""
    root = scratch_path(spark, "commits")
    full = D.registry(spark, sf)
    old, year, later = full.where("version < 'v1996'"), full.where("version >= 'v1996' AND version < 'v1997'"), full.where("version >= 'v1997'")
    R.save_registry(old, root)
    first, second, third = (ReleaseRegistry(spark, root) for _ in range(3))
    first = first.add(year)
    counted = F.map_from_entries(F.transform(F.map_entries("metadata"), lambda e: F.struct(e["key"], (e["value"].cast("bigint") + 1).cast("string"))))
    second = second.add(old.withColumn("metadata", counted), overwrite=True).add(later)
    third = third.remove(year.where("artifact = '5_low'"))
    for writer in (first, second, third):
        writer.save()
    return R.load_registry(spark, root).select(*R.KEY, F.col("metadata")["nrow"].cast("bigint").alias("nrow"))


# ---------------------------------------------------------------- quality rules (QLT)


@query("qlt_rules", f"""
WITH {REL}
SELECT 'slug' AS rule, CAST(c_custkey AS VARCHAR) AS key, c_name AS value FROM customer
WHERE c_name IS NULL OR NOT regexp_full_match(c_name, '[A-Za-z0-9_]+')
UNION ALL
SELECT 'slug', o_orderpriority, o_orderpriority FROM (SELECT DISTINCT o_orderpriority FROM orders)
WHERE o_orderpriority IS NULL OR NOT regexp_full_match(o_orderpriority, '[A-Za-z0-9_]+')
UNION ALL
SELECT 'version', v, v FROM (
  SELECT DISTINCT CASE WHEN month(o_orderdate) % 2 = 0 THEN 'v' ELSE '' END || strftime(o_orderdate, '%Y-%m') AS v FROM orders)
WHERE v IS NULL OR NOT starts_with(v, 'v')
UNION ALL
SELECT 'url_tail', CAST(page_id AS VARCHAR), url FROM pages WHERE string_split(url, '/')[-1] = ''
""")
def qlt_rules(spark, sf):
    cust = Q.slug_violations(table(spark, sf, "customer"), "c_name", key="c_custkey")
    prio = Q.slug_violations(table(spark, sf, "orders").select("o_orderpriority").distinct(), "o_orderpriority")
    o = table(spark, sf, "orders")
    dirty = F.concat(F.when(F.month("o_orderdate") % 2 == 0, F.lit("v")).otherwise(F.lit("")),
                     F.date_format("o_orderdate", "yyyy-MM"))
    vers = Q.version_violations(o.select(dirty.alias("v")).distinct(), "v")
    urls = Q.empty_url_violations(D.registry(spark, sf), key=F.concat_ws("/", "artifact", "version"))
    pages = table(spark, sf, "pages")
    tails = Q.violations(pages, "url_tail", C.url_tail("url") == "", "page_id", "url")
    return Q.all_violations(cust, prio, vers, urls, tails)


@query("qlt_formats", f"""
WITH {REL},
f AS (SELECT artifact || '/' || version AS key,
             CASE CAST(substr(version, 7, 2) AS INTEGER) % 4
                  WHEN 0 THEN ['parquet', 'csv'] WHEN 1 THEN ['parquet', 'parquet']
                  WHEN 2 THEN CAST([] AS VARCHAR[]) ELSE ['json', 'csv', 'json'] END AS names
      FROM releases)
SELECT key, 'no_formats' AS rule FROM f WHERE len(names) = 0
UNION ALL
SELECT key, 'duplicate_format' FROM f WHERE len(list_distinct(names)) <> len(names)
""")
def qlt_formats(spark, sf):
    rel = D.releases(spark, sf)
    m = F.substring("version", 7, 2).cast("int") % 4
    names = (F.when(m == 0, F.array(F.lit("parquet"), F.lit("csv")))
              .when(m == 1, F.array(F.lit("parquet"), F.lit("parquet")))
              .when(m == 2, F.array().cast("array<string>"))
              .otherwise(F.array(F.lit("json"), F.lit("csv"), F.lit("json"))))
    f = rel.withColumn("names", names)
    return Q.format_violations(f, F.col("names"), F.concat_ws("/", "artifact", "version")).select("key", "rule")


@query("qlt_path_collisions", f"""
WITH {REL},
r AS (SELECT * FROM releases
      UNION ALL
      SELECT source, storage, artifact, version, created + INTERVAL 250 MILLISECOND, nrow FROM releases WHERE version LIKE 'v2000-%'),
p AS (SELECT created, source || '/' || artifact || '/' || version || '/' || strftime(created, '%Y%m%dT%H%M%S') || '/data.parquet' AS path FROM r)
SELECT path, count(*) AS n, count(DISTINCT created) AS n_keys FROM p GROUP BY path HAVING count(*) > 1
""")
def qlt_path_collisions(spark, sf):
    """D5: a re-collection 250 ms later is a new key but lands on the same path."""
    rel = D.releases(spark, sf)
    again = (rel.where(F.col("version").startswith("v2000-"))
                .withColumn("created", F.col("created") + F.expr("INTERVAL 250 MILLISECONDS")))
    reg = R.with_paths(D.registry(spark, sf, rel.unionByName(again)))
    return Q.path_collisions(reg)


# ---------------------------------------------------------------- comparison (CMP)


def _drifted_orders(spark, sf):
    o = table(spark, sf, "orders")
    meta = F.struct(F.col("o_orderstatus").alias("clerk"),
                    F.struct(F.col("o_orderpriority").alias("mode")).alias("ship"),
                    F.array(F.col("o_orderstatus")).alias("tags"))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
                    "o_orderdate", meta.alias("meta"))


def _inferred(spark, df, label):
    """A release as shipped (JSON lines) and its schema as inferred from all of its data.
    (Uncompressed here; gzip JSON reading is covered by ``src_json_infer``.)"""
    from releasekit.sources import readers

    path = scratch_path(spark, label)
    df.write.mode("overwrite").json(path)
    return readers.read_json_lines(spark, path)


@query("cmp_schema_diff", """
SELECT * FROM (VALUES
  ('o_totalprice', 'double', 'string', 'changed'),
  ('o_orderpriority', 'string', NULL, 'removed'),
  ('meta', NULL, 'struct', 'added'),
  ('meta.clerk', NULL, 'string', 'added'),
  ('meta.ship', NULL, 'struct', 'added'),
  ('meta.ship.mode', NULL, 'string', 'added'),
  ('meta.tags', NULL, 'array', 'added'),
  ('meta.tags[]', NULL, 'string', 'added')) AS t(path, old, new, change)
""")
def cmp_schema_diff(spark, sf):
    """CMP-1/2: both releases are published as JSON lines and their schemas inferred by
    Spark (a full pass over each, as when a release is imported), then diffed."""
    old = _inferred(spark, table(spark, sf, "orders"), "schema_old")
    new = _inferred(spark, _drifted_orders(spark, sf), "schema_new")
    return CMP.schema_diff(spark, old, new)


@query("cmp_release_counts", """
SELECT year, n, n - lag(n) OVER (ORDER BY year) AS delta FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1)
""")
def cmp_release_counts(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return CMP.release_counts(o, "year")


@query("cmp_release_keys", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 1999 AND o_custkey IS NOT NULL),
     b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) = 2000 AND o_custkey IS NOT NULL)
SELECT CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side,
       count(*) AS n
FROM a FULL JOIN b ON a.k = b.k GROUP BY 1
""")
def cmp_release_keys(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate")
    return CMP.release_keys_by(o, "o_custkey", y == 1999, y == 2000)


@query("cmp_union_releases", """
SELECT o_orderkey AS key, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price, CAST(NULL AS VARCHAR) AS extra,
       CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS n_bad
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_totalprice, o_orderstatus, 0 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def cmp_union_releases(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = o.where(F.col("o_orderdate") < cut).select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("NR")).otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    new = o.where(F.col("o_orderdate") >= cut).select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"),
                                    F.col("o_orderstatus").alias("extra"))
    return CMP.union_releases(old, new)


# ---------------------------------------------------------------- ontology goals (GOAL-1..3)

SQL_CLOSURE = D.SQL_EDGES + """,
closure(ancestor, descendant, depth) AS (
  SELECT parent, child, 1 FROM edges
  UNION ALL
  SELECT c.ancestor, e.child, c.depth + 1 FROM closure c JOIN edges e ON c.descendant = e.parent)"""


@query("goal_closure_extended", f"""
WITH RECURSIVE {SQL_CLOSURE}
SELECT ancestor, descendant, min(depth) AS depth FROM closure GROUP BY 1, 2
""")
def goal_closure_extended(spark, sf):
    """GOAL-1 as the hierarchy grows: the closure of nine tenths of the edges, extended by the rest,
    equals that of all."""
    e = D.edges(spark, sf)
    late = F.pmod(F.xxhash64("child"), F.lit(10)) == 0
    return ON.extend_closure(ON.descendants(e.where(~late)), e.where(late))


@query("goal_descendants", f"""
WITH RECURSIVE {SQL_CLOSURE}
SELECT ancestor, descendant, min(depth) AS depth FROM closure GROUP BY 1, 2
""")
def goal_descendants(spark, sf):
    return ON.descendants(D.edges(spark, sf))


@query("goal_ancestor_expansion", f"""
WITH RECURSIVE {SQL_CLOSURE},
ev AS (SELECT DISTINCT o_orderkey AS ok, 'C' || o_custkey AS term FROM orders),
x AS (SELECT ok, term FROM ev UNION SELECT ev.ok, c.ancestor FROM ev JOIN closure c ON c.descendant = ev.term)
SELECT term, count(*) AS n FROM x GROUP BY term
""")
def goal_ancestor_expansion(spark, sf):
    ev = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ok"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("term"))
    closure = ON.ancestors(D.edges(spark, sf), ev.select("term"))
    x = ON.expand_to_ancestors(ev, closure, "term")
    return x.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("goal_entity_set", """
WITH u AS (
  SELECT p_partkey AS k, 'catalog' AS src FROM part
  UNION ALL SELECT l_partkey, 'early' FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
  UNION ALL SELECT l_partkey, 'late' FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')
SELECT k AS p_partkey, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM u WHERE k IS NOT NULL GROUP BY k
""")
def goal_entity_set(spark, sf):
    p = table(spark, sf, "part")
    li = table(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    frames = {
        "catalog": p.select("p_partkey"),
        "early": li.where(F.col("l_shipdate") < cut).select(F.col("l_partkey").alias("p_partkey")),
        "late": li.where(F.col("l_shipdate") >= cut).select(F.col("l_partkey").alias("p_partkey")),
    }
    return ON.entity_sources(frames, "p_partkey")
