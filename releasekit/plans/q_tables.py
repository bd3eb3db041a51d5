"""Queries over the tables: projections, filters, aggregations, sets, joins, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from releasekit.functions import columns as C
from releasekit.functions.schema import drop_empty_columns, flatten, sanitize_columns
from releasekit.operators import filters as FL
from releasekit.operators import ontology as ON
from releasekit.operators import quality as Q
from releasekit.operators import sets as S
from releasekit.operators import summaries as A
from releasekit.plans import derived as D
from releasekit.plans.base import query, table
from releasekit.session import scratch_path
from releasekit.sources.writers import write_indexed

SLUG = D.SQL_SLUG

# ---------------------------------------------------------------- projections (PRJ)


@query("prj_nested_path", """
SELECT o_orderkey AS orderkey, c_mktsegment AS segment,
       'https://db.example.org/' || regexp_replace(regexp_replace(lower(o_orderpriority), '[^0-9a-z]+', '_', 'g'), '_+$', '')
         || '/' || CAST(o_orderkey AS VARCHAR) AS url
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def prj_nested_path(spark, sf):
    ev = D.evidence(spark, sf)
    return ev.select("orderkey", F.col("target.segment").alias("segment"), F.col("evidence.ref.url").alias("url"))


@query("prj_sanitize_columns", """
SELECT c_custkey, c_name AS "95_ci_text", c_acctbal AS acct_bal FROM customer
""")
def prj_sanitize_columns(spark, sf):
    c = table(spark, sf, "customer")
    raw = c.select(F.col("c_custkey").alias("C CustKey"), F.col("c_name").alias("95% CI (TEXT)"),
                   F.col("c_acctbal").alias("Acct.Bal#"))
    return sanitize_columns(raw)


@query("prj_flatten_struct", f"""
WITH codes AS (
  SELECT l_orderkey, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS codes
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS orderkey, o_custkey AS target_custkey, c_mktsegment AS target_segment, n_name AS target_nation,
       o_totalprice AS evidence_score, coalesce(codes, '') AS evidence_codes,
       {SLUG.format(c='o_orderpriority')} AS evidence_ref_id,
       'https://db.example.org/' || {SLUG.format(c='o_orderpriority')} || '/' || CAST(o_orderkey AS VARCHAR) AS evidence_ref_url,
       o_orderstatus AS type
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN codes ON o_orderkey = l_orderkey
""")
def prj_flatten_struct(spark, sf):
    flat = flatten(D.evidence(spark, sf))
    # arrays stay arrays in the flat table; rendered as sorted text for the comparison
    return flat.withColumn("evidence_codes", F.array_join("evidence_codes", ","))


@query("prj_drop_empty_columns", """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS f_price FROM orders
""")
def prj_drop_empty_columns(spark, sf):
    o = table(spark, sf, "orders")
    wide = o.select("*", F.lit(None).cast("string").alias("unused"),
                    F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("f_price"))
    return drop_empty_columns(wide)


@query("prj_row_json", """
SELECT o_orderkey,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
       || '","o_totalprice":' || CAST(o_totalprice AS VARCHAR) || ',"o_orderdate":"'
       || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '","o_orderpriority":"' || o_orderpriority || '"}' AS json
FROM orders ORDER BY o_orderkey LIMIT 10
""")
def prj_row_json(spark, sf):
    """SRT-5 + PRJ-6: the first 10 orders by key, each rendered as JSON (a preview: the
    limit is the feature)."""
    o = table(spark, sf, "orders")
    return A.rows_as_json(A.preview(o, ["o_orderkey"], 10), "o_orderkey")


# ---------------------------------------------------------------- filters (FLT)


@query("flt_nested_xref", """
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders
WHERE regexp_replace(regexp_replace(lower(o_orderpriority), '[^0-9a-z]+', '_', 'g'), '_+$', '') = '1_urgent'
""")
def flt_nested_xref(spark, sf):
    ev = FL.nested_equals(D.evidence(spark, sf), "evidence.ref", "id", "1_urgent")
    return ev.select(C.url_tail("evidence.ref.url").alias("id")).distinct()


@query("flt_contains", """
SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')
""")
def flt_contains(spark, sf):
    p = table(spark, sf, "part")
    return p.where(FL.contains_literal("p_name", "ring")).select("p_partkey", "p_name")


@query("flt_any_keyword", """
SELECT doc_id FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(text), 'password')
""")
def flt_any_keyword(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(FL.any_keyword("text", ["license", "password"])).select("doc_id")


ACCEPT_LIST = ["3-Medium"]
SQL_MIXED_CASE = "CASE o_orderkey % 3 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN upper(left(o_orderpriority, 3)) || lower(substr(o_orderpriority, 4)) ELSE o_orderpriority END"


@query("flt_accept_rules", f"""
WITH t AS (SELECT {SQL_MIXED_CASE} AS priority FROM orders)
SELECT priority,
       CASE WHEN priority IS NULL THEN false
            WHEN contains(lower(priority), 'not') THEN false
            WHEN contains(lower(priority), 'urgent') THEN true
            WHEN contains(lower(priority), 'high') THEN true
            WHEN lower(priority) IN ('3-medium') THEN true
            ELSE false END AS accept,
       count(*) AS n
FROM t GROUP BY 1, 2
""")
def flt_accept_rules(spark, sf):
    """FLT-4 on texts of mixed case: words and listed values match in any case."""
    p = F.col("o_orderpriority")
    k = F.col("o_orderkey") % 3
    mixed = (F.when(k == 0, F.lower(p)).when(k == 1, F.concat(F.upper(F.left(p, F.lit(3))), F.lower(F.substring(p, 4, 1000)))).otherwise(p))
    o = table(spark, sf, "orders").select(mixed.alias("priority"))
    rule = FL.accept_rules("priority", ["not"], ["urgent", "high"], ACCEPT_LIST)
    return o.groupBy("priority", rule.alias("accept")).agg(F.count(F.lit(1)).alias("n"))


CLASSES = [("small", "small"), ("large", "large")]


@query("flt_classify_keywords", """
WITH c AS (
  SELECT p_partkey, CASE WHEN contains(lower(p_name), 'small') THEN 'small'
                         WHEN contains(lower(p_name), 'large') THEN 'large' END AS class
  FROM part)
SELECT class, p_partkey, count(*) OVER (PARTITION BY class) AS n FROM c WHERE class IS NOT NULL
""")
def flt_classify_keywords(spark, sf):
    """FLT-5.  One row per classified id plus the class size; the per-class id list of
    the reference would put a whole class into one row, so ids stay rows."""
    p = table(spark, sf, "part")
    c = p.select("p_partkey", FL.classify_keywords("p_name", CLASSES).alias("class")).where("class is not null")
    sizes = c.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    # at most len(CLASSES) rows: the broadcast side is bounded by the parameter
    return c.join(F.broadcast(sizes), "class").select("class", "p_partkey", "n")


@query("flt_score_threshold", """
SELECT l_returnflag AS flag, count(*) AS n_before, CAST(count_if(l_discount >= 0.05) AS BIGINT) AS n_after
FROM lineitem GROUP BY 1
""")
def flt_score_threshold(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return FL.threshold_counts(li, ["flag"], "l_discount", 0.05)


@query("flt_point_lookup", "SELECT * FROM orders WHERE o_custkey = 100")
def flt_point_lookup(spark, sf):
    return FL.point_lookup(table(spark, sf, "orders"), "o_custkey", 100)


# ---------------------------------------------------------------- aggregations (AGG, SRT)


@query("agg_row_count", "SELECT count(*) AS nrow FROM documents")
def agg_row_count(spark, sf):
    return A.row_count(table(spark, sf, "documents"))


@query("agg_group_count", """
SELECT c_mktsegment AS segment, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def agg_group_count(spark, sf):
    return A.group_count(D.evidence(spark, sf), F.col("target.segment").alias("segment"))


MULTI_PATHS = ["target.segment", "target.nation", "type", "evidence.ref.id"]


@query("agg_multi_path_counts", f"""
SELECT 'target.segment' AS path, c_mktsegment AS value, count(*) AS n
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 2
UNION ALL
SELECT 'target.nation', n_name, count(*)
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 2
UNION ALL
SELECT 'type', o_orderstatus, count(*) FROM orders GROUP BY 2
UNION ALL
SELECT 'evidence.ref.id', {SLUG.format(c='o_orderpriority')}, count(*) FROM orders GROUP BY 2
""")
def agg_multi_path_counts(spark, sf):
    """AGG-2 for several nested paths from ONE scan of the evidence (the reference runs
    one job per path)."""
    return A.multi_path_counts(D.evidence(spark, sf), MULTI_PATHS)


@query("agg_group_count_pair", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def agg_group_count_pair(spark, sf):
    return A.group_count(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("agg_null_split", """
SELECT l.quality IS NULL AS is_null, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1
""")
def agg_null_split(spark, sf):
    j = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return A.group_count(j, F.col("quality").isNull().alias("is_null"))


@query("agg_min_max", "SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders")
def agg_min_max(spark, sf):
    return A.min_max(D.evidence(spark, sf), "evidence.score")


@query("agg_array_frequency", """
SELECT code, count(*) AS n FROM (
  SELECT DISTINCT l_orderkey, l_returnflag || l_linestatus AS code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY code
""")
def agg_array_frequency(spark, sf):
    return A.array_frequency(D.evidence(spark, sf), "evidence.codes", name="code")


@query("agg_distinct_per_group", """
SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1
""")
def agg_distinct_per_group(spark, sf):
    return A.distinct_per_group(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("agg_count_of_counts", """
SELECT n, count(*) AS n_keys FROM (
  SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1)
GROUP BY n
""")
def agg_count_of_counts(spark, sf):
    per = A.distinct_per_group(table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")
    return A.count_of_counts(per)


def _sold_brands(spark, sf):
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(p, li["l_partkey"] == p["p_partkey"]).join(s, li["l_suppkey"] == s["s_suppkey"])
              .select(F.col("s_nationkey").alias("nation"), F.col("l_suppkey").alias("supp"), "p_brand"))


SQL_SOLD_BRANDS = """
SELECT s_nationkey AS nation, l_suppkey AS supp, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS terms
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE p_brand IS NOT NULL
GROUP BY 1, 2"""


@query("agg_sorted_concat", SQL_SOLD_BRANDS)
def agg_sorted_concat(spark, sf):
    return A.sorted_concat(_sold_brands(spark, sf), ["nation", "supp"], "p_brand")


@query("flt_point_lookup_indexed", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey = (SELECT max(l_partkey) // 2 FROM lineitem)
""")
def flt_point_lookup_indexed(spark, sf):
    """FLT-7 on a release written for it (SNK-1): sorted by the key, with Bloom filters, so the lookup
    reads the row groups of one key range."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "indexed")
    write_indexed(li, path, "l_partkey")
    wanted = li.agg(F.max("l_partkey")).first()[0] // 2
    return FL.point_lookup(spark.read.parquet(path), "l_partkey", wanted).select("l_orderkey", "l_partkey", "l_quantity")


@query("agg_sorted_values", """
SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_partkey) AS position, l_partkey
FROM (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem)
""")
def agg_sorted_values(spark, sf):
    """AGG-10 for groups of any size: sorted distinct values as rows, never as one string."""
    return A.sorted_values(table(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey")


@query("agg_dependency_check", f"""
WITH sig AS ({SQL_SOLD_BRANDS})
SELECT n_signatures, count(*) AS n_keys FROM (
  SELECT nation, count(DISTINCT terms) AS n_signatures FROM sig GROUP BY nation) GROUP BY n_signatures
""")
def agg_dependency_check(spark, sf):
    return A.dependency_check(_sold_brands(spark, sf), "nation", "supp", "p_brand")


@query("agg_value_counts", "SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY 1")
def agg_value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "part"), "p_type")


@query("agg_share_of_total", """
SELECT lang AS key, count(*) AS n,
       round(count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM documents WHERE lang IS NOT NULL), 2) AS pct
FROM documents WHERE lang IS NOT NULL GROUP BY lang
UNION ALL
SELECT 'quality_non_null', count(l.quality), round(count(l.quality) * CAST(100.0 AS DOUBLE) / count(*), 2)
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def agg_share_of_total(spark, sf):
    d = table(spark, sf, "documents")
    langs = A.share_of_total(A.value_counts(d, "lang")).select(F.col("lang").alias("key"), "n", "pct")
    q = A.non_null_rate(d.join(table(spark, sf, "labels"), "doc_id", "left"), "quality")
    return langs.unionByName(q.select(F.lit("quality_non_null").alias("key"), "n", "pct"))


def _profile_sql(tbl: str, cols: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{tbl}' AS \"table\", '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) AS nrow FROM {tbl}"
             for c, t in cols]
    return "\nUNION ALL\n".join(parts)


@query("agg_column_profile", _profile_sql("orders", [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]) + "\nUNION ALL\n" + _profile_sql("labels", [
    ("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]))
def agg_column_profile(spark, sf):
    o = A.column_profile(table(spark, sf, "orders")).select(F.lit("orders").alias("table"), "*")
    lb = A.column_profile(table(spark, sf, "labels")).select(F.lit("labels").alias("table"), "*")
    return o.unionByName(lb)


@query("agg_distinct_combinations", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(DISTINCT (l_partkey, l_suppkey, l_returnflag)) AS n
FROM lineitem GROUP BY 1
""")
def agg_distinct_combinations(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    return A.distinct_combinations(li, ["year"], ["l_partkey", "l_suppkey", "l_returnflag"])


@query("agg_top_k", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey ASC NULLS LAST LIMIT 25
""")
def agg_top_k(spark, sf):
    counts = A.group_count(table(spark, sf, "orders"), "o_custkey")
    return A.top_k(counts, "n", "o_custkey", 25)


# ---------------------------------------------------------------- sets and joins (SET, JOI)


@query("set_overlap_report", """
WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL),
     r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'R' AND l_orderkey IS NOT NULL)
SELECT 'both' AS side, count(*) AS n FROM (SELECT k FROM l INTERSECT SELECT k FROM r)
UNION ALL SELECT 'left_only', count(*) FROM (SELECT k FROM l EXCEPT SELECT k FROM r)
UNION ALL SELECT 'right_only', count(*) FROM (SELECT k FROM r EXCEPT SELECT k FROM l)
""")
def set_overlap_report(spark, sf):
    """Orders with returned lines against orders with other lines: the two cover the table."""
    li = table(spark, sf, "lineitem")
    returned = F.col("l_returnflag") == "R"
    return S.side_counts(S.overlap_sides_by(li, "l_orderkey", returned, F.col("l_returnflag") != "R"))


@query("set_distinct_values", "SELECT DISTINCT text FROM documents")
def set_distinct_values(spark, sf):
    return S.distinct_values(table(spark, sf, "documents"), "text")


@query("joi_semi_multi_group", """
SELECT l_orderkey, count(DISTINCT l_partkey) AS n FROM lineitem
WHERE l_orderkey IN (
  SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_orderkey HAVING count(DISTINCT s_nationkey) > 1)
GROUP BY l_orderkey
""")
def joi_semi_multi_group(spark, sf):
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    lines = li.join(s, li["l_suppkey"] == s["s_suppkey"])
    multi = S.keys_with_several(lines, "l_orderkey", "s_nationkey")
    # the semi join and the aggregation share the l_orderkey partitioning: one shuffle of lineitem
    return A.distinct_per_group(S.semi_join(li, multi, ["l_orderkey"]), "l_orderkey", "l_partkey")


# Release date per order year; 1996 and 2000 are deliberately absent.
RELEASE_DATES = [(1995, "1995-02-15"), (1997, "1997-02-17"), (1998, "1998-02-16"), (1999, "1999-02-15"), (2001, "2001-02-19")]


@query("joi_release_date_lookup", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderdate IS NOT NULL),
lk(year, release_date) AS (VALUES (1995, '1995-02-15'), (1997, '1997-02-17'), (1998, '1998-02-16'), (1999, '1999-02-15'), (2001, '2001-02-19'))
SELECT y.year, lk.release_date, lk.release_date IS NULL AS missing FROM y LEFT JOIN lk ON y.year = lk.year
""")
def joi_release_date_lookup(spark, sf):
    years = table(spark, sf, "orders").where("o_orderdate is not null").select(F.year("o_orderdate").alias("year")).distinct()
    lookup = spark.createDataFrame(RELEASE_DATES, "year int, release_date string")
    # the lookup is a fixed parameter table: its size is known, so broadcasting it is safe
    return S.lookup_required(years, F.broadcast(lookup), "year", "release_date").select("year", "release_date", "missing")


CROSSWALK_CLASSES = [("america", "america"), ("europe", "europe")]


@query("joi_crosswalk_sources", """
WITH tc AS (
  SELECT r_regionkey AS term, CASE WHEN contains(lower(r_name), 'america') THEN 'america'
                                   WHEN contains(lower(r_name), 'europe') THEN 'europe' END AS class
  FROM region),
concepts AS (SELECT DISTINCT n_nationkey AS concept, class FROM tc JOIN nation ON n_regionkey = term WHERE class IS NOT NULL),
rel AS (SELECT o_custkey AS customer, s_nationkey AS concept, l_returnflag AS src
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT customer, class, string_agg(DISTINCT src, ',' ORDER BY src) AS sources
FROM rel JOIN concepts USING (concept) WHERE src IS NOT NULL GROUP BY customer, class
""")
def joi_crosswalk_sources(spark, sf):
    r = table(spark, sf, "region")
    terms = r.select(F.col("r_regionkey").alias("term"),
                     FL.classify_keywords("r_name", CROSSWALK_CLASSES).alias("class")).where("class is not null")
    mapping = table(spark, sf, "nation").select(F.col("n_regionkey").alias("term"), F.col("n_nationkey").alias("concept"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    # the suppliers of the chosen concepts first: lineitem is joined once, to those, by supplier
    concepts = ON.crosswalk_concepts(terms, mapping, term="term", concept="concept")
    chosen = s.join(concepts, F.col("s_nationkey") == F.col("concept")).select("s_suppkey", "class")
    rel = li.join(chosen, li["l_suppkey"] == chosen["s_suppkey"]).select("l_orderkey", "class", F.col("l_returnflag").alias("src"))
    cust = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"))
    return ON.subject_sources(rel.join(cust, "l_orderkey"), subject="customer", source="src")


# ---------------------------------------------------------------- quality over tables


@query("qlt_coverage", """
SELECT count(*) AS n_wanted, count(l.doc_id) AS n_found, count(*) - count(l.doc_id) AS n_missing
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d
LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
""")
def qlt_coverage(spark, sf):
    return Q.coverage(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("qlt_duplicate_keys", "SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def qlt_duplicate_keys(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "documents"), ["text"])


# ---------------------------------------------------------------- scalar functions (SCL)


@query("scl_url_tail_prefix", """
SELECT page_id, string_split(url, '/')[-1] AS tail, split_part(string_split(url, '/')[-1], '.', 1) AS token,
       substr(string_split(url, '/')[-1], 1, 5) AS prefix
FROM pages
""")
def scl_url_tail_prefix(spark, sf):
    p = table(spark, sf, "pages").withColumn("tail", C.url_tail("url"))
    return p.select("page_id", "tail", C.nth_token("tail", r"\.", 1).alias("token"), C.prefix("tail", 5).alias("prefix"))


@query("scl_split_explode", """
SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY token
""")
def scl_split_explode(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.explode(C.split_values("p_name", " ")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("scl_iri_to_curie", """
SELECT p_partkey, 'http://purl.example.org/obo/HP_' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS iri,
       replace(string_split('http://purl.example.org/obo/HP_' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'), '/')[-1], '_', ':') AS curie
FROM part
""")
def scl_iri_to_curie(spark, sf):
    p = table(spark, sf, "part")
    iri = F.concat(F.lit("http://purl.example.org/obo/HP_"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"))
    return p.select("p_partkey", iri.alias("iri")).withColumn("curie", C.iri_to_curie("iri"))


@query("scl_version_from_ts", """
SELECT 'v' || strftime(ts, '%Y-%m-%d') AS version_day, 'v' || strftime(ts, '%Y-%m') AS version_month,
       strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS created, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def scl_version_from_ts(spark, sf):
    e = table(spark, sf, "events")
    g = e.groupBy(C.version_from_ts("ts", "day").alias("version_day"),
                  C.version_from_ts("ts", "month").alias("version_month")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("created", C.created_from_version("version_day", "day"))


@query("scl_slugify", f"""
SELECT raw, {SLUG.format(c='raw')} AS slug FROM (
  SELECT o_orderpriority AS raw FROM orders UNION SELECT p_name FROM part UNION SELECT url FROM pages)
""")
def scl_slugify(spark, sf):
    raw = (table(spark, sf, "orders").select(F.col("o_orderpriority").alias("raw"))
           .union(table(spark, sf, "part").select("p_name"))
           .union(table(spark, sf, "pages").select("url")).distinct())
    return raw.withColumn("slug", C.slugify("raw"))


@query("scl_artifact_kind", """
SELECT page_id,
       CASE WHEN ends_with(url, '.html') THEN 'html' WHEN ends_with(url, '/') THEN 'listing' ELSE 'page' END AS format,
       CASE WHEN ends_with(url, '.html') THEN 'file' ELSE 'directory' END AS type
FROM pages
""")
def scl_artifact_kind(spark, sf):
    p = table(spark, sf, "pages")
    fmt = F.when(F.col("url").endswith(".html"), "html").when(F.col("url").endswith("/"), "listing").otherwise("page")
    return p.select("page_id", fmt.alias("format"), C.artifact_kind("url", ".html").alias("type"))
