"""Source / sink round trips: each query turns a table into the dump shape a public
source ships (written by Spark, one complete file per task, under the shared scratch
folder), reads it back with the matching reader, and returns the rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions import columns as C
from releasekit.functions.schema import to_flat
from releasekit.operators import compare as CMP
from releasekit.operators import quality as Q
from releasekit.operators import registry as R
from releasekit.operators.ingest import import_release
from releasekit.plans.base import query, table
from releasekit.session import scratch_path
from releasekit.sources import dumps, readers
from releasekit.sources.writers import publish, publish_release, read_published, write_parquet, write_profiled, write_versioned
from releasekit.streaming.snapshots import snapshot_stream

PREAMBLE_LINES = 15
VERSION_ROWS_PER_FILE = 1_000_000


def cast_strict(df, schema: T.StructType):
    """Apply recorded types by name (the dump carried strings); a value of another type fails."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


# ---------------------------------------------------------------- sources (SRC)


def _preamble_dump(spark, sf):
    """Supplier with 15 preamble lines and a header; the first field of some rows begins with the
    mark of the header, and some balances are NA."""
    s = table(spark, sf, "supplier")
    path = scratch_path(spark, "preamble")
    name = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("#"), "s_name")).otherwise(F.col("s_name"))
    balance = F.when(F.col("s_suppkey") % 7 == 0, F.lit("NA")).otherwise(F.col("s_acctbal").cast("string"))
    dump = s.select(name.alias("s_name"), "s_suppkey", "s_nationkey", balance.alias("s_acctbal"))
    preamble = [f"## dump line {i + 1}" for i in range(PREAMBLE_LINES)]
    dumps.write_delimited_dump(dump, path, sep="\t", header="#" + "\t".join(dump.columns), preamble=preamble,
                               compression="gzip")
    return path


SQL_PREAMBLE_NAME = "CASE WHEN s_suppkey % 5 = 0 THEN '#' || s_name ELSE s_name END AS s_name"


@query("src_preamble_tsv", f"""
SELECT {SQL_PREAMBLE_NAME}, CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_suppkey % 7 = 0 AS no_balance
FROM supplier
""")
def src_preamble_tsv(spark, sf):
    """SRC-1: the preamble goes by count, so rows that look like comments stay."""
    got = readers.read_preamble_tsv(spark, _preamble_dump(spark, sf), skip=PREAMBLE_LINES)
    return got.select("s_name", "s_suppkey", "s_nationkey", (F.col("s_acctbal") == "NA").alias("no_balance"))


@query("src_preamble_typed", f"""
SELECT {SQL_PREAMBLE_NAME}, s_suppkey, s_nationkey, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS s_acctbal FROM supplier
""")
def src_preamble_typed(spark, sf):
    """SRC-1 with types: integers and doubles are found from all rows, NA tokens are null."""
    return readers.infer_types(readers.read_preamble_tsv(spark, _preamble_dump(spark, sf), skip=PREAMBLE_LINES))


@query("qlt_cast_violations", """
SELECT 'cast:s_acctbal' AS rule, CAST(s_suppkey AS VARCHAR) AS key, 'NA' AS value FROM supplier WHERE s_suppkey % 7 = 0
UNION ALL
SELECT 'cast:s_nationkey', CAST(s_suppkey AS VARCHAR), 'n/a' FROM supplier WHERE s_suppkey % 3 = 0
""")
def qlt_cast_violations(spark, sf):
    """Values of a dump that the recorded types would turn into nulls, as violation rows."""
    raw = readers.read_preamble_tsv(spark, _preamble_dump(spark, sf), skip=PREAMBLE_LINES)
    raw = raw.withColumn("s_nationkey", F.when(F.col("s_suppkey").cast("bigint") % 3 == 0, "n/a").otherwise(F.col("s_nationkey")))
    return Q.cast_violations(raw, table(spark, sf, "supplier").schema, "s_suppkey")


@query("src_typed_identifiers", """
SELECT o_orderkey, o_orderkey || 'D' AS suffixed, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS padded,
       CASE WHEN o_orderkey % 7 >= 4 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 2 = 0 END AS even,
       CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE o_orderstatus END AS status
FROM orders
""")
def src_typed_identifiers(spark, sf):
    """SRC-1 with lossless types: identifiers that a cast would read as numbers stay text, any of the
    usual tokens is null, a dash is not; numbers, truth values and dates get their types."""
    o = table(spark, sf, "orders")
    token = F.element_at(F.array(*[F.lit(t) for t in ("n/a", "None", "<NA>", "#N/A")]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    dump = o.select(
        "o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit("D")).alias("suffixed"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("padded"),
        F.when(F.col("o_orderkey") % 7 >= 4, F.col("o_totalprice").cast("string")).otherwise(token).alias("price"),
        F.when(F.col("o_orderkey") % 5 == 0, "NaN").when(F.col("o_custkey") % 2 == 0, "True").otherwise("False").alias("even"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise(F.col("o_orderstatus")).alias("status"))
    path = scratch_path(spark, "typed")
    dumps.write_delimited_dump(dump, path, header="#" + "\t".join(dump.columns), preamble=[f"## dump line {i + 1}" for i in range(PREAMBLE_LINES)], compression="gzip")
    return readers.infer_types(readers.read_preamble_tsv(spark, path, skip=PREAMBLE_LINES))


@query("src_quarantine", """
WITH lines AS (
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN 'too few fields' WHEN l_orderkey % 13 = 0 THEN 'too many fields' WHEN l_orderkey % 17 = 0 THEN 'bad quotes'
              WHEN l_orderkey % 19 = 0 THEN 'no double in l_extendedprice' ELSE 'good' END AS outcome, l_extendedprice
  FROM lineitem)
SELECT outcome, count(*) AS n, CAST(round(sum(CASE WHEN outcome = 'good' THEN l_extendedprice END), 2) AS DECIMAL(24, 2)) AS price FROM lines GROUP BY outcome
UNION ALL SELECT 'read', count(*), NULL FROM lines
UNION ALL SELECT 'bad lines numbered', count(*), NULL FROM lines WHERE outcome <> 'good'
""")
def src_quarantine(spark, sf):
    """SRC-1/2/5 on a damaged dump: rows with too few or too many fields, bad quotes or no number are
    set aside with file and line, none becomes nulls; read, good and bad rows add up."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    key, line = F.col("l_orderkey"), dumps.as_text(["l_orderkey", "l_returnflag", "l_extendedprice"], "\t")
    damaged = (F.when(key % 11 == 0, F.substring_index(line, "\t", 2)).when(key % 13 == 0, F.concat(line, F.lit("\tmore")))
               .when(key % 17 == 0, F.concat(F.lit('"'), line)).when(key % 19 == 0, F.concat(line, F.lit("D"))).otherwise(line))
    path = scratch_path(spark, "damaged")
    dumps.write_text_dump(li.select(damaged.alias("value")), path, head=["# damaged", "l_orderkey\tl_returnflag\tl_extendedprice"], compression="gzip", n_chunks=8)
    rows = readers.read_rescued(spark, path, li.schema, skip=2)
    outcome = F.coalesce(F.col(f"{readers.RESCUED}.fault"), F.lit("good")).alias("outcome")
    per = rows.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).cast("decimal(24,2)").alias("price"))
    none = F.lit(None).cast("decimal(24,2)").alias("price")
    read = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("outcome"), "n", none)
    numbered = readers.quarantined(spark, rows, path).where("line > 2").select("file", "line").distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad lines numbered").alias("outcome"), "n", none)
    return per.unionByName(read).unionByName(numbered)


@query("src_header_tsv", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
""")
def src_header_tsv(spark, sf):
    path = scratch_path(spark, "header_tsv")
    table(spark, sf, "nation").write.mode("overwrite").csv(path, sep="\t", header=True)
    return readers.read_delimited(spark, path, sep="\t", header=True)


@query("src_pipe_trailing", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region")
def src_pipe_trailing(spark, sf):
    r = table(spark, sf, "region")
    path = scratch_path(spark, "pipe")
    dumps.write_delimited_dump(r, path, sep="|", header="#" + "|".join(r.columns) + "|", trailing_sep=True)
    return readers.read_trailing_delimited(spark, path, sep="|")


@query("src_named_header_repair", "SELECT * FROM part")
def src_named_header_repair(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "named")
    dumps.write_delimited_dump(p, path, sep="\t", header="#Format: " + "<tab>".join(p.columns))
    raw = readers.read_with_repaired_header(spark, path, marker="#Format: ", token="<tab>")
    return cast_strict(raw, p.schema)


def _chunk_dir(spark, sf, label, chunk_of):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, label)
    (c.withColumn("M", chunk_of(F.col("c_custkey"))).write.mode("overwrite")
      .partitionBy("M").option("compression", "gzip").csv(path))
    return c, path


@query("src_chunked_csv", "SELECT * FROM customer")
def src_chunked_csv(spark, sf):
    c, path = _chunk_dir(spark, sf, "chunks", lambda k: F.pmod(k, F.lit(4)) + 1)
    return readers.read_chunks(spark, path, schema=c.schema)


CHUNK_PATTERN = r"/M=(\d+)/"


@query("src_chunk_completeness", """
WITH ch AS (SELECT DISTINCT CASE WHEN c_custkey % 4 = 3 THEN 5 ELSE c_custkey % 4 + 1 END AS no FROM customer),
r AS (SELECT no, row_number() OVER (ORDER BY no) AS pos FROM ch)
SELECT CAST(count_if(no = pos) AS BIGINT) AS n_contiguous, count(*) AS n_found FROM r
""")
def src_chunk_completeness(spark, sf):
    # chunks 1, 2, 3 and 5: the gap at 4 ends the contiguous run
    _, path = _chunk_dir(spark, sf, "chunks_gap",
                         lambda k: F.when(F.pmod(k, F.lit(4)) == 3, F.lit(5)).otherwise(F.pmod(k, F.lit(4)) + 1))
    return readers.chunk_completeness(spark, path, CHUNK_PATTERN)


@query("src_json_infer", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def src_json_infer(spark, sf):
    e = table(spark, sf, "events")
    path = scratch_path(spark, "json")
    nested = e.select("event_id", "ts", "user_id", "event_type", "value",
                      F.from_json("props", "k bigint").alias("props"))
    nested.write.mode("overwrite").option("compression", "gzip").json(path)
    back = readers.valid_records(readers.read_json_lines(spark, path))
    return back.select("event_id", "event_type", F.col("props.k").alias("k"))


TERMS_PER_PAGE = 1000
IRI_BASE = "http://purl.example.org/"


@query("src_json_document_terms", f"""
SELECT DISTINCT '{IRI_BASE}brand/' || replace(p_brand, '#', '_') AS iri, p_brand AS label FROM part WHERE p_brand IS NOT NULL
UNION
SELECT DISTINCT '{IRI_BASE}type/' || replace(p_type, '#', '_'), p_type FROM part WHERE p_type IS NOT NULL
""")
def src_json_document_terms(spark, sf):
    p = table(spark, sf, "part")
    brands = p.where("p_brand is not null").select(
        F.concat(F.lit(IRI_BASE + "brand/"), F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("iri"),
        F.col("p_brand").alias("label"))
    types = p.where("p_type is not null").select(
        F.concat(F.lit(IRI_BASE + "type/"), F.replace("p_type", F.lit("#"), F.lit("_"))).alias("iri"),
        F.col("p_type").alias("label"))
    terms = brands.union(types).distinct()
    # API-style pages of bounded size: one JSON document per page
    n_pages = max(1, -(-terms.count() // TERMS_PER_PAGE))
    paged = terms.withColumn("page", F.pmod(F.xxhash64("iri"), F.lit(n_pages)))
    path = scratch_path(spark, "terms")
    dumps.write_json_pages(paged, path, "page")
    return readers.read_json_documents(spark, path, "_embedded.terms", one_per_line=True).select("iri", "label")


@query("src_parquet", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
""")
def src_parquet(spark, sf):
    li = readers.read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return (li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .select("l_orderkey", "l_partkey", "l_quantity"))


@query("src_registry_read", """
SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)
""")
def src_registry_read(spark, sf):
    """SRC-10/11: publish every order month as a version, in one write, register them all and
    read ``latest`` back through the registry."""
    o = table(spark, sf, "orders").where("o_orderdate IS NOT NULL").withColumn("version", C.version_from_ts("o_orderdate", "month"))
    root = scratch_path(spark, "registry_read")
    store = f"{root}/store/orders/monthly"
    write_versioned(o, store, rows_per_file=VERSION_ROWS_PER_FILE)
    months = o.groupBy("version").agg(F.max("o_orderdate").alias("created"), F.count(F.lit(1)).alias("nrow"))
    entries = R.build_entries(months, source=F.lit("orders"), artifact=F.lit("monthly"), version="version", created="created",
                              metadata=F.create_map(F.lit("nrow"), F.col("nrow").cast("string")),
                              resources=F.create_map(F.lit("parquet"), F.concat(F.lit(store + "/version="), F.col("version"))))
    R.save_registry(R.require_valid(entries), f"{root}/registry")
    return R.read_release(spark, R.load_registry(spark, f"{root}/registry"), "orders", "monthly", "latest")


@query("src_registry_flat_read", """
SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def src_registry_flat_read(spark, sf):
    """SRC-11: publish one release per priority, flatten the registry, pick the row of one
    artifact and read the URL from its ``resources_parquet`` column."""
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "flat_read")
    with_slug = o.withColumn("artifact", C.slugify("o_orderpriority"))
    # all priorities in one write: one directory per artifact, partition-pruned on read
    store = f"{root}/store/orders"
    write_versioned(with_slug, store, "artifact")
    arts = with_slug.select("artifact").distinct()
    reg = R.build_entries(arts, source=F.lit("orders"), artifact="artifact", version=F.lit("v1"),
                          created=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                          resources=F.create_map(F.lit("parquet"),
                                                 F.concat(F.lit(store + "/artifact="), F.col("artifact"))))
    flat = to_flat(reg)
    url = flat.where(F.col("artifact") == "1_urgent").select("resources_parquet").first()[0]
    return spark.read.parquet(url)


@query("src_registry_json_read", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def src_registry_json_read(spark, sf):
    """SRC-7 + SRC-10: a JSON-lines release is registered with the schema recorded from
    its one inference pass and its format properties; reading it back through the
    registry applies the recorded schema, so no second inference pass runs."""
    e = table(spark, sf, "events")
    root = scratch_path(spark, "json_release")
    url = f"{root}/store/events/json/v1/data.json"
    nested = e.select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    nested.write.mode("overwrite").option("compression", "gzip").json(url)
    recorded = readers.read_json_lines(spark, url).schema  # the import's one inference pass
    one = spark.range(1).select(F.lit("2024-01-30 00:00:00").cast("timestamp_ntz").alias("created"))
    entry = R.build_entries(
        one, source=F.lit("events"), artifact=F.lit("json"), version=F.lit("v1"), created="created",
        formats=F.array(R.format_struct(F.lit("json"), F.lit("directory"), F.lit(True),
                                        F.create_map(F.lit("compression"), F.lit("gzip"),
                                                     F.lit("mode"), F.lit("FAILFAST")))),
        metadata=F.create_map(F.lit("schema_json"), F.lit(recorded.json())),
        resources=F.create_map(F.lit("json"), F.lit(url)))
    R.save_registry(entry, f"{root}/registry")
    back = R.read_release(spark, R.load_registry(spark, f"{root}/registry"), "events", "json", "latest")
    return back.select("event_id", "event_type", F.col("props.k").alias("k"))


# Significance texts given to the three line flags, and the accept rules.
SIGNIFICANCE = [("A", "Pathogenic"), ("N", "conflicting interpretations"), ("R", "Risk Factor")]
REJECT_WORDS = ["conflicting"]
ACCEPT_WORDS = ["pathogenic", "protective"]
ACCEPT_VALUES = ["risk factor"]


@query("cmp_derived_vs_origin", f"""
WITH a AS (
  SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders
  WHERE regexp_replace(regexp_replace(lower(o_orderpriority), '[^0-9a-z]+', '_', 'g'), '_+$', '') = '1_urgent'),
o AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'Pathogenic' WHEN 'N' THEN 'conflicting interpretations' ELSE 'Risk Factor' END AS cs,
         CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_orderkey + 1 AS VARCHAR) || ';' AS rcv
  FROM lineitem),
acc AS (
  SELECT rcv FROM o
  WHERE CASE WHEN contains(lower(cs), 'conflicting') THEN false
             WHEN contains(lower(cs), 'pathogenic') OR contains(lower(cs), 'protective') THEN true
             WHEN lower(cs) IN ('risk factor') THEN true ELSE false END),
b AS (SELECT DISTINCT t AS id FROM (SELECT unnest(string_split(rcv, ';')) AS t FROM acc))
SELECT 'both' AS side, count(*) AS n FROM (SELECT id FROM a INTERSECT SELECT id FROM b)
UNION ALL SELECT 'left_only', count(*) FROM (SELECT id FROM a EXCEPT SELECT id FROM b)
UNION ALL SELECT 'right_only', count(*) FROM (SELECT id FROM b EXCEPT SELECT id FROM a)
""")
def cmp_derived_vs_origin(spark, sf):
    """CMP-4 as the reference's analysis runs it, end to end.
    * Derived side: evidence records whose nested cross-reference id matches (FLT-1), the
      accession taken as the URL tail (SCL-1).
    * Origin side: a TSV summary read as strings (SRC-2), kept by ordered accept / reject
      rules on the significance text (FLT-4), its ``;``-separated accession cell exploded
      (SCL-4).
    * Result: one overlap aggregation (SET-1/2), never collected id sets."""
    from releasekit.operators import filters as FL
    from releasekit.operators import sets as S
    from releasekit.plans import derived as D

    ev = FL.nested_equals(D.evidence(spark, sf), "evidence.ref", "id", "1_urgent")
    derived = ev.select(C.url_tail("evidence.ref.url").alias("id"))

    li = table(spark, sf, "lineitem")
    sig = None
    for flag, text in SIGNIFICANCE[:-1]:
        cond = F.col("l_returnflag") == flag
        sig = F.when(cond, F.lit(text)) if sig is None else sig.when(cond, F.lit(text))
    sig = sig.otherwise(F.lit(SIGNIFICANCE[-1][1]))
    rcv = F.concat(F.col("l_orderkey").cast("string"), F.lit(";"), (F.col("l_orderkey") + 1).cast("string"), F.lit(";"))
    path = scratch_path(spark, "variant_summary")
    li.select(sig.alias("ClinicalSignificance"), rcv.alias("RCVaccession")).write.mode("overwrite") \
      .csv(path, sep="\t", header=True)
    summary = readers.read_delimited(spark, path, sep="\t", header=True)
    kept = summary.where(FL.accept_rules("ClinicalSignificance", REJECT_WORDS, ACCEPT_WORDS, ACCEPT_VALUES))
    origin = kept.select(F.explode(C.split_values("RCVaccession", ";")).alias("id"))
    return S.overlap_report(derived, origin, "id")


TERM_CLASSES = [("small", "small"), ("large", "large")]
OBO_BASE = "http://purl.example.org/obo/HP_"


@query("joi_term_mapping_coverage", f"""
WITH t AS (
  SELECT 'HP:' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS curie,
         CASE WHEN contains(lower(p_name), 'small') THEN 'small' WHEN contains(lower(p_name), 'large') THEN 'large' END AS class
  FROM part),
c AS (SELECT DISTINCT curie, class FROM t WHERE class IS NOT NULL),
m AS (SELECT DISTINCT 'C' || CAST(l_suppkey AS VARCHAR) AS cui, 'HP:' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS sdui FROM lineitem),
hit AS (SELECT m.cui, m.sdui, c.class FROM m JOIN c ON m.sdui = c.curie)
SELECT c.class, count(DISTINCT c.curie) AS n_terms,
       coalesce(max(h.n_mapped), 0) AS n_mapped, coalesce(max(h.n_concepts), 0) AS n_concepts
FROM c LEFT JOIN (SELECT class, count(DISTINCT sdui) AS n_mapped, count(DISTINCT cui) AS n_concepts FROM hit GROUP BY class) h
  ON c.class = h.class
GROUP BY c.class
""")
def joi_term_mapping_coverage(spark, sf):
    """The concept-mapping flow end to end: ontology terms arrive as paged JSON documents
    (SRC-8), are classified by keyword in their label (FLT-5), turned into compact ids
    (SCL-5), and the mapping table is cut to them by a join (JOI-1; never a collected
    ``isin`` list).  Per class: terms, terms with a mapping (QLT-5 coverage) and distinct
    concepts reached."""
    from releasekit.operators import filters as FL

    p = table(spark, sf, "part")
    terms = p.select(F.concat(F.lit(OBO_BASE), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("iri"),
                     F.col("p_name").alias("label"))
    n_pages = max(1, -(-terms.count() // TERMS_PER_PAGE))
    path = scratch_path(spark, "obo_pages")
    dumps.write_json_pages(terms.withColumn("page", F.pmod(F.xxhash64("iri"), F.lit(n_pages))), path, "page")
    got = readers.read_json_documents(spark, path, "_embedded.terms", one_per_line=True)
    classified = (got.select(C.iri_to_curie("iri").alias("curie"),
                             FL.classify_keywords("label", TERM_CLASSES).alias("class"))
                     .where("class is not null").distinct())
    li = table(spark, sf, "lineitem")
    mapping = li.select(F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("cui"),
                        F.concat(F.lit("HP:"), F.lpad(F.col("l_partkey").cast("string"), 7, "0")).alias("sdui"))
    # the mapping repeats a pair per semantic type (here: per line), so de-duplicate first;
    # the join to the classified ids both cuts the mapping to them and attaches the class
    hits = mapping.distinct().join(classified.select(F.col("curie").alias("sdui"), "class"), "sdui")
    per_class = classified.groupBy("class").agg(F.count_distinct("curie").alias("n_terms"))
    mapped = hits.groupBy("class").agg(F.count_distinct("sdui").alias("n_mapped"),
                                       F.count_distinct("cui").alias("n_concepts"))
    out = per_class.join(mapped, "class", "left")
    return out.select("class", "n_terms", F.coalesce("n_mapped", F.lit(0)).alias("n_mapped"),
                      F.coalesce("n_concepts", F.lit(0)).alias("n_concepts"))


# ---------------------------------------------------------------- sinks (SNK)


@query("snk_parquet_repartition", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def snk_parquet_repartition(spark, sf):
    path = scratch_path(spark, "repartition")
    write_parquet(table(spark, sf, "events"), path, n_partitions=4)
    back = spark.read.parquet(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("snk_versioned_layout", """
WITH c AS (SELECT 'v' || strftime(o_orderdate, '%Y-%m') AS version, CASE WHEN day(o_orderdate) < 15 THEN 1 ELSE 15 END AS d, o_orderdate FROM orders)
SELECT version, strftime(date_trunc('month', o_orderdate) + to_days(d - 1), '%Y%m%dT%H%M%S') AS created,
       'orders/orders/version=' || version || '/created=' || strftime(date_trunc('month', o_orderdate) + to_days(d - 1), '%Y%m%dT%H%M%S') AS directory, count(*) AS n
FROM c GROUP BY 1, 2, 3
""")
def snk_versioned_layout(spark, sf):
    """SNK-2 in bulk: every month is a version with two collections (the first and the second
    half of the month), each in the directory of its own time; the path is checked."""
    root = scratch_path(spark, "versioned")
    half = F.when(F.dayofmonth("o_orderdate") < 15, 0).otherwise(14)
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    o = (table(spark, sf, "orders").withColumn("version", C.version_from_ts("o_orderdate", "month"))
         .withColumn("collected", month + F.make_dt_interval(half)))
    write_versioned(o, f"{root}/orders/orders", rows_per_file=VERSION_ROWS_PER_FILE, created_col="collected")
    back = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/orders/orders")
    path = F.regexp_extract(F.col("_metadata.file_path"), r"(orders/orders/.*)/[^/]*$", 1)
    return back.groupBy(path.alias("directory")).agg(F.count(F.lit(1)).alias("n")).select(
        F.regexp_extract("directory", "version=([^/]*)", 1).alias("version"), F.regexp_extract("directory", "created=([^/]*)", 1).alias("created"), "directory", "n")


@query("snk_publish_policy", """
SELECT 'replace' AS policy, 'written' AS outcome, count(*) AS nrow FROM documents
UNION ALL SELECT 'refuse', 'refused', count(*) FROM documents WHERE lang = 'en'
UNION ALL SELECT 'put', 'written', count(*) FROM documents
""")
def snk_publish_policy(spark, sf):
    d = table(spark, sf, "documents")
    root = scratch_path(spark, "policy")
    seed = d.where(F.col("lang") == "en")
    out = []
    for policy, seeded in (("replace", True), ("refuse", True), ("put", False)):
        url = f"{root}/{policy}"
        if seeded:
            write_parquet(seed, url)
        outcome, _ = publish(d, url, policy=policy)
        out.append(spark.read.parquet(url).agg(F.count(F.lit(1)).alias("nrow"))
                   .select(F.lit(policy).alias("policy"), F.lit(outcome).alias("outcome"), "nrow"))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("snk_publish_pointer", """
SELECT 'opened before' AS reader, lang, count(*) AS nrow FROM documents WHERE lang <> 'en' GROUP BY lang
UNION ALL SELECT 'opened after', lang, count(*) FROM documents GROUP BY lang
""")
def snk_publish_pointer(spark, sf):
    """SNK-3/5: a release is replaced while a reader has it open, after a writer died before it set
    the pointer; each reader sees one whole release."""
    d = table(spark, sf, "documents")
    url = scratch_path(spark, "pointer")
    publish_release(d.where("lang <> 'en'"), url)
    before = read_published(spark, url)
    write_parquet(d.where("lang = 'en'"), f"{url}/_releases/died")
    publish_release(d, url)
    after = read_published(spark, url)
    count = lambda df, name: df.groupBy("lang").agg(F.count(F.lit(1)).alias("nrow")).select(F.lit(name).alias("reader"), "lang", "nrow")
    return count(before, "opened before").unionByName(count(after, "opened after"))


DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@query("snk_write_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) AS nrow FROM documents" for c in DOC_COLUMNS))
def snk_write_profile(spark, sf):
    prof = write_profiled(table(spark, sf, "documents"), scratch_path(spark, "profile"))
    rows = [(c, prof.non_null[c], prof.nrow) for c in prof.non_null]
    return spark.createDataFrame(rows, "column string, non_null bigint, nrow bigint")


SUPPLIER_EXPORT_NAMES = {"s_suppkey": "S SuppKey", "s_name": "S-Name", "s_nationkey": "S.NationKey", "s_acctbal": "S AcctBal#"}


@query("ingest_publish_read", "SELECT * FROM supplier")
def ingest_publish_read(spark, sf):
    """SNK-5: a TSV export with unruly headers -> read as strings -> sanitise names ->
    recorded types -> publish -> register -> read back through the registry."""
    s = table(spark, sf, "supplier")
    root = scratch_path(spark, "import")
    export = s.select(*[F.col(c).alias(SUPPLIER_EXPORT_NAMES[c]) for c in s.columns])
    export.write.mode("overwrite").csv(f"{root}/dump", sep="\t", header=True)
    raw = readers.read_delimited(spark, f"{root}/dump", sep="\t", header=True)
    import_release(spark, raw, registry_root=f"{root}/registry", store_root=f"{root}/store",
                   source="suppliers", artifact="supplier", version="v2024-01",
                   created=dt.datetime(2024, 1, 1), types=s.schema)
    reg = R.load_registry(spark, f"{root}/registry")
    return R.read_release(spark, reg, "suppliers", "supplier", "latest")


DIFF_RANGES = 64


@query("cmp_release_diff", """
WITH w AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 64 AS top FROM orders),
o AS (SELECT o_orderkey FROM orders, w WHERE o_orderkey < top)
SELECT o_orderkey, 'removed' AS change FROM o WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'changed' FROM o WHERE o_orderkey % 3 = 1
UNION ALL SELECT -o_orderkey, 'added' FROM o WHERE o_orderkey % 3 = 2
""")
def cmp_release_diff(spark, sf):
    """CMP-3/4 by row: two published releases whose rows differ in one part of the keys; only the key
    ranges whose stored digests differ are read."""
    old = table(spark, sf, "orders")
    low, high = old.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    here, third = F.col("o_orderkey") < low + (high - low) // DIFF_RANGES, F.col("o_orderkey") % 3
    kept = old.where(~(here & (third == 0))).withColumn("o_totalprice", F.when(here & (third == 1), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = kept.unionByName(old.where(here & (third == 2)).withColumn("o_orderkey", -F.col("o_orderkey")))
    root = scratch_path(spark, "diff")
    cuts = CMP.key_ranges(old, "o_orderkey", DIFF_RANGES)
    CMP.write_digested(old, f"{root}/old", "o_orderkey", *cuts)
    CMP.write_digested(new, f"{root}/new", "o_orderkey", *cuts)
    return CMP.release_diff(spark, f"{root}/old", f"{root}/new", "o_orderkey")


@query("scl_release_from_filename", """
SELECT strftime(o_orderdate, '%Y-%m') AS release, count(*) AS n FROM orders GROUP BY 1
""")
def scl_release_from_filename(spark, sf):
    """SCL-6: monthly dump files ``orders_YYYY-MM.txt``; the release comes from the path."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "monthly_dumps")
    named = o.withColumn("dump", F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".txt")))
    dumps.write_delimited_dump(named, path, sep="\t", partition_by="dump")
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    rel = C.release_from_path(F.col("_metadata.file_path"), r"orders_(\d{4}-\d{2})\.txt")
    return lines.select(rel.alias("release")).groupBy("release").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- streaming snapshot (GOAL-4)


@query("goal_stream_snapshot", """
SELECT 'v' || strftime(ts, '%Y-%m-%d') AS version, count(*) AS n FROM events GROUP BY 1
""")
def goal_stream_snapshot(spark, sf):
    """GOAL-4: two passes whose files share all days; every version, read through its registry
    entry, must hold the rows of both."""
    e = table(spark, sf, "events")
    root = scratch_path(spark, "stream")
    for part in (0, 1):  # what a producer drops, and what it adds later
        e.where(F.pmod("event_id", F.lit(2)) == part).write.parquet(f"{root}/incoming/drop={part}")
        snapshot_stream(spark, f"{root}/incoming/*", e.schema, f"{root}/snapshots", f"{root}/_checkpoint",
                        registry_root=f"{root}/registry", source="events", artifact="daily")
    newest = R.latest_per_key(R.load_registry(spark, f"{root}/registry"), ["version"], ["created"])
    urls = [r["url"] for r in newest.select(F.element_at("resources", "parquet").alias("url")).collect()]  # one a day
    snaps = spark.read.option("basePath", f"{root}/snapshots").parquet(*urls)
    return snaps.groupBy(F.col("version").cast("string").alias("version")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- flagship (entry)


@query("flagship_release_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def flagship(spark, sf):
    """Minimum slice: orders -> one release (Parquet, write profile) -> registry row ->
    resolve latest -> read -> count per priority."""
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "flagship")
    last = o.agg(F.max("o_orderdate")).first()[0]
    version = "v" + last.strftime("%Y-%m")
    import_release(spark, o, registry_root=f"{root}/registry", store_root=f"{root}/store",
                   source="orders", artifact="orders", version=version, created=last, sanitize=False)
    reg = R.load_registry(spark, f"{root}/registry")
    back = R.read_release(spark, reg, "orders", "orders", "latest")
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
