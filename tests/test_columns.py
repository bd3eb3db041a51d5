"""Scalar functions and schema walkers (SCL-*, PRJ-*), edge rows included."""

import pytest
from pyspark.sql import functions as F

from releasekit.functions import columns as C
from releasekit.functions.schema import (drop_empty_columns, flatten, sanitize_columns, sanitize_name,
                                         schema_rows)


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_url_tail_trailing_slash_and_query(spark):
    assert one(spark, C.url_tail("v"), "https://x.org/a/b/") == ""
    assert one(spark, C.url_tail("v"), "https://x.org/a/825?page=2") == "825?page=2"
    assert one(spark, C.url_tail("v"), None) is None


def test_nth_token_out_of_range_is_null(spark):
    assert one(spark, C.nth_token("v", "_", 1), "GCST_0001") == "GCST"
    assert one(spark, C.nth_token("v", "_", 5), "GCST_0001") is None


def test_prefix_and_curie(spark):
    assert one(spark, C.prefix("v", 5), "GCST90001") == "GCST9"
    assert one(spark, C.iri_to_curie("v"), "http://purl.obolibrary.org/obo/HP_0000006") == "HP:0000006"


def test_split_values_keeps_empty_pieces_unless_told(spark):
    assert one(spark, C.split_values("v", ";"), "RCV1;RCV2;") == ["RCV1", "RCV2", ""]
    assert one(spark, C.split_values("v", ";", drop_empty=True), "RCV1;RCV2;") == ["RCV1", "RCV2"]
    assert one(spark, C.split_values("v", ";", drop_empty=True), "") == []


def test_release_from_path(spark):
    assert one(spark, C.release_from_path("v"), "/d/submission_summary_2020-06.txt.gz") == "2020-06"
    assert one(spark, C.release_from_path("v"), "/d/submission_summary.txt.gz") is None


def test_versions_and_created(spark):
    df = spark.sql("select timestamp_ntz'2020-07-28 16:49:22.839928' as ts")
    r = df.select(C.version_from_ts("ts", "month").alias("m"), C.version_from_ts("ts", "day").alias("d"),
                  C.release_dir_ts("ts").alias("p")).first()
    assert (r.m, r.d, r.p) == ("v2020-07", "v2020-07-28", "20200728T164922")
    back = one(spark, C.created_from_version("v", "month"), "v2020-06")
    assert str(back) == "2020-06-01 00:00:00"


@pytest.mark.parametrize("raw,slug", [
    ("95% CI (TEXT)", "95_ci_text"), ("REPORTED GENE(S)", "reported_gene_s"), ("P-VALUE", "p_value"),
    ("_leading", "_leading"), ("trailing__", "trailing"), ("OR or BETA", "or_or_beta"), ("", ""),
])
def test_slugify_matches_name_sanitiser(spark, raw, slug):
    assert sanitize_name(raw) == slug
    assert one(spark, C.slugify("v"), raw) == slug


def test_sanitize_idempotent_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, `c.d#` int")
    once = sanitize_columns(df)
    assert once.columns == ["a_b", "c_d"]
    assert sanitize_columns(once).columns == once.columns
    with pytest.raises(ValueError):
        sanitize_columns(spark.createDataFrame([(1, 2)], "`A B` int, `a-b` int"))


def test_is_slug(spark):
    assert one(spark, C.is_slug("v"), "gwas_catalog") is True
    assert one(spark, C.is_slug("v"), "Customer#1") is False


def test_flatten_keeps_arrays_and_null_struct(spark):
    df = spark.createDataFrame([(1, {"a": "x", "b": {"c": 2}}, ["p"]), (2, None, [])],
                               "id int, s struct<a:string,b:struct<c:int>>, arr array<string>")
    flat = flatten(df)
    assert flat.columns == ["id", "s_a", "s_b_c", "arr"]
    rows = {r.id: r for r in flat.collect()}
    assert rows[2].s_a is None and rows[2].arr == []


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, c string")
    assert drop_empty_columns(df).columns == ["a", "c"]


def test_schema_rows_paths(spark):
    df = spark.createDataFrame([], "a struct<refs:array<struct<id:string>>>, b bigint")
    assert schema_rows(df.schema) == [("a", "struct"), ("a.refs", "array"), ("a.refs[]", "struct"),
                                      ("a.refs[].id", "string"), ("b", "bigint")]


def test_resource_path_and_url(spark):
    df = spark.sql("select 'gs' s, 'release-bucket' b, 'catalog' r, timestamp_ntz'2020-06-01 00:00:00' c")
    rel = C.resource_relpath(F.lit("clinvar"), F.lit("submission_summary"), F.lit("v2020-06"), "c", F.lit("parquet"))
    r = df.select(rel.alias("p"), C.storage_url("s", "b", "r", rel).alias("u"),
                  C.storage_url(F.lit(None).cast("string"), F.lit(None).cast("string"), "r", rel).alias("local")).first()
    assert r.p == "clinvar/submission_summary/v2020-06/20200601T000000/data.parquet"
    assert r.u == "gs://release-bucket/catalog/" + r.p
    assert r.local == "catalog/" + r.p


def test_to_flat_expands_maps_and_drops_empty(spark):
    from releasekit.functions.schema import to_flat
    df = spark.createDataFrame(
        [(1, {"parquet": "p1", "csv": None}, None), (2, {"parquet": "p2"}, None)],
        "id int, resources map<string,string>, note string")
    flat = to_flat(df)
    assert flat.columns == ["id", "resources_parquet"]
    assert sorted(tuple(r) for r in flat.collect()) == [(1, "p1"), (2, "p2")]
