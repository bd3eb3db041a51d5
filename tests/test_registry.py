"""Registry operators on the ten recorded catalog entries, plus laws on seeded data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from releasekit.operators import registry as R

# The ten entries of the published catalog (source, artifact, version, created, type, nrow).
CATALOG = [
    ("clinvar", "submission_summary", "v2020-06", "2020-06-01 00:00:00", "file", 1223610),
    ("otpev", "eva", "v20.04", "2020-04-07 00:00:00", "file", 122219),
    ("otpev", "l2g", "v20.04", "2020-04-07 00:00:00", "file", 1931303),
    ("otpev", "eva", "v20.04", "2020-04-27 00:00:00", "file", 122219),
    ("otpev", "l2g", "v20.04", "2020-04-27 00:00:00", "file", 1931303),
    ("otpev", "gwas", "v19.11", "2019-11-28 00:00:00", "file", 194170),
    ("otpev", "l2g", "v20.06", "2020-06-16 00:00:00", "file", 393232),
    ("otpev", "eva", "v20.06", "2020-06-16 00:00:00", "file", 125138),
    ("medgen", "mgrel", "v2020-06", "2020-06-01 00:00:00", "directory", 1555604),
    ("gwas_catalog", "gwas_catalog", "v2020-07-28", "2020-07-28 16:49:22.839928", "directory", 189811),
]


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(i + 1, *r) for i, r in enumerate(CATALOG)]
    df = spark.createDataFrame(rows, "n int, source string, artifact string, version string, created string, type string, nrow bigint")
    df = df.withColumn("created", F.to_timestamp_ntz("created"))
    fmt = F.array(R.format_struct(F.lit("parquet"), F.col("type"), F.lit(True)))
    reg = R.build_entries(df, source="source", artifact="artifact", version="version", created="created",
                          storage=F.lit("gcs"), scheme=F.lit("gs"), bucket=F.lit("release-bucket"),
                          root=F.lit("catalog"), formats=fmt,
                          metadata=F.create_map(F.lit("nrow"), F.col("nrow").cast("string")))
    numbered = reg.join(df.select("n", "source", "artifact", "version", "created"),
                        ["source", "artifact", "version", "created"])
    return numbered.cache()


def ids(df):
    return [r.n for r in df.collect()]


def test_find_exact_version_newest_first(catalog):
    assert ids(R.find(catalog, "otpev", "eva", "v20.04")) == [4, 2]


def test_find_latest(catalog):
    assert ids(R.find(catalog, "otpev", "eva", "latest")) == [8]


def test_find_all_versions(catalog):
    assert ids(R.find(catalog, "otpev", "l2g", None)) == [7, 5, 3]
    assert ids(R.find(catalog, "otpev", "l2g", "")) == [7, 5, 3]


def test_unknown_entry_is_empty_and_read_raises(spark, catalog):
    assert R.find(catalog, "nope", "eva", None).count() == 0
    with pytest.raises(ValueError):
        R.read_release(spark, catalog, "otpev", "eva", "v99")


def test_paths_and_urls(catalog):
    r = {x.n: x for x in R.with_paths(catalog).collect()}
    assert r[10].path == "gwas_catalog/gwas_catalog/v2020-07-28/20200728T164922/data.parquet"
    assert r[1].url == "gs://release-bucket/catalog/clinvar/submission_summary/v2020-06/20200601T000000/data.parquet"


def test_sorted_order(catalog):
    out = R.with_position(catalog).orderBy("position")
    assert ids(out) == [1, 10, 9, 2, 4, 8, 6, 3, 5, 7]


def test_latest_per_key(catalog):
    got = {(r.source, r.artifact): r.version for r in R.latest_per_key(catalog.drop("n"), ["source", "artifact"],
                                                                        ["version", "created"]).collect()}
    assert got[("otpev", "l2g")] == "v20.06" and got[("otpev", "eva")] == "v20.06"
    assert len(got) == 6


def test_latest_version_is_lexical(spark):
    df = spark.createDataFrame([("s", "a", "v9"), ("s", "a", "v10")], "source string, artifact string, version string")
    assert R.latest_version_all(df, ["source", "artifact"]).first().version == "v9"


def test_latest_version_keeps_ties(catalog):
    got = R.latest_version_all(catalog.where("artifact = 'eva' and version < 'v20.05'"), ["source", "artifact"])
    assert sorted(ids(got)) == [2, 4]


def test_default_format_first_default_else_first(spark):
    df = spark.createDataFrame([
        (1, [("csv", "file", False, None), ("json", "file", True, None), ("parquet", "directory", True, None)]),
        (2, [("csv", "file", False, None), ("json", "file", False, None)]),
        (3, []),
    ], "k int, formats array<struct<name:string,type:string,default:boolean,properties:map<string,string>>>")
    got = {r.k: (r.f.name if r.f else None) for r in df.select("k", R.default_format().alias("f")).collect()}
    assert got == {1: "json", 2: "csv", 3: None}


def test_insert_strict_raises_on_duplicate(catalog):
    base = catalog.drop("n")
    with pytest.raises(ValueError):
        R.insert_strict(base, base.limit(1))
    new = base.limit(1).withColumn("version", F.lit("v99"))
    assert R.insert_strict(base, new).count() == 11


def test_upsert_idempotent_and_remove_add_inverse(catalog):
    base = catalog.drop("n")
    new = base.where("source = 'medgen'").withColumn("metadata", F.create_map(F.lit("nrow"), F.lit("1")))
    once = R.upsert(base, new)
    twice = R.upsert(once, new)
    assert once.count() == 10 and sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    extra = base.limit(1).withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY"))
    assert R.remove(R.upsert(base, extra), extra).count() == base.count()
    assert R.removed_any(base, base.limit(1)) and not R.removed_any(base, extra)


def test_merge_counts_add(catalog):
    base = catalog.drop("n")
    assert R.merge(base, base, base.limit(3)).count() == 23


def test_exists_flag(catalog):
    base = catalog.drop("n")
    cand = base.select(*R.KEY).union(base.select(*R.KEY).withColumn("version", F.lit("v0")))
    flags = R.exists_flag(cand, base.union(base))  # duplicates in base must not multiply rows
    assert flags.count() == 20 and flags.where("present").count() == 10


def test_dedupe_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m")],
                               "k string, ord int, v string")
    got = {r.k: r.v for r in R.dedupe_last(df, ["k"], "ord").collect()}
    assert got == {"a": "y", "b": "z", None: "n"}


def test_save_load_roundtrip_and_missing(spark, catalog, scratch):
    root = scratch("reg")
    assert R.load_registry(spark, root).count() == 0
    R.save_registry(catalog.drop("n"), root)
    R.save_registry(catalog.drop("n").limit(2), root)
    assert R.load_registry(spark, root).count() == 2  # newest registry version wins


def test_read_release_uses_format_properties_and_recorded_schema(spark, scratch):
    import datetime as dt
    from pyspark.sql import types as T
    root = scratch("props")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    df.write.csv(f"{root}/data.csv", sep="|", header=True)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    one = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created"))
    reg = R.build_entries(
        one, source=F.lit("s"), artifact=F.lit("a"), version=F.lit("v1"), created="created",
        formats=F.array(R.format_struct(F.lit("csv"), F.lit("directory"), F.lit(True),
                                        F.create_map(F.lit("sep"), F.lit("|"), F.lit("header"), F.lit("true")))),
        metadata=F.create_map(F.lit("schema_json"), F.lit(schema.json())),
        resources=F.create_map(F.lit("csv"), F.lit(f"{root}/data.csv")))
    back = R.read_release(spark, reg, "s", "a", "latest")
    assert back.schema == schema and sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        R.read_release(spark, reg, "s", "a", "latest", fmt="parquet")


def test_created_defaults_to_midnight_today(spark):
    one = spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("created"))
    e = R.build_entries(one, source=F.lit("s"), artifact=F.lit("a"), version=F.lit("v1"), created="created").first()
    today = dt.datetime.now().date()
    assert e.created.time() == dt.time(0, 0) and abs((e.created.date() - today).days) <= 1
    assert e.storage == "local" and e.formats[0].name == "parquet" and e.resources["parquet"].startswith("s/a/v1/")


def test_release_registry_workflow(spark, catalog, scratch):
    from releasekit.operators.release_registry import ReleaseRegistry
    root = scratch("rr")
    reg = ReleaseRegistry(spark, root)
    assert reg.entries.count() == 0
    reg = reg.add(catalog.drop("n"))
    reg.save()
    again = ReleaseRegistry(spark, root)
    assert again.entries.count() == 10
    assert [r.created.day for r in again.find("otpev", "eva", "v20.04").collect()] == [27, 7]
    assert again.latest().count() == 6
    with pytest.raises(ValueError):
        again.add(catalog.drop("n").limit(1))
    upd = again.add(catalog.drop("n").limit(1), overwrite=True)
    assert upd.entries.count() == 10
    assert upd.remove(catalog.drop("n").where("source = 'otpev'")).entries.count() == 3
    assert "resources_parquet" in again.flat().columns


def test_import_release_is_idempotent_per_key(spark, scratch):
    import datetime as dt
    from releasekit.operators.ingest import import_release
    root = scratch("imp")
    created = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`Var ID` bigint, `Gene Symbol` string")
    for _ in range(2):
        out = import_release(spark, df, registry_root=f"{root}/reg", store_root=f"{root}/store",
                             source="clinvar", artifact="submission_summary", version="v2024-01", created=created)
    assert out["nrow"] == 2 and out["non_null"] == {"var_id": 2, "gene_symbol": 2}
    reg = R.load_registry(spark, f"{root}/reg")
    assert reg.count() == 1
    assert out["relpath"] == "clinvar/submission_summary/v2024-01/20240101T000000/data.parquet"
    back = R.read_release(spark, reg, "clinvar", "submission_summary", "v2024-01")
    assert back.columns == ["var_id", "gene_symbol"] and back.count() == 2
    refused = import_release(spark, df.limit(1), registry_root=f"{root}/reg", store_root=f"{root}/store",
                             source="clinvar", artifact="submission_summary", version="v2024-01", created=created,
                             policy="refuse")
    assert refused["outcome"] == "refused" and R.read_release(spark, R.load_registry(spark, f"{root}/reg"),
                                                              "clinvar", "submission_summary").count() == 2
