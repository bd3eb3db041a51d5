"""Nothing is lost without a trace: registry entries, rows of a version, lines and values of a
dump, releases under a failed write."""

import datetime as dt
import glob

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.schema import to_flat
from releasekit.operators import filters as FL
from releasekit.operators import ontology as ON
from releasekit.operators import quality as Q
from releasekit.operators import registry as R
from releasekit.operators.ingest import import_release
from releasekit.session import path_exists
from releasekit.sources import dumps, readers
from releasekit.sources.writers import publish, write_versioned
from releasekit.streaming.snapshots import snapshot_stream

SF = "/root/testdata/sf0.001"


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def entries(spark, rows, **more):
    df = spark.createDataFrame(rows, "source string, storage string, artifact string, version string, created timestamp_ntz")
    return R.build_entries(df, source="source", storage="storage", artifact="artifact", version="version", created="created", root=F.lit("store"), **more)


ONE = ("s", "local", "a", "v1", dt.datetime(2024, 1, 1))


def test_an_empty_registry_is_a_version(spark, scratch):
    root = scratch("reg")
    R.save_registry(entries(spark, [ONE]), root)
    assert R.load_registry(spark, root).count() == 1
    R.save_registry(R.remove(R.load_registry(spark, root), entries(spark, [ONE])), root)
    assert R.load_registry(spark, root).count() == 0


def test_an_unreachable_location_raises(spark):
    with pytest.raises(Exception):
        path_exists(spark, "nosuchscheme://host/registry")
    with pytest.raises(Exception):
        R.load_registry(spark, "nosuchscheme://host/registry")
    assert path_exists(spark, "/no/such/path") is False


def test_null_and_repeated_keys(spark):
    null = ("s", None, "a", "v1", dt.datetime(2024, 1, 1))
    base, same = entries(spark, [null, ONE]), entries(spark, [null])
    with pytest.raises(ValueError, match="already exists"):
        R.insert_strict(base, same)
    assert R.upsert(base, same).count() == 2 and R.remove(base, same).count() == 1
    assert R.exists_flag(same.select(*R.KEY), base).first()["present"] is True
    for update in (R.insert_strict, R.upsert):
        with pytest.raises(ValueError, match="repeated"):
            update(base, entries(spark, [ONE[:3] + ("v9", ONE[4])] * 2))
    df = spark.createDataFrame([(None, "v1"), (None, "v2"), ("a", "v1")], "k string, version string")
    assert sorted(map(tuple, R.latest_version_all(df, ["k"]).collect()), key=str) == [("a", "v1"), (None, "v2")]


def test_entries_are_checked(spark, scratch):
    bad = [("bad slug!",) + ONE[1:], ONE[:3] + ("2024",) + ONE[4:], ONE]
    assert sorted(r["fault"] or "" for r in R.entry_faults(entries(spark, bad)).collect()) == ["", "source is no slug", "version does not begin with v"]
    with pytest.raises(ValueError, match="refused"):
        R.require_valid(entries(spark, bad))
    root = scratch("import")
    for kw in ({"source": "bad slug!", "version": "v1"}, {"source": "s", "version": "2024"}):
        with pytest.raises(ValueError):
            import_release(spark, spark.range(3), registry_root=f"{root}/reg", store_root=f"{root}/store", artifact="a", **kw)
    assert not path_exists(spark, root)


def test_find_defaults_to_latest(spark):
    reg = entries(spark, [ONE, ONE[:3] + ("v2", ONE[4])])
    assert [r["version"] for r in R.find(reg, "s", "a").collect()] == ["v2"] and R.find(reg, "s", "a", None).count() == 2


def test_positions_over_several_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    got = R.with_position(df, ["k"]).orderBy("k").collect()
    assert [r["position"] for r in got] == [r["k"] + 1 for r in got] == list(range(1, 1001))


def test_late_rows_join_their_version(spark, scratch):
    root, schema = scratch("late"), T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    for k, hours in enumerate(((1, 9), (5, 9), (23,))):  # the second pass has the same newest time
        spark.createDataFrame([(10 * k + h, dt.datetime(2024, 1, 1, h)) for h in hours], schema).write.parquet(f"{root}/in/drop={k}")
        snapshot_stream(spark, f"{root}/in/*", schema, f"{root}/out", f"{root}/ckpt", registry_root=f"{root}/reg")
        back = R.read_release(spark, R.load_registry(spark, f"{root}/reg"), "stream", "snapshot", "v2024-01-01")
        assert back.count() == (2, 4, 5)[k]
    newest = R.resolve(R.load_registry(spark, f"{root}/reg"), "stream", "snapshot", "v2024-01-01")
    assert newest["metadata"]["nrow"] == "5"


def test_rows_that_look_like_comments(spark, scratch):
    path, df = scratch("hash"), spark.createDataFrame([("1", "a"), ("#2", "b"), ("3", "NA")], "id string, v string")
    dumps.write_delimited_dump(df, path, header="#id\tv", preamble=[f"## {i}" for i in range(15)], n_chunks=1)
    got = readers.read_preamble_tsv(spark, path)
    assert got.columns == ["id", "v"] and sorted(map(tuple, got.collect())) == [("#2", "b"), ("1", "a"), ("3", "NA")]
    assert [r["v"] for r in readers.infer_types(got).orderBy("id").collect()] == ["b", "a", None]
    marked = scratch("marked")
    spark.createDataFrame([("## x\n#id\tv\n1\ta\n#2\tb",)], "value string").coalesce(1).write.text(marked)
    with pytest.raises(ValueError, match="read it by count"):
        readers.read_commented_tsv(spark, marked)


def test_inferred_types_come_from_all_rows(spark):
    df = spark.createDataFrame([("1", "1", "NA", "x")] * 50 + [("2", "2.5", "", "1")], "a string, b string, c string, d string")
    assert [f.dataType.simpleString() for f in readers.infer_types(df).schema] == ["bigint", "double", "string", "string"]


def test_documents_survive_a_dump(spark, scratch):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    d = d.unionByName(spark.createDataFrame([(-1, "a\tb"), (-2, "line\nfeed"), (-3, 'a "quote"'), (-4, None), (-5, "")], d.schema))
    path = scratch("docs")
    dumps.write_delimited_dump(d, path, header="doc_id\ttext", n_chunks=3)
    back = readers.read_delimited(spark, path, multi_line=True, recursive=True).select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in d.collect()}


def test_identical_rows_are_spread_over_files(spark, scratch):
    root = scratch("same")
    rows = spark.range(20_000).select(F.lit("v1").alias("version"), F.lit(1).alias("x"), F.create_map(F.lit("k"), F.lit("v")).alias("m"))
    write_versioned(rows, root, rows_per_file=1000)
    assert len(glob.glob(f"{local(root)}/version=v1/*.parquet")) >= 20 and spark.read.parquet(root).count() == 20_000
    write_versioned(rows.limit(5).withColumn("version", F.lit("v2")), root)  # leaves other versions alone
    assert spark.read.parquet(root).count() == 20_005


def test_a_failed_replace_leaves_the_release(spark, scratch):
    url = scratch("replace")
    assert publish(spark.range(10), url)[0] == "written"
    with pytest.raises(Exception):
        publish(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), url)
    assert spark.read.parquet(url).count() == 10
    assert publish(spark.range(4), url)[1].path == url and spark.read.parquet(url).count() == 4


def test_failed_casts_are_counted(spark, scratch):
    raw = spark.createDataFrame([("1", "NR"), ("2", "0.5"), ("x", None)], "k string, v string")
    types = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    root = scratch("casts")
    out = import_release(spark, raw, registry_root=f"{root}/reg", store_root=f"{root}/store", source="s", artifact="a", version="v1", types=types)
    assert out["bad_casts"] == {"k": 1, "v": 1} and out["nrow"] == 3
    assert R.resolve(R.load_registry(spark, f"{root}/reg"), "s", "a")["metadata"]["bad_casts.v"] == "1"
    assert sorted(map(tuple, Q.cast_violations(raw, types, "k").collect())) == [("cast:k", "x", "x"), ("cast:v", "1", "NR")]


def test_corrupt_lines_are_counted(spark, scratch):
    path = scratch("json")
    spark.createDataFrame([('{"a": 1}',), ("{broken",), ('{"a": 2}',)], "value string").write.text(path)
    seen = Observation("json")
    got = readers.valid_records(readers.read_json_lines(spark, path), count_into=seen)
    assert sorted(r["a"] for r in got.collect()) == [1, 2] and seen.get == {"n_read": 3, "n_corrupt": 1}


def test_accept_rules_in_any_case(spark):
    df = spark.createDataFrame([("Risk factor",), ("risk FACTOR",), ("Conflicting risk factor",), ("PATHOGENIC",), (None,)], "v string")
    got = [r[0] for r in df.select(FL.accept_rules("v", ["conflicting"], ["pathogenic"], ["Risk Factor"])).collect()]
    assert got == [True, True, False, True, False]


def test_descendants_of_given_roots(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("c", "a")], "parent string, child string")
    got = ON.descendants(edges, roots=spark.createDataFrame([("b",)], "t string"))
    assert sorted(map(tuple, got.collect())) == [("b", "a", 2), ("b", "c", 1)]


def test_too_many_map_keys_are_refused(spark):
    df = spark.range(50).select(F.create_map(F.col("id").cast("string"), F.lit("x")).alias("m"))
    with pytest.raises(ValueError, match="more than 10 keys"):
        to_flat(df, max_columns=10)
