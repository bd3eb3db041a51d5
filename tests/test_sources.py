"""Readers and writers on files generated from the test tables (temp scratch dirs)."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from releasekit.sources import dumps, readers
from releasekit.sources.writers import publish, write_parquet, write_profiled, release_relpath

SF = "/root/testdata/sf0.001"


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_preamble_comment_and_skip_lines(spark, scratch):
    s = spark.read.parquet(f"{SF}/supplier.parquet")
    path = scratch("pre")
    pre = [f"## line {i}" for i in range(15)]
    dumps.write_delimited_dump(s, path, header="#" + "\t".join(s.columns), preamble=pre, compression="gzip")
    typed = readers.read_preamble_tsv(spark, path, schema=s.schema)
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, s.collect()))
    untyped = readers.read_preamble_tsv(spark, path)
    assert untyped.columns == s.columns and {f.dataType.simpleString() for f in untyped.schema} == {"string"}
    general = readers.read_skip_lines(spark, path, 16, s.schema)
    assert general.count() == s.count()


def test_skip_lines_without_marker(spark, scratch):
    d = local(scratch("plain"))
    os.makedirs(d)
    with gzip.open(f"{d}/a.txt.gz", "wt") as f:
        f.write("junk\nmore junk\n1\tx\n2\ty\n")
    with gzip.open(f"{d}/b.txt.gz", "wt") as f:
        f.write("junk\nmore junk\n3\tz\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    got = sorted(tuple(r) for r in readers.read_skip_lines(spark, d, 2, schema).collect())
    assert got == [(1, "x"), (2, "y"), (3, "z")]


def test_pipe_trailing_delimiter(spark, scratch):
    d = local(scratch("pipe"))
    os.makedirs(d)
    with open(f"{d}/map.txt", "w") as f:
        f.write("#CUI|SDUI|HpoStr|\nC1|HP:1|a|\nC2||b|\n")
    df = readers.read_trailing_delimited(spark, d)
    assert df.columns == ["CUI", "SDUI", "HpoStr"]
    assert sorted(tuple(r) for r in df.collect()) == [("C1", "HP:1", "a"), ("C2", None, "b")]


def test_repaired_header_with_swap(spark, scratch):
    d = local(scratch("named"))
    os.makedirs(d)
    with open(f"{d}/g2p.txt", "w") as f:
        f.write("#Format: gene<tab>HPO-Term-Name<tab>HPO-Term-ID\n16\tHP:0000006\tAutosomal dominant\n")
    df = readers.read_with_repaired_header(spark, d, rename={"HPO-Term-Name": "HPO-Term-ID", "HPO-Term-ID": "HPO-Term-Name"})
    r = df.first()
    assert df.columns == ["gene", "HPO-Term-ID", "HPO-Term-Name"] and r["HPO-Term-ID"] == "HP:0000006"


def test_chunks_and_completeness(spark, scratch):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    path = scratch("chunks")
    no = F.when(F.pmod("c_custkey", F.lit(4)) == 3, F.lit(5)).otherwise(F.pmod("c_custkey", F.lit(4)) + 1)
    c.withColumn("M", no).write.partitionBy("M").option("compression", "gzip").csv(path)
    assert readers.read_chunks(spark, path, c.schema).count() == c.count()
    r = readers.chunk_completeness(spark, path, r"/M=(\d+)/").first()
    assert (r.n_contiguous, r.n_found) == (3, 4)
    assert readers.require_chunks(spark, path, r"/M=(\d+)/") == 3
    with pytest.raises(ValueError):
        readers.require_chunks(spark, path, r"/X=(\d+)/")


def test_json_conflicting_types_and_broken_line(spark, scratch):
    d = local(scratch("json"))
    os.makedirs(d)
    with gzip.open(f"{d}/ev.json.gz", "wt") as f:
        f.write('{"id": 1, "v": 5}\n{"id": 2, "v": "five"}\n{"id": 3, broken\n{"id": 4, "nested": {"a": [1,2]}}\n')
    df = readers.read_json_lines(spark, d)
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema)["v"] == "string"
    assert len(readers.valid_records(df).collect()) == 3
    assert len(readers.corrupt_records(df).collect()) == 1


def test_json_documents(spark, scratch):
    d = local(scratch("terms"))
    os.makedirs(d)
    with open(f"{d}/page1.json", "w") as f:
        f.write('{"_embedded": {"terms": [{"iri": "http://x/HP_0000006", "label": "Autosomal dominant"},\n'
                '{"iri": "http://x/HP_0000007", "label": "Autosomal recessive"}]}}')
    df = readers.read_json_documents(spark, d)
    assert sorted(r.label for r in df.collect()) == ["Autosomal dominant", "Autosomal recessive"]


def test_write_profile_counts_nulls_without_second_scan(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "a int, b string")
    prof = write_profiled(df, scratch("prof"))
    assert prof.nrow == 3 and prof.non_null == {"a": 2, "b": 2}
    assert "root" in prof.schema


def test_publish_policies(spark, scratch):
    df = spark.range(10)
    url = scratch("pub")
    write_parquet(spark.range(3), url)
    assert publish(df, url, "refuse")[0] == "refused" and spark.read.parquet(url).count() == 3
    assert publish(df, url, "replace")[0] == "written" and spark.read.parquet(url).count() == 10


def test_write_parquet_fixed_partitions(spark, scratch):
    url = scratch("n4")
    write_parquet(spark.range(100), url, n_partitions=4)
    assert len([f for f in os.listdir(local(url)) if f.endswith(".parquet")]) == 4


def test_release_relpath():
    import datetime as dt
    assert release_relpath("medgen", "mgrel", "v2020-06", dt.datetime(2020, 6, 1)) == \
        "medgen/mgrel/v2020-06/20200601T000000/data.parquet"


def test_dump_files_each_start_with_head_and_hot_key_is_split(spark, scratch):
    import glob
    # one key holds most rows: it must still be spread over several files, each complete
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.lit("cold")).alias("k"),
                                     F.col("id").alias("v"))
    path = scratch("dump")
    dumps.write_delimited_dump(df, path, sep="\t", header="#v", preamble=["## a", "## b"], partition_by="k",
                               compression="gzip", n_chunks=4)
    hot = glob.glob(f"{local(path)}/k=hot/chunk=*/*.gz")
    assert len(hot) == 4
    n = 0
    for f in glob.glob(f"{local(path)}/k=*/chunk=*/*.gz"):
        with gzip.open(f, "rt") as fh:
            lines = fh.read().splitlines()
        assert lines[:3] == ["## a", "## b", "#v"]
        n += len(lines) - 3
    assert n == 3000


def test_dump_chunks_sized_per_key(spark, scratch):
    import glob
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.lit("cold")).alias("k"),
                                     F.col("id").alias("v"))
    path = scratch("dump_sized")
    dumps.write_delimited_dump(df, path, sep="\t", header="#v", partition_by="k", rows_per_file=500)
    assert len(glob.glob(f"{local(path)}/k=hot/chunk=*/*.txt")) == 4
    assert len(glob.glob(f"{local(path)}/k=cold/chunk=*/*.txt")) == 2


def test_skip_lines_across_arrow_batches(spark, scratch):
    from pyspark.sql import types as T
    d = local(scratch("plain_batches"))
    os.makedirs(d)
    with gzip.open(f"{d}/a.txt.gz", "wt") as f:
        f.write("".join(f"junk {i}\n" for i in range(5)) + "".join(f"{i}\tv{i}\n" for i in range(7)))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = sorted(tuple(r) for r in readers.read_skip_lines(spark, d, 5, schema).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(i, f"v{i}") for i in range(7)]


def test_chunks_with_embedded_line_feeds(spark, scratch):
    from pyspark.sql import types as T
    d = local(scratch("mgrel"))
    os.makedirs(d)
    with gzip.open(f"{d}/MGREL_1.csv.gz", "wt") as f:
        f.write('C1,A1,"line one\nline two",OMIM\nC2,A2,plain,HPO\n')
    with gzip.open(f"{d}/MGREL_2.csv.gz", "wt") as f:
        f.write('C3,A3,x,ORDO\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("CUI1", "AUI1", "REL", "SAB")])
    df = readers.read_chunks(spark, d, schema, multi_line=True)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("C1", "A1", "line one\nline two", "OMIM"), ("C2", "A2", "plain", "HPO"), ("C3", "A3", "x", "ORDO")]


def test_spread_after_unsplittable_read(spark, scratch):
    s = spark.read.parquet(f"{SF}/supplier.parquet")
    path = local(scratch("spread"))
    os.makedirs(path)
    with gzip.open(f"{path}/supplier.tsv.gz", "wt") as f:  # one large unsplittable file
        for r in s.collect():
            f.write("\t".join(str(v) for v in r) + "\n")
    one = readers.read_delimited(spark, path, header=False, schema=s.schema)
    many = readers.read_delimited(spark, path, header=False, schema=s.schema, spread_to=6)
    assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, s.collect()))


def test_versioned_layout_prunes_partitions(spark, scratch):
    from releasekit.functions import columns as C
    from releasekit.sources.writers import write_versioned
    o = spark.read.parquet(f"{SF}/orders.parquet").withColumn("version", C.version_from_ts("o_orderdate", "month"))
    root = scratch("versions")
    write_versioned(o, root, rows_per_file=1000)
    one = spark.read.parquet(root).where(F.col("version") == "v1998-03")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "(version" in plan
    assert one.count() == o.where(F.col("version") == "v1998-03").count()


def test_clustered_versioned_write_bounds_files(spark, scratch):
    import glob
    from releasekit.sources.writers import write_versioned
    df = spark.range(0, 4000).select(F.when(F.col("id") < 3000, F.lit("v2")).otherwise(F.lit("v1")).alias("version"),
                                     F.col("id")).repartition(8)
    plain, sized = scratch("plain"), scratch("sized")
    write_versioned(df, plain)
    write_versioned(df, sized, rows_per_file=1000)
    count = lambda root, v: len(glob.glob(f"{local(root)}/version={v}/*.parquet"))
    assert count(plain, "v2") == 8                        # one file per task per version
    # range partitions of ~rows_per_file rows: files <= partitions + versions - 1
    assert count(sized, "v2") >= 2 and count(sized, "v1") + count(sized, "v2") <= 4 + 2 - 1
    assert spark.read.parquet(sized).count() == 4000


def test_lookup_in_an_indexed_release_reads_one_row_group(spark, scratch):
    from pyspark.sql import functions as F
    from releasekit.operators import filters as FL
    from releasekit.sources.writers import write_indexed

    path = scratch("indexed")
    # every second key is missing, a third of the rows have one key
    df = spark.range(200_000).select((F.when(F.col("id") % 3 == 0, 70_000).otherwise(2 * (F.col("id") * 7919 % 100_000))).alias("k"), F.col("id").alias("v"), F.repeat(F.lit("x"), F.lit(40)).alias("t"))
    write_indexed(df, path, "k", rows_per_file=10_000, row_group_bytes=200_000)

    def read(key):
        hits = FL.point_lookup(spark.read.parquet(path), "k", key)
        n = len(hits.collect())
        plan, scanned = [hits._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            if node.nodeName().startswith("Scan parquet") or "ColumnarToRow" not in node.nodeName() and node.children().isEmpty():
                m = node.metrics().get("numOutputRows")
                scanned += m.get().value() if m.isDefined() else 0
            kids = node.children()
            plan += [kids.apply(i) for i in range(kids.size())]
        return n, scanned
    assert [p for p in [df.where("k = 13000").count()]] == [read(13_000)[0]] and 0 < read(13_000)[1] <= 10_000
    assert read(13_001) == (0, 0)  # the Bloom filter knows it is not there
