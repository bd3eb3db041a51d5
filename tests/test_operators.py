"""Aggregations, filters, sets, quality rules, comparison and ontology operators."""

import pytest
from pyspark.sql import functions as F

from releasekit.operators import compare as CMP
from releasekit.operators import filters as FL
from releasekit.operators import ontology as ON
from releasekit.operators import quality as Q
from releasekit.operators import sets as S
from releasekit.operators import summaries as A
from releasekit.functions.schema import schema_rows


@pytest.fixture(scope="module")
def kv(spark):
    return spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), (None, "z"), ("", None)], "k string, v string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_group_count_keeps_null_group_value_counts_drop(kv):
    assert dict(A.group_count(kv, "k").collect()) == {"a": 3, "b": 1, None: 1, "": 1}
    assert dict(A.value_counts(kv, "v").collect()) == {"x": 3, "y": 1, "z": 1}


def test_multi_path_counts_equal_single_counts(kv):
    multi = {(r.path, r.value): r.n for r in A.multi_path_counts(kv, ["k", "v"]).collect()}
    for path in ("k", "v"):
        for key, n in A.group_count(kv, path).collect():
            assert multi[(path, key)] == n


def test_distinct_per_group_and_count_of_counts(kv):
    per = A.distinct_per_group(kv, "k", "v")
    assert dict(per.collect()) == {"a": 2, "b": 1, "": 0}
    assert dict(A.count_of_counts(per).collect()) == {2: 1, 1: 1, 0: 1}


def test_sorted_concat_and_dependency(spark):
    df = spark.createDataFrame([("d1", "g1", "t2"), ("d1", "g1", "t1"), ("d1", "g2", "t1"), ("d1", "g2", "t2"),
                                ("d2", "g3", "t3"), ("d2", "g3", "t3")], "a string, b string, v string")
    assert rows(A.sorted_concat(df, ["a", "b"], "v")) == [("d1", "g1", "t1,t2"), ("d1", "g2", "t1,t2"), ("d2", "g3", "t3")]
    # one bucket 1 -> 2: the value set depends on a only
    assert rows(A.dependency_check(df, "a", "b", "v")) == [(1, 2)]


def test_share_and_profile(spark, kv):
    share = {r.k: r.pct for r in A.share_of_total(A.group_count(kv, "k")).collect()}
    assert share["a"] == 50.0
    prof = {r.column: (r.type, r.non_null, r.nrow) for r in A.column_profile(kv).collect()}
    assert prof == {"k": ("string", 5, 6), "v": ("string", 5, 6)}


def test_top_k_tie_on_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 7), (4, 1)], "k int, n int")
    assert [r.k for r in A.top_k(df, "n", "k", 3).collect()] == [2, 1, 3]


def test_filters(spark):
    df = spark.createDataFrame([("Pathogenic",), ("conflicting interpretations",), ("Likely benign",),
                                ("risk factor",), (None,)], "cs string")
    rule = FL.accept_rules("cs", ["conflicting"], ["pathogenic", "protective"], ["risk factor"])
    got = {r.cs: r.ok for r in df.select("cs", rule.alias("ok")).collect()}
    assert got == {"Pathogenic": True, "conflicting interpretations": False, "Likely benign": False,
                   "risk factor": True, None: False}
    kw = df.where(FL.any_keyword("cs", ["PATHO", "risk"]))
    assert kw.count() == 2
    cls = df.select(FL.classify_keywords("cs", [("p", "path"), ("b", "benign")]).alias("c")).where("c is not null")
    assert sorted(r.c for r in cls.collect()) == ["b", "p"]
    assert df.where(FL.contains_literal("cs", "a.")).count() == 0  # literal, not a regex


def test_overlap_laws(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    b = spark.createDataFrame([(3,), (4,)], "k int")
    rep = dict(S.overlap_report(a, b, "k").collect())
    assert rep == {"both": 1, "left_only": 2, "right_only": 1}
    assert rep["both"] + rep["left_only"] == a.where("k is not null").distinct().count()
    one = a.select("k", F.lit(1).alias("t")).union(b.select("k", F.lit(2).alias("t")))
    assert dict(S.side_counts(S.overlap_sides_by(one, "k", F.col("t") == 1, F.col("t") == 2)).collect()) == rep


def test_semi_keys_with_several(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 10), (3, None), (3, 10)], "k int, n int")
    assert [r.k for r in S.keys_with_several(df, "k", "n").collect()] == [1]
    assert rows(S.keys_where(df, "k", "n", lambda c: c == 1)) == [(2,), (3,)]
    assert S.semi_join(df, S.keys_with_several(df, "k", "n"), ["k"]).count() == 2


def test_lookup_required(spark):
    df = spark.createDataFrame([("20.02",), ("20.04",)], "v string")
    lk = spark.createDataFrame([("20.04", "2020-04-07")], "v string, d string")
    got = {r.v: (r.d, r.missing) for r in S.lookup_required(df, lk, "v", "d").collect()}
    assert got == {"20.02": (None, True), "20.04": ("2020-04-07", False)}


def test_quality_rules(spark):
    df = spark.createDataFrame([("ok_slug", "v1", {"parquet": "gs://x"}), ("bad-slug", "2020", {"parquet": ""})],
                               "s string, version string, resources map<string,string>")
    v = Q.all_violations(Q.slug_violations(df, "s"), Q.version_violations(df), Q.empty_url_violations(df, key="s"))
    assert sorted(r.rule for r in v.collect()) == ["empty_url", "slug", "version"]
    with pytest.raises(ValueError):
        Q.fail(v)
    f = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "a"]), (3, [])], "k int, names array<string>")
    assert rows(Q.format_violations(f, F.col("names"), "k").select("key", "rule")) == [("2", "duplicate_format"), ("3", "no_formats")]
    cov = Q.coverage(spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int"),
                     spark.createDataFrame([(2,), (9,)], "id int"), "id").first()
    assert (cov.n_wanted, cov.n_found, cov.n_missing) == (2, 1, 1)


# Recorded schemas of the gwas 19.11 and l2g 20.06 releases.
_PROV = ("database:struct<dbxref:struct<id:string,version:string>,id:string,version:string>,"
         "expert:struct<statement:string,status:boolean>")
GWAS_1911 = (
    "access_level string, disease struct<id:string>, "
    "evidence struct<gene2variant:struct<date_asserted:string,evidence_codes:array<string>,functional_consequence:string,"
    f"is_associated:boolean,provenance_type:struct<{_PROV}>>,"
    "variant2disease:struct<confidence_interval:string,date_asserted:string,evidence_codes:array<string>,"
    "gwas_panel_resolution:bigint,gwas_sample_size:bigint,is_associated:boolean,odds_ratio:string,"
    f"provenance_type:struct<{_PROV},literature:struct<references:array<struct<lit_id:string>>>>,"
    "resource_score:struct<exponent:bigint,mantissa:bigint,method:struct<description:string>,type:string,value:double>,"
    "unique_experiment_reference:string>>, "
    "literature struct<references:array<struct<lit_id:string>>>, sourceID string, "
    "target struct<activity:string,id:string,target_type:string>, type string, "
    "unique_association_fields struct<disease_id:string,pubmed_refs:string,pvalue_annotation:string,study_name:string,target:string,variant:string>, "
    "validated_against_schema_version string, variant struct<id:string,type:string>")
_LIT = "literature:struct<references:array<struct<author:string,lit_id:string,year:bigint>>>"
L2G_2006 = (
    "access_level string, disease struct<id:string,reported_trait:string>, "
    "evidence struct<gene2variant:struct<consequence_code:string,date_asserted:string,evidence_codes:array<string>,"
    f"functional_consequence:string,is_associated:boolean,provenance_type:struct<{_PROV},{_LIT}>,"
    "resource_score:struct<method:struct<description:string>,type:string,value:double>>,"
    "variant2disease:struct<confidence_interval:string,date_asserted:string,evidence_codes:array<string>,"
    "gwas_sample_size:bigint,is_associated:boolean,odds_ratio:double,"
    f"provenance_type:struct<{_PROV},{_LIT}>,reported_trait:string,"
    "resource_score:struct<exponent:bigint,mantissa:bigint,method:struct<description:string>,type:string,value:double>,"
    "study_link:string,unique_experiment_reference:string>>, "
    "sourceID string, target struct<activity:string,id:string,target_type:string>, type string, "
    "unique_association_fields struct<disease_id:string,study:string,target:string,variant:string>, "
    "validated_against_schema_version string, variant struct<id:string,rs_id:string,source_link:string,type:string,type_link:string>")


def test_schema_diff_golden(spark):
    old = spark.createDataFrame([], GWAS_1911)
    new = spark.createDataFrame([], L2G_2006)
    assert len(schema_rows(old.schema)) == 72 and len(schema_rows(new.schema)) == 85
    d = {r.path: r.change for r in CMP.schema_diff(spark, old, new).collect()}
    changed = [p for p, c in d.items() if c == "changed"]
    removed = sorted(p for p, c in d.items() if c == "removed")
    added = [p for p, c in d.items() if c == "added"]
    assert changed == ["evidence.variant2disease.odds_ratio"]
    assert removed == sorted(["evidence.variant2disease.gwas_panel_resolution", "literature", "literature.references",
                              "literature.references[]", "literature.references[].lit_id",
                              "unique_association_fields.pubmed_refs", "unique_association_fields.pvalue_annotation",
                              "unique_association_fields.study_name"])
    assert len(added) == 21 and "variant.type_link" in added


def test_union_releases_try_cast(spark):
    old = spark.createDataFrame([(1, "2.5"), (2, "NR")], "k bigint, odds string")
    new = spark.createDataFrame([(3, 1.5, "x")], "k bigint, odds double, extra string")
    got = rows(CMP.union_releases(old, new))
    assert got == [(1, 2.5, None, 0), (2, None, None, 1), (3, 1.5, "x", 0)]


def test_release_counts_delta(spark):
    df = spark.createDataFrame([(2019,), (2020,), (2020,)], "y int")
    assert rows(CMP.release_counts(df, "y")) == [(2019, 1, None), (2020, 2, 1)]


def test_descendants_with_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "d")], "parent string, child string")
    got = {(r.ancestor, r.descendant): r.depth for r in ON.descendants(e).collect()}
    assert got[("a", "d")] == 1 and got[("b", "d")] == 2 and got[("b", "a")] == 2
    assert ("a", "a") not in got and len(got) == 9


def test_ancestor_expansion_and_entity_sources(spark):
    e = spark.createDataFrame([("R", "N"), ("N", "C")], "parent string, child string")
    ev = spark.createDataFrame([(1, "C"), (2, "N")], "ok int, term string")
    x = ON.expand_to_ancestors(ev, ON.descendants(e), "term")
    assert rows(x.groupBy("term").count()) == [("C", 1), ("N", 2), ("R", 2)]
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(ON.entity_sources({"a": a, "b": b}, "k")) == [(1, "a"), (2, "a,b")]


def test_crosswalk_keeps_sources(spark):
    classes = spark.createDataFrame([("HP:6", "dominant"), ("HP:7", "recessive")], "term string, class string")
    mapping = spark.createDataFrame([("HP:6", "C1"), ("HP:6", "C1"), ("HP:7", "C2")], "term string, concept string")
    rel = spark.createDataFrame([("D1", "C1", "OMIM"), ("D1", "C1", "HPO"), ("D2", "C2", "ORDO"), ("D3", "C9", "OMIM")],
                                "disease string, concept string, sab string")
    got = rows(ON.crosswalk(classes, mapping, rel, term="term", concept="concept", subject="disease", source="sab"))
    assert got == [("D1", "dominant", "HPO,OMIM"), ("D2", "recessive", "ORDO")]


def test_union_releases_follows_newest_type(spark):
    old = spark.createDataFrame([(1, 5)], "k bigint, n int")
    new = spark.createDataFrame([(2, "1.5")], "k bigint, n string")
    assert rows(CMP.union_releases(old, new)) == [(1, "5", 0), (2, "1.5", 0)]
    from pyspark.sql import types as T
    assert rows(CMP.union_releases(old, new, types={"n": T.DoubleType()})) == [(1, 5.0, 0), (2, 1.5, 0)]


def test_release_violations_name_the_file(spark):
    df = spark.createDataFrame([("/d/submission_summary_2020-06.txt.gz",), ("/d/submission_summary.txt.gz",)], "p string")
    v = Q.release_violations(df, "p").collect()
    assert [(r.rule, r.key) for r in v] == [("missing_release", "/d/submission_summary.txt.gz")]
    with pytest.raises(ValueError, match="submission_summary.txt.gz"):
        Q.fail(Q.release_violations(df, "p"))


def test_path_collisions_seconds_vs_microseconds(spark):
    import datetime as dt
    from releasekit.operators import registry as R
    df = spark.createDataFrame([("s", "a", "v1", dt.datetime(2020, 7, 28, 16, 49, 22, 839928)),
                                ("s", "a", "v1", dt.datetime(2020, 7, 28, 16, 49, 22, 100)),
                                ("s", "a", "v2", dt.datetime(2020, 7, 28, 16, 49, 22))],
                               "source string, artifact string, version string, created timestamp_ntz")
    reg = R.with_paths(R.build_entries(df, source="source", artifact="artifact", version="version", created="created"))
    got = Q.path_collisions(reg).collect()
    assert len(got) == 1 and got[0].n == 2 and got[0].n_keys == 2
    assert got[0].path == "s/a/v1/20200728T164922/data.parquet"


def test_approx_distinct_opt_in(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    exact = dict(A.distinct_per_group(li, "l_returnflag", "l_partkey").collect())
    approx = dict(A.distinct_per_group(li, "l_returnflag", "l_partkey", approx=0.02).collect())
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.08 * exact[k] for k in exact)
    e2 = dict(A.distinct_combinations(li, ["l_returnflag"], ["l_partkey", "l_suppkey"]).collect())
    a2 = dict(A.distinct_combinations(li, ["l_returnflag"], ["l_partkey", "l_suppkey"], approx=0.02).collect())
    assert all(abs(a2[k] - e2[k]) <= 0.08 * e2[k] for k in e2)


def test_fingerprints_tell_sets_apart_without_gathering(spark, monkeypatch):
    import random

    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.randint(0, 9), rng.choice([None, *map(str, range(3))])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, v string")
    sets = {}
    for a, b, v in rows:
        if v is not None:
            sets.setdefault((a, b), set()).add(v)
    per = {}
    for (a, _), v in sets.items():
        per.setdefault(a, set()).add(frozenset(v))
    want = {}
    for found in per.values():
        want[len(found)] = want.get(len(found), 0) + 1
    assert {r["n_signatures"]: r["n_keys"] for r in A.dependency_check(df, "a", "b", "v").collect()} == want
    # hashes that tell nothing: the second pass sees it
    plain = A.set_fingerprints
    weak = lambda df, keys, value, seed=0: plain(df, keys, value, seed=seed).withColumn("fingerprint", F.struct("fingerprint.n", F.lit(0).alias("h0"), F.lit(0).alias("h1")))
    monkeypatch.setattr(A, "set_fingerprints", lambda df, keys, value, seed=0: (weak if seed < 2 else plain)(df, keys, value, seed=seed))
    two = spark.createDataFrame([("x", 1, "p"), ("x", 2, "q")], "a string, b int, v string")
    assert [tuple(r) for r in A.dependency_check(two, "a", "b", "v").collect()] == [(2, 1)]
    assert [tuple(r) for r in A.dependency_check(two, "a", "b", "v", exact=False).collect()] == [(1, 1)]


def test_sorted_values_have_no_bound(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("x", 3), (None, 2), (None, None), ("y", None), ("z", -1), (None, 0)], "k string, v int")
    assert sorted(map(tuple, A.sorted_values(df, ["k"], "v").collect()), key=str) == sorted([("x", 1, 1), ("x", 2, 3), (None, 1, 0), (None, 2, 2), ("z", 1, -1)], key=str)
    big = spark.range(300_000).selectExpr("id % 2 AS k", "id * 7 % 300007 AS v")
    got = A.sorted_values(big, ["k"], "v").groupBy("k").agg(F.max("position"), F.count("*")).collect()
    assert sorted(map(tuple, got)) == [(0, 150_000, 150_000), (1, 150_000, 150_000)]


def test_closure_extended_by_edges_equals_a_new_one(spark):
    import random

    for seed in range(4):
        rng = random.Random(seed)
        pairs = list({(f"n{rng.randint(0, 11)}", f"n{rng.randint(0, 11)}") for _ in range(20)})
        cut = rng.randint(0, len(pairs) - 4)
        frame = lambda p: spark.createDataFrame(p, "parent string, child string")
        old, added = frame(pairs[:cut]), frame(pairs[cut:] + pairs[:2])
        got = ON.extend_closure(ON.descendants(old), added)
        assert sorted(map(tuple, got.select("ancestor", "descendant", "depth").collect())) == sorted(map(tuple, ON.descendants(frame(pairs)).collect()))
    closure = ON.descendants(frame([("a", "b")]))
    assert ON.extend_closure(closure, frame([]).where("false")).count() == 1


def test_release_diff_reads_changed_ranges_only(spark, scratch):
    old = spark.range(1000).selectExpr("id AS k", "id * 2 AS v", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS t")
    new = old.where("k <> 500").withColumn("v", F.when(F.col("k").isin(501, 502), -1).otherwise(F.col("v"))).unionByName(spark.sql("SELECT 1005L AS k, 1L AS v, 'y' AS t"))
    paths = [scratch("old"), scratch("new")]
    low, width = CMP.key_ranges(old, "k", 20)
    for df, p in zip((old, new), paths):
        CMP.write_digested(df, p, "k", low, width)
    assert sorted(r["range"] for r in CMP.changed_ranges(spark, *paths).collect()) == [10, 20]
    diff = CMP.release_diff(spark, *paths, "k")
    assert sorted(map(tuple, diff.collect())) == [(500, "removed"), (501, "changed"), (502, "changed"), (1005, "added")]
    assert len(diff.inputFiles()) < 10 or "PartitionFilters: [" in diff._jdf.queryExecution().executedPlan().toString()
    same = scratch("same")
    CMP.write_digested(old.orderBy(F.desc("k")), same, "k", low, width)
    assert CMP.release_diff(spark, paths[0], same, "k").count() == 0
    other = scratch("other")
    CMP.write_digested(old, other, "k", low, width + 1)
    with pytest.raises(ValueError):
        CMP.release_diff(spark, paths[0], other, "k")
    # repeated and null keys compare as bags
    a = spark.createDataFrame([(1, "p"), (1, "q"), (None, "z")], "k long, t string")
    b = spark.createDataFrame([(1, "q"), (1, "p"), (None, "z"), (None, "z")], "k long, t string")
    bags = [scratch("a"), scratch("b")]
    for df, p in zip((a, b), bags):
        CMP.write_digested(df, p, "k", 0, 10)
    assert [tuple(r) for r in CMP.release_diff(spark, *bags, "k").collect()] == [(None, "changed")]
