"""Lossless types, line numbers, and rows that are set aside instead of nulled."""

import gzip
import os

import pytest
from pyspark.sql import Observation, functions as F, types as T

from releasekit.functions.columns import read_as
from releasekit.operators import compare, quality
from releasekit.sources import readers


def local(path):
    return path.removeprefix("file:")


def kinds(spark, **columns):
    n = max(map(len, columns.values()))
    df = spark.createDataFrame([tuple(v[k] if k < len(v) else None for v in columns.values()) for k in range(n)], ", ".join(f"`{c}` string" for c in columns))
    out = readers.infer_types(df)
    return {f.name: f.dataType.simpleString() for f in out.schema}, out


def test_identifiers_keep_their_letters(spark):
    got, out = kinds(spark, a=["1D", "2F", "10D"], b=["007", "12"], c=["+5", "6"], d=["1", " 2"], e=["1e3", "2.5"], f=["1", "1_000"], g=["0x1F", "2"], h=["1L", "2"])
    assert got == {"a": "string", "b": "string", "c": "string", "d": "string", "e": "double", "f": "string", "g": "string", "h": "string"}
    assert [r["a"] for r in out.where("a IS NOT NULL").collect()] == ["1D", "2F", "10D"]


def test_lattice(spark):
    got, out = kinds(spark, i=["1", "-2", "0"], x=["1", "2.5"], big=["9223372036854775808", "1"], money=["1234567890123456.78", "0.5"], t=["True", "FALSE"], d=["2024-02-29", "1999-12-31"],
                     no=["2023-02-29", "2024-01-01"], ts=["2024-01-01", "2024-01-01T10:00:00"], mix=["1", "True"], wide=["1" * 30, "0." + "1" * 30], huge=["1e999", "2"], none=["NA", ""], zero=["-0.0", "1.5"])
    assert got == {"i": "bigint", "x": "double", "big": "decimal(19,0)", "money": "decimal(18,2)", "t": "boolean", "d": "date", "no": "string", "ts": "timestamp_ntz", "mix": "string",
                   "wide": "string", "huge": "string", "none": "string", "zero": "double"}
    assert [str(r["money"]) for r in out.where("money IS NOT NULL").collect()] == ["1234567890123456.78", "0.50"]


def test_every_na_token_is_null_and_a_dash_is_not(spark):
    got, out = kinds(spark, v=[*readers.NA_TOKENS, "3"], w=["-", "3"])
    assert got == {"v": "bigint", "w": "string"} and {r["v"] for r in out.collect()} == {None, 3}
    assert {"n/a", "None", "<NA>", "#N/A"} <= set(readers.NA_TOKENS)


def test_casts_that_would_lose_letters_are_violations(spark):
    df = spark.createDataFrame([("k1", "1D"), ("k2", "2"), ("k3", "nan"), ("k4", None)], "k string, v string")
    bad = quality.cast_violations(df, T.StructType([T.StructField("v", T.DoubleType())]), "k").collect()
    assert [(r["key"], r["value"]) for r in bad] == [("k1", "1D")]
    union = compare.union_releases(df.select("v"), spark.createDataFrame([(1.5,)], "v double")).collect()
    assert [r["n_bad"] for r in union if r["v"] is None] == [1, 0] and [r["v"] for r in union][-1] == 1.5
    assert spark.range(1).select(read_as(F.lit("3f"), T.FloatType()).alias("x"), read_as(F.lit(" 3 "), T.LongType()).alias("y")).first().asDict() == {"x": None, "y": 3}


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])
LINES = ["1\ta\t1.5", "2\tb", "3\tc\t1\textra", '4\t"open\t2', '5\t"quoted\ttab"\t2.5', '6\t"say ""hi"""\t3', "x7\td\t1", "8\te\t1D", "9\t\t", '10\t5" pipe\t4', '11\t""\t5', '12\t"a"b\t6', '13\t""c\t7', ""]
WANT = {2: "too few fields", 3: "too many fields", 4: "bad quotes", 7: "no bigint in id", 8: "no double in v", 12: "bad quotes", 13: "bad quotes", 14: "too few fields"}


@pytest.mark.parametrize("split", [None, 64])
def test_malformed_rows_are_set_aside_with_their_lines(spark, scratch, split):
    d = local(scratch("bad"))
    os.makedirs(d)
    with gzip.open(f"{d}/a.tsv.gz", "wt") as f:
        f.write("# head\n" * 3 + "\n".join(LINES) + "\n")
    with open(f"{d}/b.tsv", "w") as f:
        f.write("# head\n" * 3 + "\n".join(LINES * 20) + "\n")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = readers.read_rescued(spark, d, SCHEMA, skip=3)
        seen = Observation()
        good = sorted(map(tuple, readers.good_rows(df, seen).collect()))
        bad = readers.quarantined(spark, df, d).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert good == sorted([(1, "a", 1.5), (5, "quoted\ttab", 2.5), (6, 'say "hi"', 3.0), (9, None, None), (10, '5" pipe', 4.0), (11, None, 5.0)] * 21)
    assert seen.get == {"n_read": 21 * len(LINES), "n_bad": len(bad)}
    want = {(f, 3 + 14 * k + n): why for f, times in (("a.tsv.gz", 1), ("b.tsv", 20)) for k in range(times) for n, why in WANT.items()}
    assert {(r["file"].rsplit("/", 1)[1], r["line"]): r["fault"] for r in bad} == want
    assert all(r["text"] == LINES[(r["line"] - 4) % 14] for r in bad)


def test_leading_lines_longer_than_a_split(spark, scratch):
    d = local(scratch("long_head"))
    os.makedirs(d)
    for k in range(3):
        with open(f"{d}/{k}.txt", "w") as f:
            f.write("".join(f"preamble line {i} {'x' * 40}\n" for i in range(20)) + "".join(f"{k}\t{i}\n" for i in range(100)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        got = readers.read_skip_lines(spark, d, 20, T.StructType([T.StructField("k", T.LongType()), T.StructField("i", T.LongType())])).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, got)) == [(k, i) for k in range(3) for i in range(100)]
