"""Collocations against a version that counts in one dictionary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from releasekit.llm import collocations

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
        w = re.findall(r"[^\x20\x09]+", piece)
        for k in (1, 2, 3):
            yield from (tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, least=10, top=2000):
    out = []
    for lang in {x if x is not None else "und" for x, _ in rows}:
        f = Counter(p for x, t in rows if (x if x is not None else "und") == lang for p in phrases(t))
        n = sum(c for p, c in f.items() if len(p) == 1)
        inner = {}
        for p, c in f.items():
            if len(p) == 3 and c >= least:
                for q in (p[:2], p[1:]):
                    inner[q] = max(inner.get(q, 0), c)
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= least and 100 * inner.get(p if len(p) == 2 else None, 0) < 50 * a:
                score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, n, -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["the", "A", "Straße", "漢字", "x-y", "ÿ", "\x1c"]) + str(k % 9) for k in range(words)]
    return [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(vocabulary[: rng.randint(2, words)]) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", ""]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("least,top", [(10, 2000), (3, 20)])
def test_against_one_dictionary(spark, least, top):
    rows = texts(least, 400, 12) + [("en", None), ("en", ""), ("en", " .. "), ("en", "same words here"), ("en", "same words here")] * 6
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "lang string, text string, a long, phrase string").repartition(5)
    got = collocations.collocations(df, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top) != []
    assert collocations.collocations(df.where("false")).count() == 0


def spilled(rows, size, pairs=None):
    """The counts of a task, from its runs."""
    c, total, parts, runs = collocations.Counter("en", pairs), Counter(), {}, 0

    def take(found):
        for part, run in zip(found[0].tolist(), found[1].to_pylist()):
            entries = [tuple(e.rsplit(b"\t", 1)) for e in run.split(b"\n")]
            words = [e[0].split(b" ") for e in entries]
            assert words == sorted(words)
            for p, n in entries:
                total[p] += int(n)
                assert parts.setdefault(tuple(p.split(b" ")[:2]), part) == part  # one partition for a prefix, in every run
    text = collocations._BREAK.join((t or "").encode() for _, t in rows).translate(collocations._TABLE) + collocations._BREAK
    for words in collocations.chunks(text, size):
        c.read(words)
        while c.trie.size > collocations.MOST_ENTRIES:
            runs += 1
            take(c.spill(c.trie.size // 2, 7))
        assert c.trie.size == sum(len(k) for k, _ in c.trie.subtree())
    if c.trie.size:
        take(c.spill(0, 7))
    return total, c.total, runs


@pytest.mark.parametrize("size", [1, 7, 100, 10**6])
def test_bursts_spills_and_chunks(monkeypatch, size):
    for name, value in (("BURST", 8), ("SHARE", 2), ("MOST_ENTRIES", 100), ("RUN_ENTRIES", 5)):
        monkeypatch.setattr(collocations, name, value)
    rows = texts(size, 120, 30)
    want = Counter(" ".join(p).encode() for _, t in rows for p in phrases(t))
    got, total, runs = spilled(rows, size)
    assert got == {p: n for p, n in want.items() if p.count(b" ") < 2}
    assert total == sum(n for p, n in want.items() if b" " not in p) and (runs > 3 or size > 1000)
    full = np.full(collocations.MAP_BITS // 8, 255, np.uint8)
    assert spilled(rows, size, full)[0] == {p: n for p, n in want.items() if p.count(b" ") == 2}
    assert not spilled(rows, size, np.zeros_like(full))[0]


def test_map_of_pairs_is_the_same_in_spark_and_numpy(spark):
    pairs = [("en", "a b"), ("en", "b a"), ("de", "Straße 漢字"), ("", "x \u00ff")] + [("fr", f"w{k} v{k * 7}") for k in range(500)]
    bits = collocations.pair_map(spark.createDataFrame(pairs, "lang string, phrase string"))
    want = set()
    for lang, p in pairs:
        a, b = (zlib.crc32(w.encode()) for w in p.split(" "))
        want |= set(collocations.pair_bits(a, b, zlib.crc32(lang.encode())))
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == want and len(bits) * 8 == collocations.MAP_BITS
    c = collocations.Counter("en", bits)
    c.read([b"a", b"b", b"a", b"b", b"c"])
    assert {k.decode(): 1 for r in c.spill(0, 1)[1].to_pylist() for k in [e.split(b"\t")[0] for e in r.split(b"\n")]} == {"a b a": 1, "b a b": 1}


def test_long_text_in_one_row(spark):
    long = "tick tock " * 600_000 + "w" * 5_000_000 + " end"
    got = {r["phrase"]: tuple(r) for r in collocations.collocations(spark.createDataFrame([("en", long)], "lang string, text string")).collect()}
    same = (599_999, 600_000, 600_000, 1_200_002, 999_996)
    assert got == {"tick tock tick": ("en", 1, "tick tock tick", *same), "tock tick tock": ("en", 2, "tock tick tock", *same)}


def test_scores_are_exact(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a = rng.randint(1, 10**rng.randint(1, 16) - 1)
        rows.append((a, rng.randint(a, 10**16 - 1), rng.randint(a, 10**16 - 1)))
    rows += [(10**16 - 1,) * 3, (3, 3, 3), (10, 10**16 - 1, 10**16 - 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", F.expr(collocations.SCORE)).collect()
    assert [x["s"] for x in got] == [1000000 * a * a // (b * c) for a, b, c in rows]
