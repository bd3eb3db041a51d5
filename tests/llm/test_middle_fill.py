"""Fill-in-middle against a version that handles one text at a time."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from releasekit.llm import middle_fill
from releasekit.llm.middle_fill import FORMS, put_back, rearrange

PIECES = st.lists(st.sampled_from(["abc", "Z", " ", "\n", "é", "漢", "😀", "<", ">", "P", "<P>", "<S", "S>", "<M", "1", "\x00"]), max_size=25).map("".join)


def one(doc_id, text):
    """n, form, prefix_chars, middle_chars and output of one text."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in range(0, 32, 8)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    text = p + m + s
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=8), st.integers(0, 10**6))
def test_buffers_match_single_texts(texts, first):
    ids = [str(first + k) for k in range(len(texts))]
    made = rearrange(*joined(texts), middle_fill.draws(ids))
    out = [made["out"][a:b].tobytes().decode() for a, b in zip(made["limits"], made["limits"][1:])]
    want = [one(i, t) for i, t in zip(ids, texts)]
    plain = [w[1] == "plain" for w in want]
    assert [(int(n), FORMS[f], o) for n, f, o in zip(made["n"], made["form"], out)] == [(w[0], w[1], w[4]) for w in want]
    assert [(int(a), int(b)) for a, b, x in zip(made["prefix_chars"], made["middle_chars"], plain) if not x] == [w[2:4] for w in want if w[1] != "plain"]
    back, limits = put_back(*joined(out), made["form"])
    assert [back[a:b].tobytes().decode() for a, b in zip(limits, limits[1:])] == texts


def test_edge_rows(spark):
    long = "word " * 2_000_000
    given_rows = [(1, None), (2, ""), (3, "a<P>b"), (None, "one two three"), (5, "one two three"), (5, "one two three"), (6, long), (7, "Straße — 漢字 😀"), (8, "x")]
    df = spark.createDataFrame([(*r, 0) for r in given_rows], "doc_id long, text string, n long").coalesce(1)
    made = middle_fill.restore_text(middle_fill.fill_in_middle(df))
    got = sorted(map(tuple, made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()), key=str)
    assert got == sorted([(i, *one(i, t), t or "") for i, t in given_rows], key=str)
    assert middle_fill.restore_text(middle_fill.fill_in_middle(df.where("false"))).count() == 0


def test_slices_of_many_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('Wort ', id, ', ünd '), 1 + id % 400)").alias("text")).coalesce(2)
    made = middle_fill.restore_text(middle_fill.fill_in_middle(df)).join(df, "doc_id").collect()
    assert len(made) == 3000
    for r in made:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == one(r["doc_id"], r["text"]) and r["restored"] == r["text"]
