"""Sentence spans against all runs, sentence ends of several scripts, repeated rows."""

import re

import pytest

from releasekit.llm import sentence_dedup
from releasekit.llm.sentence_dedup import n_words, sentences


def brute(rows, least):
    """What is left of ``(doc_id, text)`` rows when every run is hashed."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, left = set(), [t for _, t in rows]
    found = {}
    for k in order:
        text = rows[k][1] or ""
        cut = sentences(text)
        gone = set()
        for a in range(len(cut)):
            for b in range(a, len(cut)):
                n = sum(n_words(text[x:y]) for x, y in cut[a:b + 1])
                if n >= least and (b > a or n >= 2 * least):
                    run = tuple(w for x, y in cut[a:b + 1] for w in re.findall(r"[^ \t-\r]+", text[x:y].lower()))
                    found.setdefault(run, (k, a))
                    if found[run] != (k, a):
                        gone |= set(range(a, b + 1))
        if gone:
            left[k] = "".join(text[x:y] for i, (x, y) in enumerate(cut) if i not in gone)
    return left


def dedup(spark, rows, least):
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, later int").repartition(3)
    got = {r["later"]: r["text"] for r in sentence_dedup.remove_repeats(df, least).collect()}
    return [got[k] for k in range(len(rows))]


def test_given_documents_equal_all_runs(spark):
    rows = [(r["doc_id"], r["text"][:4000]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    got, want = dedup(spark, rows, 25), brute(rows, 25)
    assert got == want and sum(a != b for (_, a), b in zip(rows, want)) > 3


@pytest.mark.parametrize("least", [1, 4, 9])
def test_short_runs_with_a_smaller_least_length(spark, least):
    import random

    rng = random.Random(least)
    pool = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) + rng.choice([". ", "! ", "\n", "? "]) for _ in range(14)]
    rows = [(rng.choice([None, *range(60)]) if k % 5 == 0 else 100 + k, "".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for k in range(50)]
    rows = list({(i, t): None for i, t in rows})  # rows of one id and text are another test's
    rows = [(1000 + k if i is None else i, t) for k, (i, t) in enumerate(rows)]
    ids = {}
    rows = [(ids.setdefault(i, k) and 5000 + k if i in ids and ids[i] != k else i, t) for k, (i, t) in enumerate(rows)]
    assert dedup(spark, rows, least) == brute(rows, least)


def test_sentence_ends():
    cut = lambda t: [t[a:b] for a, b in sentences(t)]
    assert cut("Der Hund und die Katze saßen im Garten. Dann kam Āb. āb ging.") == ["Der Hund und die Katze saßen im Garten. ", "Dann kam Āb. ", "āb ging."]
    assert cut("他来了。她走了！“好。”他说？\n完") == ["他来了。", "她走了！", "“好。”他说？\n", "完"]
    assert cut('He said "go." Then left… so?! Yes') == ['He said "go." ', "Then left… ", "so?! ", "Yes"]
    assert cut("पहला वाक्य। दूसरा वाक्य। ما هذا؟ نعم. 3.5 m e.g.x") == ["पहला वाक्य। ", "दूसरा वाक्य। ", "ما هذا؟ ", "نعم. ", "3.5 m e.g.x"]
    assert cut("") == [] and cut("\n\n a") == ["\n\n ", "a"]


def test_repeated_passage_without_spaces_goes(spark):
    passage = "".join(f"这是第{k}句话它说明了很多重要的事情。" for k in range(8))
    rows = [(1, passage), (2, "开头不同的一句话。" + passage), (3, passage + "结尾。")]
    assert dedup(spark, rows, 25) == [passage, "开头不同的一句话。", "结尾。"]


def test_repeated_rows_and_null_ids(spark):
    p = " ".join(f"word{k}" for k in range(30)) + ". " + " ".join(f"more{k}" for k in range(30)) + "."
    assert sorted(dedup(spark, [(7, p), (7, p), (7, p)], 25)) == ["", "", p]
    assert sorted(dedup(spark, [(None, p), (None, p)], 25)) == ["", p]
    assert dedup(spark, [(None, p), (7, p), (None, p)], 25) == ["", p, ""]
    assert sorted(map(str, dedup(spark, [(None, None), (None, None), (5, ""), (5, "")], 25))) == ["", "", "None", "None"]
    report = sentence_dedup.remove_repeats(spark.createDataFrame([(7, p), (7, p)], "doc_id long, text string"), report=True).collect()
    assert [(r["doc_id"], r["origin_id"], r["text"]) for r in report] == [(7, 7, p)]
