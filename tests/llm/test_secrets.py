"""Formats of credentials found bare, behind a name and in a URL; prose and everyday tokens spared."""

import random
import re

import numpy as np
import pytest

from releasekit.llm import secrets

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MADE = {"base64": lambda r: "".join(r.choices(BASE64, k=40)), "ghp": lambda r: "ghp_" + "".join(r.choices(BASE64[:62], k=36)), "sk": lambda r: "sk_live_" + "".join(r.choices(BASE64[:62], k=24))}
WORDS = "download now get look here client key host the of and in to that with this from internationalization getElementByIdAndClassName counterrevolutionary straightforwardness".split()
SPARED = ["2024-01-01T00:00:00", "2020-10-11T10:11:12Z", "/usr/local/lib/python3.13/site-packages", "00000000000000000000", "internationalization", "antidisestablishmentarianism", "================", "----------------",
          "550e8400-e29b-41d4-a716-446655440000", "x86_64-unknown-linux-gnu", "release_notes_2024_final_version", "AAAAAAAAAAAAAAAAAAAA", "1.2.3.4.5.6.7.8.9.10", "this/is/a/path/to/some/file.txt", "averyveryverylongword1", "9807915762804490", "4845-1684-1440-7329", "192.168.100.200/255"]


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.mark.parametrize("kind", MADE)
@pytest.mark.parametrize("n", [50, 450])
def test_formats_in_three_places(kind, n):
    r = random.Random(n)
    pairs = sum(secrets.pair_counts(np.frombuffer(prose(r, 400).encode(), np.uint8)) for _ in range(20))
    formats = secrets.Formats(secrets.train({"assign": [MADE[kind](r) for _ in range(n)]}), pairs)
    for text in ("look at {} here", "client_key={}", "https://host.example.com/get?client_key={}&x=1", "https://host.example.com/download/now/{}"):
        found = 0
        for _ in range(100):
            key = MADE[kind](r)
            spans = [text.format(key)[a:b] for a, k, b in secrets.scan(text.format(key), formats) if k == "format"]
            found += any(s.strip("+/") in key and len(s) >= 0.8 * len(key) or key.strip("+/") in s and len(s) <= len(key) + 12 for s in spans)
        assert found >= 90, (text, found)
    spared = [t for t in SPARED if secrets.scan(t, formats)]
    assert not spared and not secrets.scan(prose(r, 3000), formats)


def slow_learn(texts, sample):
    """Labelled values and pairs of characters, text by text and character by character."""
    values, pairs = {}, np.zeros(secrets.ALPHABET**2, np.int64)
    at = lambda b: secrets.SYMBOLS.find(chr(b)) if chr(b) in secrets.SYMBOLS else secrets.ALPHABET - 1
    for t in texts:
        for _, kind, end, value in secrets.base_spans(t or ""):
            if end - value <= secrets.LONGEST:
                values.setdefault(kind, set()).add(t[value:end])
    return {k: sorted(v, key=lambda x: (secrets._hash(x), x))[:sample] for k, v in values.items()}, pairs, at


def test_given_documents_equal_a_slow_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    learnt = secrets.learn(docs)
    labelled, _, _ = slow_learn(texts.values(), secrets.SAMPLE)
    models = secrets.train(labelled)
    assert [(m.counts, m.following, m.least) for m in learnt.models] == [(m.counts, m.following, m.least) for m in models]
    for r in secrets.scan_secrets(docs).collect():
        got, text = [tuple(s) for s in r["secret_spans"]], texts[r["doc_id"]]
        want = [(m.start(), "assign", m.end()) for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A) if len(m[2]) >= 6]
        want += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [s for s in got if s[1] != "format"] == sorted(want, key=lambda x: (x[0], secrets.KINDS.index(x[1])))
        for a, k, b in got:  # each format by itself is worth more than ordinary text to some automaton
            if k == "format":
                best = max(m.likelihood(text[a:b]) for m in learnt.models if m.likelihood(text[a:b]) >= m.least)
                assert best - secrets.plain_likelihood(text[a:b], learnt.after) >= secrets.MARGIN and not any(x < b and a < y for x, _, y in want)


def test_pairs_are_counted_over_all_texts(spark):
    texts = ["ab", "", None, "b-a", "é a"]
    learnt = secrets.learn(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    joined = "".join(t or "" for t in texts).encode()
    assert learnt.after == secrets.ordinary(secrets.pair_counts(np.frombuffer(joined, np.uint8)))
    assert secrets.learn(spark.createDataFrame([], "text string")).models == []
