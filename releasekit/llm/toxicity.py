"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every text has a set of hashed character n-grams.  From a bounded sample of labelled rows,
each n-gram gets its log-count ratio (how much more often toxic texts hold it), and a
logistic regression is fitted on the n-grams scaled by these ratios.  Scoring reads every
text whole, where it lies: nothing is shuffled.

Edge cases: a null or empty text has no n-grams and gets the score of the intercept; without
labelled rows of both kinds every score is the sample's share of toxic rows (0 if there are
none); a null label is no label, and a doc_id with several labels is toxic if one of them is.
Repeated rows are scored one by one, very long ones whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from releasekit.llm.base import free_name, query, slices, table

SIZES = (3, 4, 5)
BITS = 18
#: The model is fitted on at most this many labelled rows, of at most so many characters each
#: (longer texts are left out of the sample; they are scored like all others).
SAMPLE_ROWS, SAMPLE_CHARS = 5_000, 30_000
MIN_ROWS = 4  # an n-gram in fewer sample rows gets no weight
THRESHOLD = 0.3
#: N-grams of rows that a step of the fit works on at a time.
PART = 1 << 17


def ngrams(text: str | None, seen: np.ndarray) -> np.ndarray:
    """The distinct hashed n-grams of the lower-cased text between two spaces, whole.  ``seen``
    is scratch space of ``2 ** BITS`` int32: the last place of each hash tells it apart."""
    points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = []
    h = points.copy()
    for n in range(2, SIZES[-1] + 1):
        if len(points) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) + points[n - 1:] * np.uint32(0x9E3779B1)
        if n in SIZES:
            mixed = h ^ (h >> np.uint32(15))
            mixed *= np.uint32(0x85EBCA6B)
            found.append((mixed ^ np.uint32(n * 0x27D4EB2F)) >> np.uint32(32 - BITS))
    if not text or not found:
        return np.empty(0, np.uint32)
    every = np.concatenate(found)
    places = np.arange(len(every), dtype=np.int32)
    seen[every] = places
    return every[seen[every] == places]


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, grams: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[grams].sum(dtype=np.float64) + self.intercept, -30, 30))))


def row_parts(ends: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold ``most`` (``PART``) n-grams at most, or one row; row i's end at
    ``ends[i + 1]``."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + (most or PART), "right")) - 1)
        yield at, to
        at = to


def fit(texts: list[str | None], labels: np.ndarray, ridge: float = 0.5, rounds: int = 150) -> Model:
    """Log-count ratios with add-one smoothing, then logistic regression on the scaled n-grams
    by accelerated gradient descent.  Deterministic for a given order of rows.  The driver holds
    four bytes for each n-gram of a row that has a ratio, and works on ``PART`` of them at a time."""
    labels = np.asarray(labels, float)
    size = 1 << BITS
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(size, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    seen = np.empty(size, np.int32)
    rows_of, toxic_of = np.zeros(size), np.zeros(size)
    for text, label in zip(texts, labels, strict=True):
        grams = ngrams(text, seen)
        rows_of[grams] += 1
        toxic_of[grams] += label
    p, q = (toxic_of + 1) / (labels.sum() + 2), (rows_of - toxic_of + 1) / ((1 - labels).sum() + 2)
    ratio = np.where(rows_of >= MIN_ROWS, np.log(p / q), 0.0)
    # ratios that chance explains are noise in long texts: drop those within two standard errors
    error = np.sqrt(1 / (toxic_of + 1) + 1 / (rows_of - toxic_of + 1))
    ratio[np.abs(ratio) < 2 * error] = 0.0
    # the n-grams with a ratio only, row after row in one array that is as long as the counts say
    names = np.flatnonzero(ratio)
    number = np.zeros(size, np.int32)
    number[names] = np.arange(len(names), dtype=np.int32)
    n = len(labels)
    col, ends = np.empty(int(rows_of[names].sum()), np.int32), np.zeros(n + 1, np.int64)
    for i, text in enumerate(texts):
        grams = ngrams(text, seen)
        own = number[grams[ratio[grams] != 0]]
        ends[i + 1] = ends[i] + len(own)
        col[ends[i]:ends[i + 1]] = own
    scale = ratio[names].astype(np.float32)
    parts = list(row_parts(ends))

    def by_row(x: np.ndarray) -> np.ndarray:
        """Per row, the sum of its scaled n-grams' values in ``x``."""
        x, out = x.astype(np.float32), np.empty(n)
        for p, q in parts:
            c = col[ends[p]:ends[q]]
            out[p:q] = np.bincount(np.repeat(np.arange(q - p), np.diff(ends[p:q + 1])), scale[c] * x[c], minlength=q - p)
        return out

    def by_name(x: np.ndarray) -> np.ndarray:
        """Per n-gram, the scaled sum of its rows' values in ``x``, added up in the order of rows."""
        x, out = x.astype(np.float32), np.zeros(len(names))
        for p, q in parts:
            c = col[ends[p]:ends[q]]
            np.add.at(out, c.astype(np.intp), (scale[c] * np.repeat(x[p:q], np.diff(ends[p:q + 1]))).astype(np.float64))
        return out

    w, b = np.zeros(len(names)), float(np.log(share / (1 - share)))
    # the step follows from the largest curvature, found by power iteration (with the intercept)
    at, at_b = np.ones(len(names), np.float32), 1.0
    curvature = 1.0
    for _ in range(20):
        z = by_row(at) + at_b
        g, gb = by_name(z) / n, z.mean()
        curvature = max(float(np.sqrt(g @ g + gb * gb)), 1e-9)
        at, at_b = (g / curvature).astype(np.float32), gb / curvature
    step = 1 / (0.25 * 1.1 * curvature + ridge / n)
    last, lb = w.copy(), b
    for k in range(rounds):
        mw, mb = w + k / (k + 3) * (w - last), b + k / (k + 3) * (b - lb)
        last, lb = w, b
        wrong = 1 / (1 + np.exp(-np.clip(by_row(mw) + mb, -30, 30))) - labels
        gw = by_name(wrong) / n + ridge / n * mw
        w, b = mw - step * gw, mb - step * wrong.mean()
    weights = np.zeros(size, np.float32)
    weights[names] = w * scale
    return Model(weights, b)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample: the ``rows`` labelled ids with the smallest hashes.  The sample
    of ids is bounded, so it is broadcast and only its texts move."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.where(F.length("text") <= chars).select("doc_id", "text").join(F.broadcast(known), "doc_id")
    got = texts.groupBy("doc_id").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).toPandas().sort_values("doc_id")
    return fit(list(got["text"]), got["toxic"].to_numpy(float))


def score(documents: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``documents`` with a score (0 to 1) in ``column``, which replaces one of that name."""
    schema = T.StructType([f for f in documents.schema.fields if f.name != column])
    names = schema.fieldNames()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        own, seen = shared.value, np.empty(1 << BITS, np.int32)
        for batch in slices(batches):
            cols = {n: batch.column(n) for n in names}
            cols[column] = pa.array([own.score(ngrams(t, seen)) for t in cols["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return documents.select(*names).mapInArrow(run, T.StructType(schema.fields + [T.StructField(column, T.DoubleType())]))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with their columns."""
    column = free_name(documents.columns, "toxicity")
    return score(documents, train(documents, labels), column).where(F.col(column) < threshold).drop(column)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(documents, train(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
