"""Secret scan with inferred credential grammars.

Three base patterns find credentials of known shape and label them.  From a bounded sample
of those labelled values, one probabilistic automaton per kind is inferred: the values form
a prefix tree with counts, and states whose continuations are statistically compatible
(Hoeffding bound, ALERGIA's test) are merged.  Every other token of 16 credential characters or
more is then scored by its mean log-likelihood under each automaton.  One is reported as kind
``format`` if it is as likely as labelled values are, and likelier than as ordinary text: than
under pairs of characters counted over the whole corpus, than under a code that learns the
token's own characters (dates repeat few), and than as a number.  So keys of random characters are found
though each has no more likelihood than chance gives it.  A token is cut at ``=`` and scored whole
and between its slashes, so a key is found behind a name or in a path, too.

One pass over the corpus gives labelled values (the ``sample`` with the smallest hashes of a kind,
up to ``LONGEST`` characters) and pairs of characters; a second one scans.

Edge cases: a null text counts as empty; rows with a null id or repeated ids are scanned one
by one (nothing is joined); a corpus without labelled values has no automata and only base
spans; very long texts are scanned whole; other columns stay untouched.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from releasekit.llm.base import query, raw_bytes, slices, stored, table

KINDS = ("assign", "access", "hex", "format")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run shorter than that is dropped, and runs are maximal
WORDS = ("password", "passwd", "secret", "token", "api")
#: Tokens that could be credentials: this long.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
LEAST = 16

#: At most this many distinct labelled values of a kind train its automaton, each up to so long.
SAMPLE, LONGEST = 500, 200
#: Confidence of the compatibility test, and the quantile of labelled values that still passes.
ALPHA, QUANTILE = 0.05, 0.02
#: Values below which a state says little of its distribution.
FEW = 10
#: Weight of the symbols of all states in each state.
PRIOR = 2.0
#: Bits by which a character of a format must be likelier than as ordinary text, on average.
MARGIN = 0.05
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
MARKS = "+/_.=-"
ALPHABET = len(SYMBOLS) + 1  # the credential characters and the end of the value
_CLASS = np.full(256, ALPHABET - 1, np.int64)
_CLASS[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))

Span = tuple[int, str, int]  # start, kind, end


def base_spans(text: str) -> list[tuple[int, str, int, int]]:
    """``(start, kind, end, start of the credential itself)`` of the base patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), "hex", m.end(), m.start()) for m in HEX.finditer(text)]
    return out


class Automaton:
    """Probabilistic deterministic automaton: per state the counts of next symbols (``""``:
    the end) and the next states."""

    def __init__(self, counts: list[dict[str, int]], following: list[dict[str, int]]):
        self.counts, self.following, self.least = counts, following, 0.0
        self.total = [sum(c.values()) for c in counts]
        #: where an unseen symbol leads: the state that most values go on to
        self.usual = [f[max(f, key=lambda x: (c.get(x, 0), x))] if f else k for k, (c, f) in enumerate(zip(counts, following, strict=True))]
        every: dict[str, int] = {}
        for c in counts:
            for symbol, n in c.items():
                every[symbol] = every.get(symbol, 0) + n
        whole = sum(every.values())
        self.chance = {symbol: (every.get(symbol, 0) + 0.5) / (whole + 0.5 * ALPHABET) for symbol in (*SYMBOLS, "")}

    def likelihood(self, value: str) -> float:
        """Mean log2 likelihood of a symbol.  A state's counts are smoothed by those of all states."""
        state, bits = 0, 0.0
        for symbol in (*value, ""):
            bits += math.log2((self.counts[state].get(symbol, 0) + PRIOR * self.chance.get(symbol, 1e-6)) / (self.total[state] + PRIOR))
            state = self.following[state].get(symbol, self.usual[state])
        return bits / (len(value) + 1)


def infer(values: Sequence[str], alpha: float = ALPHA) -> Automaton:
    """Prefix tree of ``values``, merged breadth first: each new state joins, with its
    subtree, the compatible kept state whose next symbols are distributed most alike, or else is
    kept.  A state with under ``FEW`` values is compatible with many and tells little: it joins
    the one with the most different symbols."""
    counts: list[dict[str, int]] = [{}]
    following: list[dict[str, int]] = [{}]
    for value in values:
        state = 0
        for symbol in (*value, ""):
            counts[state][symbol] = counts[state].get(symbol, 0) + 1
            if symbol:
                if symbol not in following[state]:
                    following[state][symbol] = len(counts)
                    counts.append({})
                    following.append({})
                state = following[state][symbol]
    slack = math.sqrt(0.5 * math.log(2 / alpha))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = sum(counts[a].values()), sum(counts[b].values())
            if not n or not m:
                continue
            bound = slack * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if any(abs(counts[a].get(s, 0) / n - counts[b].get(s, 0) / m) > bound for s in counts[a].keys() | counts[b].keys()):
                return False
            todo += [(following[a][s], following[b][s]) for s in following[b] if s in following[a]]
        return True

    def apart(a: int, b: int) -> float:
        n, m = sum(counts[a].values()) or 1, sum(counts[b].values()) or 1
        return max((abs(counts[a].get(s, 0) / n - counts[b].get(s, 0) / m) for s in counts[a].keys() | counts[b].keys()), default=0.0)

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for s, n in counts[b].items():
                counts[a][s] = counts[a].get(s, 0) + n
            for s, child in following[b].items():
                if s in following[a]:
                    todo.append((following[a][s], child))
                else:
                    following[a][s] = child

    kept = [0]
    frontier = [(0, s) for s in sorted(following[0])]
    at = 0
    while at < len(frontier):
        parent, symbol = frontier[at]
        at += 1
        new = following[parent][symbol]
        if new in kept:
            continue
        few = sum(counts[new].values()) < FEW
        match = min((k for k in kept if compatible(k, new)), key=lambda k: -len(counts[k]) if few else apart(k, new), default=None)
        if match is None:
            kept.append(new)
            frontier += [(new, s) for s in sorted(following[new])]
        else:
            before = set(following[match])
            following[parent][symbol] = match
            fold(match, new)
            frontier += [(match, s) for s in sorted(set(following[match]) - before)]
    at_new = {old: k for k, old in enumerate(kept)}
    return Automaton([counts[k] for k in kept], [{s: at_new[t] for s, t in following[k].items() if t in at_new} for k in kept])


def train(labelled: dict[str, Sequence[str]], quantile: float = QUANTILE) -> list[Automaton]:
    """One automaton per kind with at least 8 values, with the least likelihood it accepts: the
    given quantile over every fifth value, which its automaton for calibration hasn't seen."""
    out = []
    for _, values in sorted(labelled.items()):
        if len(values) >= 8:
            held = values[::5]
            seen = infer([v for k, v in enumerate(values) if k % 5])
            scores = sorted(seen.likelihood(v) for v in held)
            model = infer(values)
            model.least = scores[int(quantile * len(scores))] - 0.1
            out.append(model)
    return out


def pair_counts(buffer: np.ndarray) -> np.ndarray:
    """How often each symbol (the last: any other byte) follows each in the bytes of texts."""
    at = _CLASS[buffer]
    return np.bincount(at[:-1] * ALPHABET + at[1:], minlength=ALPHABET**2) if len(at) else np.zeros(ALPHABET**2, np.int64)


def ordinary(pairs: np.ndarray) -> list[list[float]]:
    """log2 likelihoods of a symbol after each, from their counts in the corpus."""
    counts = pairs.reshape(ALPHABET, ALPHABET) + 0.5
    return np.log2(counts / counts.sum(axis=1, keepdims=True)).tolist()


def plain_likelihood(value: str, after: list[list[float]]) -> float:
    """Mean log2 likelihood of a symbol as ordinary text: the highest of that by pairs of the corpus,
    that of a code that starts with equal chances and learns the value's own symbols, and, of
    digits and marks only, that of a number."""
    last, by_pairs, own, seen = ALPHABET - 1, 0.0, 0.0, {}
    for n, symbol in enumerate((*value, "")):
        k = SYMBOLS.index(symbol) if symbol else ALPHABET - 1
        by_pairs += after[last][k]
        own += math.log2((seen.get(k, 0) + 0.5) / (n + 0.5 * ALPHABET))
        seen[k] = seen.get(k, 0) + 1
        last = k
    number = -math.log2(10 + len(MARKS)) * len(value) if not value.strip("0123456789" + MARKS) else -math.inf
    return max(by_pairs, own, number) / (len(value) + 1)


class Formats:
    """Automata, and what they are compared with."""

    def __init__(self, models: Sequence[Automaton] = (), pairs: np.ndarray | None = None):
        self.models = list(models)
        self.after = ordinary(np.zeros(ALPHABET**2, np.int64) if pairs is None else pairs)

    def gain(self, value: str) -> float:
        """Bits that the best automaton which accepts ``value`` saves against ordinary text; 0 if none
        saves ``MARGIN`` a symbol."""
        best = max((x for x, model in ((m.likelihood(value), m) for m in self.models) if x >= model.least), default=None)
        saved = -1.0 if best is None else best - plain_likelihood(value, self.after)
        return saved * (len(value) + 1) if saved >= MARGIN else 0.0

    def _saved(self, piece: str) -> float:
        """Bits saved by a piece of a value, whatever an automaton accepts."""
        return (max(m.likelihood(piece) for m in self.models) - plain_likelihood(piece, self.after)) * (len(piece) + 1)

    def credentials(self, token: str) -> Iterator[tuple[int, int]]:
        """Places of credentials in a token: cut at ``=``; of each part the whole, the run of pieces
        between slashes that saves most together, or single pieces."""
        for part in re.finditer(r"[^=]+", token):
            whole = _stripped(token, part.start(), part.end())
            if whole is None:
                continue
            if "/" not in part[0]:
                if self.gain(token[whole[0]:whole[1]]):
                    yield whole
                continue
            pieces = [(part.start() + m.start(), part.start() + m.end()) for m in re.finditer(r"[^/]+", part[0])]
            best, run, total = (0.0, 0, -1), 0, 0.0
            for k, (a, b) in enumerate(pieces):
                if total <= 0:
                    run, total = k, 0.0
                total += self._saved(token[a:b])
                best = max(best, (total, run, k))
            most = _stripped(token, pieces[best[1]][0], pieces[best[2]][1]) if best[0] > 0 else None
            gain, place = self.gain(token[whole[0]:whole[1]]), whole
            if most and 4 * (less := self.gain(token[most[0]:most[1]])) > 3 * gain:  # what stands around it is mostly path
                gain, place = less, most
            singles = [(self.gain(token[a:b]), (a, b)) for x in pieces if (p := _stripped(token, *x)) for a, b in (p,)]
            if gain and gain >= max((g for g, _ in singles), default=0.0):
                yield place
            else:
                yield from (p for g, p in singles if g)


def _stripped(token: str, start: int, end: int) -> tuple[int, int] | None:
    """A part of a token without marks around it, if it is long enough."""
    inner = token[start:end].strip(".-/_+")
    start += token[start:end].index(inner) if inner else 0
    return (start, start + len(inner)) if len(inner) >= LEAST else None


def scan(text: str | None, formats: Formats | Sequence[Automaton]) -> list[Span]:
    """All spans of a text by start, then kind as listed; ``format`` spans touch no base span."""
    if not text:
        return []
    formats = formats if isinstance(formats, Formats) else Formats(formats)
    spans = [(s, k, e) for s, k, e, _ in base_spans(text)]
    taken = sorted((s, e) for s, _, e in spans)
    last = 0  # the base spans' furthest end so far, so that one look-up by start is enough
    ends = [last := max(last, e) for _, e in taken]
    starts = [s for s, _ in taken]
    for m in TOKEN.finditer(text) if formats.models else ():
        for start, end in formats.credentials(m[0]):
            start, end = start + m.start(), end + m.start()
            k = bisect.bisect_left(starts, end)
            if not k or ends[k - 1] <= start:
                spans.append((start, "format", end))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1])))


def learn(documents: DataFrame, sample: int = SAMPLE) -> Formats:
    """One pass over all texts: each task gives, of every base kind, its ``sample`` values with the
    smallest hashes, and its counts of pairs; those of the corpus are picked and summed from these.
    The sample does not depend on how the rows are dealt out."""
    def run(batches):
        import pyarrow as pa

        held: dict[str, dict[str, int]] = {k: {} for k in KINDS[:3]}
        pairs = np.zeros(ALPHABET**2, np.int64)
        for batch in slices(batches):
            buffer, limits = raw_bytes(batch.column("text"))
            pairs += pair_counts(buffer)
            for text in batch.column("text").to_pylist():
                for _, kind, end, value in base_spans(text) if text else ():
                    if end - value <= LONGEST:
                        held[kind].setdefault(text[value:end], _hash(text[value:end]))
            for kind, values in held.items():
                if len(values) > 4 * sample:
                    held[kind] = dict(sorted(values.items(), key=lambda x: (x[1], x[0]))[:sample])
        rows = [(kind, v, h, 0) for kind, values in held.items() for v, h in sorted(values.items(), key=lambda x: (x[1], x[0]))[:sample]]
        rows += [("pair", None, k, n) for k, n in enumerate(pairs.tolist()) if n]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["kind", "value", "h", "n"])

    found = stored(documents.select("text").mapInArrow(run, "kind string, value string, h long, n long"), "labelled")
    rows = found.where("kind = 'pair'").groupBy("kind", F.lit(None).cast("string").alias("value"), "h").agg(F.sum("n").alias("n"))
    for kind in KINDS[:3]:
        rows = rows.unionByName(found.where(F.col("kind") == kind).select("kind", "value", "h", "n").distinct().orderBy("h", "value").limit(sample))
    labelled: dict[str, list[str]] = {}
    pairs = np.zeros(ALPHABET**2, np.int64)
    for r in rows.collect():
        if r["kind"] == "pair":
            pairs[r["h"]] = r["n"]
        else:
            labelled.setdefault(r["kind"], []).append((r["h"], r["value"]))
    return Formats(train({k: [v for _, v in sorted(x)] for k, x in labelled.items()}), pairs)


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def scan_secrets(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``documents`` with a column ``secret_spans`` (array of start, kind, end)."""
    return _with_spans(documents, learn(documents, sample), redact=False)


def redact_secrets(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``documents`` with every span replaced by ``[kind]``; overlapping spans are one.  Keeps
    all rows and columns; ``n_chars``, where there is one, is counted anew."""
    return _with_spans(documents, learn(documents, sample), redact=True)


def redacted(text: str, spans: Sequence[Span]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _with_spans(documents: DataFrame, formats: Formats, redact: bool) -> DataFrame:
    from pyspark.sql import types as T

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())])
    schema = T.StructType([f for f in documents.schema.fields if redact or f.name != "secret_spans"])
    names = schema.fieldNames()
    if not redact:
        schema = schema.add("secret_spans", T.ArrayType(span))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in slices(batches):
            cols = {n: batch.column(n) for n in names}
            texts = cols["text"].to_pylist()
            spans = [scan(t, formats) for t in texts]
            if not redact:
                cols["secret_spans"] = pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in spans], kind)
            elif any(spans):
                cols["text"] = pa.array([redacted(t, x) if x else t for t, x in zip(texts, spans, strict=True)], cols["text"].type)
                if "n_chars" in cols:
                    cols["n_chars"] = pc.if_else(pa.array([bool(x) for x in spans]), pc.utf8_length(cols["text"]).cast(cols["n_chars"].type), cols["n_chars"])
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return documents.select(*names).mapInArrow(run, schema)


@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    spans = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    n = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", *(n(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(text(F.filter("secret_spans", lambda x: x["kind"] != "format")), 256).alias("base_sha256"),
        text(F.col("secret_spans")).alias("spans"))
