"""Substring dedup over sliding sentence spans.

A text is cut into sentences.  Every run of two or more consecutive sentences with ``MIN_WORDS``
words or more that stood in the corpus before, by document id, text (a 64-bit hash) and place, is
removed (so is one sentence alone with twice as many).  Of these runs, the shortest that starts at
each sentence and the shortest that ends at each are hashed (96 bits over their lower-cased words)
and counted: any longer repeated run is the union of those within it, so they find what all runs
would (a test compares both).  Shorter repeated runs, such as a menu, a greeting or two sentences
of a word, are left: without a least length two in five of the given documents would lose text.

A sentence ends after a full stop, question or exclamation mark or ellipsis of any script before
white space, after one of the full-width scripts at once, and at a line feed.  Words are runs
without white space; a run of a script without spaces counts as one word for each character.

Only hashes, ids and places are shuffled.  Counting sums up before the shuffle; a span that a
third of all documents hold is one row per task there, and in the join that marks its
occurrences its rows can be split.

Edge cases: null and empty texts have no spans and stay as they are; a text all of whose
sentences go becomes empty; rows with a null id come after all others; of rows with the same id
and text one stays as it is judged, and the others count as later (their runs all go), also
where the id is null; texts that share an id, or have none, are cut each by itself; long texts
are cut whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from releasekit.llm.base import free_name, in_map, key_map, query, slices, stored, table
from releasekit.llm.shingles import mix, word_hashes

MIN_WORDS = 25

_SPACE = r"[ \t-\r]"
#: Marks that end a sentence before white space (Latin, Greek, Armenian, Arabic, Devanagari, Ethiopic,
#: Khmer, Tibetan ...), and those of full-width scripts, which need none.
_STOPS, _WIDE = ".!?…;\u0589\u061f\u06d4\u0964\u0965\u1362\u1367\u17d4\u17d5\u0f0d\u0f0e".replace(";", "\u037e"), "\u3002\uff01\uff1f\uff0e\uff61"
_QUOTES = "\"'”’»)\\]」』）"
_END = re.compile(rf"(?<=[{_STOPS}]){_SPACE}+|(?<=[{_STOPS}][{_QUOTES}]){_SPACE}+|(?<=[{_WIDE}]){_SPACE}*(?![{_WIDE}{_QUOTES}])|\n{_SPACE}*")
#: Characters of scripts that are written without spaces.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def n_words(text: str) -> int:
    """Words of a text: each character of a script without spaces, else runs without white space."""
    return len(_UNSPACED.sub(" x ", text).split()) if _UNSPACED.search(text) else len(text.split())


def sentences(text: str) -> list[tuple[int, int]]:
    """``(start, end)`` of each sentence, with the white space after it."""
    cuts = [0, *dict.fromkeys(m.end() for m in _END.finditer(text)), len(text)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def spans(counts: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of each span, from the sentences' numbers of words: for each
    sentence the shortest span that starts there and the shortest that ends there, ordered."""
    n = len(counts)
    total = np.concatenate([[0], np.cumsum(counts)])
    at, alone = np.arange(n), counts >= 2 * min_words
    last = np.searchsorted(total, total[:-1] + min_words, "left") - 1  # where the words are enough
    last = np.where((last == at) & ~alone, at + 1, last)
    first = np.searchsorted(total, total[1:] - min_words, "right") - 1
    first = np.where((first == at) & ~alone, at - 1, first)
    ahead, back = last < n, first >= 0
    code = np.unique(np.concatenate([at[ahead] * n + last[ahead], first[back] * n + at[back]]))
    return code // max(n, 1), code % max(n, 1)


_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        size = 1 << max(12, int(n).bit_length())
        _TABLES[base] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64), dtype=np.uint64)]) for x in (base, pow(base, -1, 1 << 64)))
    return _TABLES[base]


def text_spans(text: str, found: list[tuple[int, int]], min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, last sentence and two hashes (64 and 32 bits) of each span.  A hash is a
    polynomial of the words' hashes, from prefix sums over the text."""
    counts = np.array([len(text[a:b].encode("utf-8", "surrogatepass").split()) for a, b in found], np.int64)
    sizes = np.array([n_words(text[a:b]) for a, b in found], np.int64) if _UNSPACED.search(text) else counts
    first, last = spans(sizes, min_words)
    if not len(first):
        return first, last, np.empty(0, np.int64), np.empty(0, np.int32)
    words = word_hashes(text)
    if len(words) != counts.sum():  # a sentence ended within a run of characters
        words = np.concatenate([word_hashes(text[a:b]) for a, b in found])
    n, place = len(words), np.concatenate([[0], np.cumsum(counts)])
    a, b = place[first], place[last + 1]
    hashes = []
    for base in _BASES:
        up, down = _powers(base, n)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n], dtype=np.uint64)])
        hashes.append(mix((prefix[b] - prefix[a]) * down[a] + (b - a).astype(np.uint64)))
    return first, last, hashes[0].view(np.int64), (hashes[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _spans_of(documents: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, text_hash, place`` (first sentence), ``h, g`` of all spans."""
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            ids, keys, texts = batch.column("doc_id"), batch.column("text_hash"), batch.column("text").to_pylist()
            rows, places, hs, gs = [], [], [], []
            for k, text in enumerate(texts):
                if text:
                    first, _, h, g = text_spans(text, sentences(text), min_words)
                    rows.append(np.full(len(first), k))
                    places.append(first)
                    hs.append(h)
                    gs.append(g)
            if rows:
                of = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(of), keys.take(of), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(hs)), pa.array(np.concatenate(gs))],
                    names=["doc_id", "text_hash", "place", "h", "g"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, place int, h long, g int")


def repeated_spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, repeated``: per document its spans that stood in the corpus before
    (first sentence and hash), and the ids of the documents that hold each first."""
    found = stored(_spans_of(documents, min_words), "spans")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "place")
    many = found.groupBy("h", "g").agg(F.min(order).alias("origin"), F.count("*").alias("n")).where("n > 1").select("h", "g", "origin")
    many = stored(many, "many")  # a table, not an aggregation in the join's stage: so a hot span's rows can be split there
    later = found.join(many, ["h", "g"]).where(order > F.col("origin"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "h", F.col("origin.doc_id").alias("origin"))).alias("repeated"))


def _with_later(documents: DataFrame, name: str) -> DataFrame:
    """``documents`` with ``name``: whether a row has the id and text of one before it.  Rows that may
    be such are stored once, with a number; the others stay at the scan."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), "text")
    again = documents.where("text <> ''").groupBy(key.alias("__key")).agg(F.count("*").alias("n")).where("n > 1").select("__key")
    again = stored(again, "again")
    if again.isEmpty():
        return documents.withColumn(name, F.lit(False))
    marked = in_map(documents.withColumn("__key", key), F.col("__key"), key_map(again, F.col("__key")), "__maybe")
    some = stored(marked.where("__maybe").drop("__maybe").withColumn("__row", F.monotonically_increasing_id()), "again")
    first = some.groupBy("__key").agg(F.min("__row").alias("__first"))
    judged = some.join(first, "__key").join(again.withColumn("__of", F.lit(True)), "__key", "left")
    judged = judged.withColumn(name, F.coalesce(F.col("__of"), F.lit(False)) & (F.col("__row") > F.col("__first")))
    return marked.where("NOT __maybe").withColumn(name, F.lit(False)).select(*documents.columns, name).unionByName(judged.select(*documents.columns, name))


def remove_repeats(documents: DataFrame, min_words: int = MIN_WORDS, report: bool = False) -> DataFrame:
    """``documents`` without the sentences of repeated spans (``n_chars``, where there is one, is
    counted anew); or, as a report, one row per removed stretch: ``doc_id, first_sentence,
    last_sentence, start, end`` (code points), ``n_words, origin_id, text``."""
    mark, marked_id, marked_hash = (free_name(documents.columns, n) for n in ("repeated", "marked_id", "marked_hash"))
    marked = stored(repeated_spans(documents, min_words), "repeats").select(F.col("doc_id").alias(marked_id), F.col("text_hash").alias(marked_hash), F.col("repeated").alias(mark))
    names, schema = documents.columns, documents.schema
    later = free_name(names, "later")
    documents = _with_later(documents, later)
    # ids are compared as numbers; a null id meets a null id
    own = F.col("doc_id").cast("long").eqNullSafe(F.col(marked_id)) & (F.xxhash64("text") == F.col(marked_hash))
    joined = documents.join(marked, own, "left").drop(marked_id, marked_hash)
    if report:
        joined = joined.where(F.col(mark).isNotNull() | F.col(later))

    def stretches(text: str, repeated: list[dict] | None, again: bool, own_id: int | None) -> Iterator[tuple[int, int, int, int, int]]:
        """Sentences from and to, code points from and to, and the origin of each stretch; all spans
        of a later row of the same id and text."""
        cut = sentences(text)
        first, last, h, _ = text_spans(text, cut, min_words)
        ends = dict(zip(zip(first.tolist(), h.tolist()), last.tolist()))
        origins = {(r["place"], r["h"]): r["origin"] for r in repeated or ()}
        known = [(p, end, origins.get((p, x), own_id)) for (p, x), end in ends.items() if again or (p, x) in origins]  # no other text's spans
        now = None
        for a, end, origin in sorted(known, key=lambda x: x[:2]):
            if now and a <= now[1] + 1 and (a <= now[1] or origin == now[2]):
                now[1] = max(now[1], end)
            else:
                if now:
                    yield now[0], now[1], cut[now[0]][0], cut[now[1]][1], now[2]
                now = [a, end, origin]
        if now:
            yield now[0], now[1], cut[now[0]][0], cut[now[1]][1], now[2]

    def remove(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in slices(batches):
            cols = {n: batch.column(n) for n in names}
            marks, agains, texts = batch.column(mark).to_pylist(), batch.column(later).to_pylist(), cols["text"].to_pylist()
            for k, (r, again) in enumerate(zip(marks, agains, strict=True)):
                if (r or again) and texts[k]:
                    out, at = [], 0
                    for _, _, a, b, _ in stretches(texts[k], r, again, None):
                        out.append(texts[k][at:a])
                        at = b
                    texts[k] = "".join(out) + texts[k][at:]
            cols["text"] = pa.array(texts, cols["text"].type)
            if "n_chars" in cols:
                cols["n_chars"] = pc.if_else(pa.array([bool(r or x) for r, x in zip(marks, agains)]), pc.utf8_length(cols["text"]).cast(cols["n_chars"].type), cols["n_chars"])
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    def rows(batches):
        import pyarrow as pa

        kinds = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("first_sentence", "last_sentence", "start", "end", "n_words", "origin_id")), ("text", pa.string())])
        for batch in slices(batches):
            out = []
            for i, text, r, again in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", mark, later)), strict=True):
                for p, q, a, b, origin in stretches(text or "", r, again, i):
                    out.append((i, p, q, a, b, len(text[a:b].encode("utf-8", "surrogatepass").split()), origin, text[a:b]))
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, x)) for x in out], schema=kinds)

    if report:
        return joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark, later).mapInArrow(
            rows, "doc_id long, first_sentence long, last_sentence long, start long, end long, n_words long, origin_id long, text string")
    return joined.select(*names, mark, later).mapInArrow(remove, schema)


@query("op4_sentence_dedup")
def op4_sentence_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), report=True).drop("text")
