"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact
weighted-shingle similarity.

1. A window of a document is laid over it for each place where it shares a shingle with an
   item: as long as the item, and shifted so that the shared shingle stands where it stands in
   the item.  (Without a shared shingle the similarity is 0.)
2. Windows and items get a SimHash of their weighted shingles: 64 bits, each the sign of a sum.
   Shingles that fewer items hold weigh more.  A sign adds up square roots of weights, so the
   cosine that the fingerprints follow is at least the share 2s / (1 + s) of a similarity s,
   however uneven the weights are.
3. Fingerprints are cut into blocks.  If two differ in at most ``RADIUS`` bits, then by the
   pigeonhole principle one block differs in at most ``RADIUS // BLOCKS``; items are entered
   under all values that near to theirs, and windows look up their own, so no pair within the
   radius is missed.  At similarity 0.8, 10 of 64 bits differ on average and more than 23
   practically never do.
4. The weighted Jaccard similarity of window and item, on multisets of shingles and in whole
   numbers, decides.

All steps are DataFrame operations.  Equal windows have equal fingerprints and are looked up
once, so a passage in a third of all documents costs one look-up.

Edge cases: null and empty texts, and texts and items with fewer words than a shingle, match
nothing; a document shorter than an item is one window; repeated items match each by itself,
repeated rows count as one document; rows that share an id, or have none, but differ in text are
judged each by its own text (a row's key is its id and a 64-bit hash of its text) and reported
once an item under their id; a null item id is reported as such.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import ascii_lower, in_map, key_map, let, query, stored, table

WORDS, PERCENT = 5, 80
BITS, BLOCKS, RADIUS = 64, 8, 23
#: Up to this many distinct benchmark shingles (16 bytes each) are broadcast, else both sides shuffle.
BROADCAST_SHINGLES = 1_000_000

SPACE = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) runs without ASCII white space."""
    trimmed = F.btrim(ascii_lower(text), F.lit(SPACE))
    return F.when(trimmed != "", F.split(trimmed, r"[ \x09-\x0D]+"))


def shingles(words: Column, size: int = WORDS) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order; null if there is none."""
    return let(words, lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))))


def fingerprint(rows: DataFrame, key: list[str]) -> DataFrame:
    """SimHash per ``key`` of rows with ``h`` (shingle hash), ``c`` (how often) and ``w`` (weight):
    bit b is set where the square roots of the weights of shingles with that bit outweigh the
    others (in thousandths, whole numbers); ``total`` sums up the weights themselves.  A key's rows
    are gathered, as many as its window or item has shingles, so that the plan holds one sum for
    all bits: with a column for each bit, the driver spends its memory on planning and compiling."""
    value = F.col("w") * F.col("c")
    root = F.coalesce(F.round(1000 * F.sqrt(value)).cast("long"), F.lit(0))
    gathered = rows.groupBy(*key).agg(F.collect_list(F.struct(F.xxhash64("h", F.lit(5)).alias("x"), root.alias("v"))).alias("__rows"), F.sum(value).alias("total"))
    # those with the bit outweigh the others where twice their sum exceeds the sum of all
    with_bit = lambda b: F.aggregate("__rows", F.lit(0).cast("long"), lambda a, r: a + r["v"] * F.getbit(r["x"], b).cast("long"))
    every = F.aggregate("__rows", F.lit(0).cast("long"), lambda a, r: a + r["v"])
    bit = lambda b: F.when(2 * with_bit(b) > F.col("__all"), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))
    return gathered.withColumn("__all", every).select(*key, "total", bits.alias("fp"))


def block_of(fp: Column, k: int) -> Column:
    width = BITS // BLOCKS
    return F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def near_values() -> list[int]:
    """Masks of up to RADIUS // BLOCKS bits of a block."""
    width, most = BITS // BLOCKS, RADIUS // BLOCKS
    return [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(width), n)]


def benchmark_shingles(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """``item, item_id, m`` (words), ``at``, ``h``, ``w``: the items' shingles in order, with weights
    of a thousand times ln(1 + items / items with the shingle)."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words"), F.xxhash64(F.col("item_id").cast("string"), "text").alias("item")).where(F.size("words") >= words).distinct()
    rows = stored(items.select("item", "item_id", F.size("words").alias("m"), F.posexplode(shingles(F.col("words"), words)).alias("at", "h")), "benchmark")
    total = rows.select("item").distinct().count()
    weight = rows.groupBy("h").agg(F.countDistinct("item").alias("df")).select("h", weight_of(F.col("df"), total).alias("w"))
    return rows.join(weight, "h").withColumn("top", weight_of(F.lit(1), total))


def weight_of(df: Column, items: int) -> Column:
    return F.round(1000 * F.log(1 + F.lit(float(items)) / df)).cast("long")


def matches(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, item_id, start`` (the window's first word), ``n_words, similarity`` of
    all windows and items of similarity ``percent`` or more."""
    entries = stored(benchmark_shingles(benchmark, words), "items")
    places = entries.select("h", "at", "m").distinct()
    small = places.count() <= BROADCAST_SHINGLES  # the rows that are broadcast; the weights are fewer
    hint = F.broadcast if small else (lambda x: x)
    weights = entries.select("h", "w").distinct()
    top = entries.select("top").first()
    top = top["top"] if top else 0

    # 1. windows
    key = ["doc_id", "text_hash"]
    documents = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    placed = documents.select(*key, F.posexplode(shingles(words_of(F.col("text")), words)).alias("place", "h"))
    hits = placed.join(hint(places), "h").select(*key, "m", (F.col("place") - F.col("at")).alias("start")).distinct()
    wanted = stored(hits.groupBy(*key).agg(F.collect_list(F.struct("start", "m")).alias("wanted")), "windows")
    own = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("id_hash") == F.col("text_hash"))
    found = documents.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("id_hash"), "text").join(wanted, own).select(*key, "wanted", shingles(words_of(F.col("text")), words).alias("all"))

    def cut(s: Column) -> Column:
        length = lambda x: F.least(x["m"] - (words - 1), F.size(s))
        at = lambda x: F.greatest(F.lit(0), F.least(x["start"], F.size(s) - length(x)))
        return F.array_distinct(F.transform(F.col("wanted"), lambda x: F.struct(at(x).alias("start"), x["m"].alias("m"), F.slice(s, at(x) + 1, length(x)).alias("s"))))

    # no filter on the shingles here: it would be pushed below the join, to all documents
    windows = found.select(*key, F.explode(let(F.col("all"), cut)).alias("x")).select(*key, "x.start", "x.m", "x.s")
    windows = stored(windows.withColumn("win", F.xxhash64("m", "s")), "cut")  # equal windows are one

    # 2. fingerprints
    distinct = windows.groupBy("win").agg(F.first("m").alias("m"), F.first("s").alias("s"))
    counted = distinct.select("win", "m", F.explode("s").alias("h")).groupBy("win", "m", "h").agg(F.count("*").alias("c"))
    counted = stored(counted.join(hint(weights), "h", "left").withColumn("w", F.coalesce("w", F.lit(top))), "counts")
    window_fp = stored(fingerprint(counted, ["win", "m"]), "prints")
    item_counts = entries.groupBy("item", "item_id", "m", "h").agg(F.count("*").alias("c"), F.first("w").alias("w"))
    item_fp = stored(fingerprint(item_counts, ["item", "item_id", "m"]), "prints")

    # 3. candidates within the radius
    masks = F.array(*(F.lit(v) for v in near_values()))
    keys = lambda fp: F.array(*(F.struct(F.lit(k).alias("block"), block_of(fp, k).alias("value")) for k in range(BLOCKS)))
    entered = item_fp.select("item", "m", F.col("fp").alias("item_fp"), F.explode(keys(F.col("fp"))).alias("k")).select(
        "item", "m", "item_fp", "k.block", F.explode(F.transform(masks, lambda v: F.col("k")["value"].bitwiseXOR(v))).alias("value"))
    looked = window_fp.select("fp", "m").distinct().select("fp", "m", F.explode(keys(F.col("fp"))).alias("k")).select("fp", "m", "k.block", "k.value")
    near = looked.join(entered, ["m", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("fp", "m", "item").distinct()
    pairs = window_fp.select("win", "m", "fp", F.col("total").alias("win_total")).join(near, ["fp", "m"]).select("win", "item", "win_total")

    # 4. exact similarity
    totals = item_fp.select("item", "item_id", F.col("total").alias("item_total"))
    common = pairs.join(counted.select("win", "h", "c", "w"), "win").join(item_counts.select("item", "h", F.col("c").alias("item_c")), ["item", "h"]).groupBy("win", "item", "win_total").agg(
        F.sum(F.least("c", "item_c") * F.col("w")).alias("common"))
    union = F.col("win_total") + F.col("item_total") - F.col("common")
    similar = common.join(totals, "item").where(100 * F.col("common") >= percent * union).select("win", "item_id", (F.col("common") / union).alias("similarity"))
    return windows.join(similar, "win").select(*key, "item_id", "start", (F.size("s") + (words - 1)).alias("n_words"), "similarity")


def contaminated(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, start`` (the window's first word), ``n_words``, ``similarity`` for each
    document and item of similarity ``percent`` or more, the most similar and then the first
    window of each."""
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", F.col("n_words").alias("n"))).alias("b")
    return matches(documents, benchmark, words, percent).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("b.start").cast("long").alias("start"), F.col("b.n").cast("long").alias("n_words"), (-F.col("b.s")).alias("similarity"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, each row judged by its own text; a null text holds
    none.  Only rows whose id and text may be among the others are moved."""
    bad = stored(matches(documents, benchmark).select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct(), "contaminated")
    key = lambda i, h: F.xxhash64(F.coalesce(F.col(i).cast("string"), F.lit("")), h)
    keyed = documents.withColumn("__hash", F.xxhash64("text"))
    marked = in_map(keyed, key("doc_id", "__hash"), key_map(bad, key("__bad_id", "__bad_hash")), "__maybe")
    met = marked.where("__maybe").join(bad, F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (F.col("__hash") == F.col("__bad_hash")), "left_anti")
    return marked.where("NOT __maybe").select(*documents.columns).unionByName(met.select(*documents.columns))


_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW.format('text')}, '[^ \\x09-\\x0D]+')"

#: The same result without fingerprints: every window compared with its item.
ORACLE = f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE len({_WORDS}) >= {WORDS}),
ish AS (SELECT item_id, len(w) AS m, pos, array_to_string(w[pos + 1:pos + {WORDS}], ' ') AS s FROM (SELECT *, unnest(range(len(w) - {WORDS - 1})) AS pos FROM items)),
weight AS (SELECT s, CAST(round(1000 * ln(1 + (SELECT count(*) FROM items)::DOUBLE / count(DISTINCT item_id))) AS BIGINT) AS w FROM ish GROUP BY s),
top AS (SELECT CAST(round(1000 * ln(1 + count(*)::DOUBLE)) AS BIGINT) AS w FROM items),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dsh AS MATERIALIZED (SELECT doc_id, place, len(w) - {WORDS - 1} AS n, array_to_string(w[place + 1:place + {WORDS}], ' ') AS s FROM (SELECT *, unnest(range(len(w) - {WORDS - 1})) AS place FROM docs)),
hit AS (SELECT DISTINCT doc_id, item_id, least(m - {WORDS - 1}, n) AS len, greatest(0, least(place - pos, n - least(m - {WORDS - 1}, n))) AS start FROM dsh JOIN ish USING (s)),
win AS (SELECT h.doc_id, h.item_id, h.start, h.len, d.s, count(*) AS c FROM hit h JOIN dsh d ON d.doc_id = h.doc_id AND d.place >= h.start AND d.place < h.start + h.len GROUP BY ALL),
item AS (SELECT item_id, s, count(*) AS c FROM ish GROUP BY ALL),
total AS (SELECT item_id, sum(c * w) AS t FROM item JOIN weight USING (s) GROUP BY item_id),
sim AS (SELECT win.doc_id, win.item_id, win.start, win.len, sum(win.c * coalesce(weight.w, (SELECT w FROM top))) AS t, sum(least(win.c, coalesce(item.c, 0)) * coalesce(weight.w, 0)) AS common
  FROM win LEFT JOIN weight USING (s) LEFT JOIN item ON item.item_id = win.item_id AND item.s = win.s GROUP BY ALL),
good AS (SELECT doc_id, item_id, start, len, common / (sim.t + total.t - common) AS similarity FROM sim JOIN total USING (item_id) WHERE 100 * common >= {PERCENT} * (sim.t + total.t - common))
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, CAST(len + {WORDS - 1} AS BIGINT) AS n_words, round(similarity, 6) AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, len) AS rn FROM good) WHERE rn = 1
"""


@query("op5_decontaminate", ORACLE)
def op5_decontaminate(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(documents, table(spark, sf_dir, "benchmark")).withColumn("similarity", F.round("similarity", 6))
