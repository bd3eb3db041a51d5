"""Quality rules: counts over words and lines, and divergence from language references.

Two histograms describe a text: its characters by class, and its words by a fixed list of
common words (all others in one bin).  The reference of a language is the mean of the
histograms of all its texts that are long enough.  A text whose Jensen-Shannon distance from
its language's reference is too large is rejected; short texts are not judged by it, as
their histograms are mostly chance.

Edge cases: a null text has no words, and all counts are 0 (it fails the minimum length); a
null language is a language of its own; a language without a long enough text has no
reference and rejects nothing; repeated rows are judged one by one; long texts are read
whole.  Other columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import let, query, stored, table

#: Common words of the reference languages.  Fixed values.
COMMON_WORDS = (
    "the of and to in a is that for with on by was it be "
    "le la les de des et en un une que est dans pour sur par "
    "der die das und zu den ist von mit nicht ein eine auf für als "
    "el los las y se del con para no una").split()
CHARACTER_CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "stop": "[.,;:]", "mark": r"[!?'\"()\[\]{}_/\\=+~^@`-]", "symbol": "[#*$%&|<>]"}
SPACE = " \t\n\x0b\f\r"

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Length from which a text is judged by its histograms, and the largest distances (0 to 1).
#: Common words need more text than characters until their shares settle.
GUARD_WORDS, MAX_CHARACTER_DISTANCE = 50, 0.29
GUARD_COMMON_WORDS, MAX_WORD_DISTANCE = 150, 0.29


def words_of(text: Column) -> Column:
    """Maximal runs without space, tab, line feed, vertical tab, form feed or return."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed != "", F.split(trimmed, r"[ \x09-\x0D]+")).otherwise(F.expr("cast(array() as array<string>)"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in windows that occur twice or more in the text, the first occurrence
    included.  Windows are compared by a 64-bit hash; texts without a repeated window, nearly
    all, are settled by one hash set, the others by sorting (hash, place)."""
    def covered(hashes: Column) -> Column:
        def places(pairs: Column) -> Column:
            same = lambda k, x: F.get(pairs, k)["h"].eqNullSafe(x["h"])
            kept = F.filter(pairs, lambda x, k: same(k - 1, x) | same(k + 1, x))
            return F.sort_array(F.transform(kept, lambda x: x["at"]))

        def total(at: Column) -> Column:
            gaps = F.transform(at, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        pairs = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return let(let(pairs, places), total)

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        settled = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
        return F.when(F.size(w) < window, F.lit(0)).otherwise(let(hashes, settled))

    return let(words, count)


def word_histogram(words: Column) -> Column:
    """Counts of COMMON_WORDS as they stand (no capitals, no stop after them), then of all other
    words.  Each common word becomes one character, and a character's count is what removing it
    takes from the length."""
    known = F.array(*(F.lit(w) for w in COMMON_WORDS))
    common = F.filter(words, lambda w: w.isin(COMMON_WORDS))
    codes = F.array_join(F.transform(common, lambda w: F.char(F.array_position(known, w) + F.lit(33))), "")

    def counts(s: Column) -> Column:
        return F.array(*(F.length(s) - F.length(F.replace(s, F.lit(chr(34 + k)), F.lit(""))) for k in range(len(COMMON_WORDS))))

    counted = let(codes, lambda s: F.array(counts(s), F.array(F.size(words) - F.length(s))))
    return F.flatten(counted)


def text_statistics(documents: DataFrame) -> DataFrame:
    """Per document the counts and the two histograms; one pass, no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda chars: F.length(text) - F.length(F.regexp_replace(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    first = documents.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), words_of(text).alias("words"),
        F.length(F.regexp_replace(text, r"[ \x09-\x0D]+", "")).cast("long").alias("word_chars"),
        *(count(c).cast("long").alias(n) for n, c in CHARACTER_CLASSES.items()),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    classes = [F.col(n) for n in CHARACTER_CLASSES]
    rest = functools.reduce(lambda a, c: a - c, classes, F.col("word_chars"))
    return first.select(
        "doc_id", "lang", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines",
        F.size("words").cast("long").alias("n_words"), repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.array(*classes, rest).alias("characters"), let(F.col("words"), word_histogram).alias("common"))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two count arrays; null if one
    of them is null or sums to 0."""
    share = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    def divergence(s: Column) -> Column:
        terms = F.zip_with(p, q, lambda x, y: part(x / s["p"], y / s["q"]) + part(y / s["q"], x / s["p"]))
        return F.when((s["p"] > 0) & (s["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2)))

    return let(F.struct(share(p).alias("p"), share(q).alias("q")), divergence)


def references(statistics: DataFrame, guard: int = GUARD_WORDS) -> DataFrame:
    """``lang, ref_characters, ref_common``: sums over all texts of at least ``guard`` words of
    their shares, in millionths, so that every text counts the same and sums are exact.  They
    are taken before the shuffle, so a language may hold nearly all rows."""
    def shares(counts: str) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
        return let(total, lambda t: F.transform(counts, lambda x: F.round(F.lit(1e6) * x / t).cast("long")))

    parts = statistics.where(F.col("n_words") >= guard).select("lang", shares("characters").alias("characters"), shares("common").alias("common"))
    sums = lambda c, n: F.array(*(F.sum(F.col(c)[k]) for k in range(n)))
    return parts.groupBy("lang").agg(sums("characters", len(CHARACTER_CLASSES) + 1).alias("ref_characters"), sums("common", len(COMMON_WORDS) + 1).alias("ref_common"))


def judge_quality(documents: DataFrame, guard: int = GUARD_WORDS, character_distance: float = MAX_CHARACTER_DISTANCE,
                  common_guard: int = GUARD_COMMON_WORDS, word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per document ``doc_id``, the counts, both distances, ``base_failed`` and ``kept``.  The
    statistics are written once (a few hundred bytes a text): the references and the verdicts
    both read them."""
    statistics = stored(text_statistics(documents), "quality")
    judged = statistics.join(references(statistics, guard), "lang", "left").withColumns({
        "character_distance": js_distance(F.col("characters"), F.col("ref_characters")),
        "word_distance": js_distance(F.col("common"), F.col("ref_common"))})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    over = lambda d, most, least: (F.col("n_words") >= least) & F.coalesce(F.col(d) > most, F.lit(False))
    far = over("character_distance", character_distance, guard) | over("word_distance", word_distance, common_guard)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "character_distance", "word_distance", failed.alias("base_failed"), (~failed & ~far).alias("kept"))


def _oracle() -> str:
    blank = r"[ \x09-\x0D]"
    quoted = lambda e: "'" + e.replace("'", "''") + "'"
    count = lambda e: f"length(t) - length(regexp_replace(t, {quoted(e)}, '', 'g'))"
    classes = ", ".join(f"{count(e)} AS {n}" for n, e in CHARACTER_CLASSES.items())
    rest = "word_chars - " + " - ".join(CHARACTER_CLASSES)
    known = "[" + ", ".join(quoted(w) for w in COMMON_WORDS) + "]"
    distance = lambda a, b: (
        f"sqrt(greatest(0.0, list_sum(list_transform(range(1, len({a}) + 1), lambda i: "
        f"CASE WHEN {a}[i] > 0 THEN {a}[i] / list_sum({a}) * log2(2 * ({a}[i] / list_sum({a})) / ({a}[i] / list_sum({a}) + {b}[i] / list_sum({b}))) ELSE 0.0 END + "
        f"CASE WHEN {b}[i] > 0 THEN {b}[i] / list_sum({b}) * log2(2 * ({b}[i] / list_sum({b})) / ({a}[i] / list_sum({a}) + {b}[i] / list_sum({b}))) ELSE 0.0 END)) / 2))")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, regexp_extract_all(t, '[^ \\x09-\\x0D]+') AS w FROM d),
c AS (SELECT r, doc_id, lang, length(regexp_replace(t, '{blank}+', '', 'g')) AS word_chars, {classes},
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS lines FROM d),
win AS (SELECT r, k, array_to_string(w[k + 1:k + {WINDOW}], ' ') AS s FROM (SELECT r, w, unnest(range(len(w) - {WINDOW - 1})) AS k FROM w)),
rep AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - k, {WINDOW}))) AS n FROM (SELECT r, k, lead(k) OVER (PARTITION BY r ORDER BY k) AS nxt FROM rep) GROUP BY r),
s AS MATERIALIZED (SELECT c.r, doc_id, lang, len(w.w) AS n_words, word_chars, symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
    [{", ".join(CHARACTER_CLASSES)}, {rest}] AS ch,
    list_append(list_transform({known}, lambda q: len(list_filter(w.w, lambda x: x = q))), len(list_filter(w.w, lambda x: NOT list_contains({known}, x)))) AS co
  FROM c JOIN w USING (r) LEFT JOIN cov USING (r)),
part AS (SELECT lang, 'ch' AS kind, unnest(range(1, len(ch) + 1)) AS i, unnest(list_transform(ch, lambda x: round(1e6 * x / list_sum(ch)))) AS x FROM s WHERE n_words >= {GUARD_WORDS}
  UNION ALL SELECT lang, 'co', unnest(range(1, len(co) + 1)), unnest(list_transform(co, lambda x: round(1e6 * x / list_sum(co)))) FROM s WHERE n_words >= {GUARD_WORDS}),
total AS (SELECT lang, kind, i, sum(x) AS x FROM part GROUP BY ALL),
ref AS (SELECT lang, list(x ORDER BY i) FILTER (WHERE kind = 'ch') AS rch, list(x ORDER BY i) FILTER (WHERE kind = 'co') AS rco FROM total GROUP BY lang),
j AS (SELECT s.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    CASE WHEN n_words >= {GUARD_WORDS} AND rch IS NOT NULL THEN {distance("ch", "rch")} END AS dch, CASE WHEN n_words >= {GUARD_COMMON_WORDS} AND rco IS NOT NULL THEN {distance("co", "rco")} END AS dco
  FROM s LEFT JOIN ref USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(dch > {MAX_CHARACTER_DISTANCE}, false) AND NOT coalesce(dco > {MAX_WORD_DISTANCE}, false) AS kept
FROM j"""


@query("op3_quality_rules", _oracle())
def op3_quality_rules(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents")).drop("character_distance", "word_distance")
