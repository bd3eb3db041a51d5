"""Collocations, counted in burstable hash tries.

1. A task reads its texts as one stream of word numbers per language and counts phrases in a
   trie of hash containers: first all phrases of one and two words, in a second pass those of
   three.  A container that grows over ``BURST`` entries bursts: next words with many of its
   entries get containers of their own, one level below, and the others stay together.
2. When the tries of a task hold over ``MOST_ENTRIES``, the largest subtrees of the largest one are
   spilled whole, until half of it is left: as sorted runs, one for each prefix partition, which
   the hash of a phrase's language and first two words picks.  So a task holds a bounded number
   of entries however long its input.
3. The runs are shuffled by prefix partition, and the sorted entries merged there: their counts
   are added up, in the JVM, where they may spill.
4. A phrase of three words occurs no more often than the two pairs in it, so the second pass needs
   only those whose pairs are frequent.  It asks a bitmap of ``MAP_BITS`` bits of all frequent
   pairs, whose size is fixed: a pair that shares its bits with another costs an entry, never a
   phrase.
5. Phrases with enough occurrences are joined with the counts of their parts and scored in exact
   decimal arithmetic.  Those that stand in a longer one half of the time or more are dropped.
   The best of each language are first picked in ``SALTS`` shares, then among these.

Edge cases: a null text is an empty one; a null language is ``und``; the empty language is one of
its own; texts without words and pieces of one word count in ``n`` only; repeated rows count as
often as they stand; ties are broken by count and phrase; an empty table gives an empty result.
Other columns are ignored.  Long texts are read in parts that overlap by two words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from releasekit.llm.base import byte_slices, query, raw_bytes, stored, table
from releasekit.llm.shingles import mix

LONGEST, LEAST_COUNT, TOP = 3, 10, 2000
#: Entries of a container before it bursts, and of all tries of a task before they spill.
BURST, MOST_ENTRIES = 65_536, 600_000
#: The share of a bursting container's entries that gives a word its own.
SHARE = 256
#: Bytes of text read at a time; entries of a spilled row; shares of the first choice of the best.
SLICE_BYTES, RUN_ENTRIES, SALTS = 4 << 20, 20_000, 64
#: Bits of the map of frequent pairs (8 MB).
MAP_BITS = 1 << 26
#: Words are numbered in 21 bits, so that three fit into 63.
BITS = 21
MASK = (1 << BITS) - 1

_BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b for b in range(256))


class Numbers(dict):
    """Numbers of words, from 1; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        return k


class Container:
    """Counts of phrases of up to three word numbers, packed into 63 bits, the first word highest,
    absent words 0.  ``below`` has containers of words that stand ``depth`` words in."""

    def __init__(self, depth: int = 0):
        self.depth, self.size, self.limit = depth, 0, BURST
        self.entries: dict[int, int] = {}
        self.below: dict[int, Container] = {}

    def _words(self, keys: np.ndarray) -> np.ndarray:
        return keys >> BITS * (2 - self.depth) & MASK

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct packed phrases in rising order."""
        if self.below and len(keys):
            words = self._words(keys)
            cuts = np.flatnonzero(np.diff(words, prepend=-1))
            there = np.isin(words[cuts], np.fromiter(self.below, np.int64, len(self.below)))
            ends = np.append(cuts[1:], len(keys))
            for a, b in zip(cuts[there].tolist(), ends[there].tolist()):
                child = self.below[int(words[a])]
                self.size -= child.size
                child.add(keys[a:b], counts[a:b])
                self.size += child.size
            own = np.repeat(~there, ends - cuts)
            keys, counts = keys[own], counts[own]
        self.size -= len(self.entries)
        held = self.entries
        if held:
            for k, n in zip(keys.tolist(), counts.tolist()):
                held[k] = held.get(k, 0) + n
        else:
            held.update(zip(keys.tolist(), counts.tolist()))
        self.size += len(held)
        if len(held) > self.limit and self.depth < LONGEST - 1:
            self._burst()

    def _burst(self) -> None:
        keys, counts = self._arrays()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        words = self._words(keys)
        cuts = np.flatnonzero(np.diff(words, prepend=-1))
        ends = np.append(cuts[1:], len(keys))
        large = ends - cuts > BURST // SHARE
        for a, b in zip(cuts[large].tolist(), ends[large].tolist()):
            self.below[int(words[a])] = child = Container(self.depth + 1)
            child.add(keys[a:b], counts[a:b])
        rest = np.repeat(~large, ends - cuts)
        self.entries = dict(zip(keys[rest].tolist(), counts[rest].tolist()))
        self.limit = max(BURST, 2 * len(self.entries))  # rare words only: no use in trying again soon

    def _arrays(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.entries)
        return np.fromiter(self.entries.keys(), np.int64, n), np.fromiter(self.entries.values(), np.int64, n)

    def subtree(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self._arrays(), *(x for child in self.below.values() for x in child.subtree())]

    def take(self, left: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove the largest subtrees until ``left`` entries stay; their phrases and counts."""
        found = [(np.empty(0, np.int64),) * 2]
        for size, word in sorted([(len(self.entries), -1), *((c.size, w) for w, c in self.below.items())], reverse=True):
            if self.size <= left:
                break
            if word < 0:
                found.append(self._arrays())
                self.entries, self.limit = {}, BURST
            else:
                found += self.below.pop(word).subtree()
            self.size -= size
        return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])


def pair_bits(first, second, lang, high=lambda x: x >> 6):
    """The two bits of a pair in the map, from the CRC-32 of its words and of its language, as
    numbers, arrays or columns; ``high`` drops the low bits of one."""
    return (first * 5 + second * 9 + lang) % MAP_BITS, (high(first) * 7 + high(second) * 3 + high(lang)) % MAP_BITS


class Counter:
    """The trie, word numbers and open end of one language in a task.  Without ``pairs`` it counts
    words and pairs, with that map the phrases of three words whose pairs are in it."""

    def __init__(self, lang: str, pairs: np.ndarray | None = None):
        self.lang, self.pairs, self.total = zlib.crc32(lang.encode()), pairs, 0
        self._renumber()

    def _renumber(self, carry: tuple[bytes, ...] = ()) -> None:
        self.numbers, self.trie = Numbers(), Container()
        self.carry = np.array([self.numbers[w] for w in carry], np.int64)
        self.sums = np.empty(0, np.int64)

    def _checksums(self) -> np.ndarray:
        """The CRC-32 of every word, by number."""
        n = len(self.numbers) - len(self.sums)
        self.sums = np.concatenate([self.sums, np.fromiter(map(zlib.crc32, islice(self.numbers, len(self.sums), None)), np.int64, n)])
        return self.sums

    def _frequent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        sums = self._checksums()
        found = np.ones(len(a), bool)
        for bit in pair_bits(sums[a], sums[b], self.lang):
            found &= self.pairs[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
        return found

    def read(self, words: list[bytes]) -> None:
        """Count the phrases that end in ``words``, which go on where the last ones ended."""
        new = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        ids, c = np.concatenate([self.carry, new]), len(self.carry)
        inside = ids > 0
        if self.pairs is None:
            one = new[new > 0]
            self.total += len(one)
            at = max(c - 1, 0)
            found = [one << 2 * BITS, (ids[at:-1] << 2 * BITS | ids[at + 1:] << BITS)[inside[at:-1] & inside[at + 1:]]]
        else:
            at = max(c - 2, 0)
            ids, inside = ids[at:], inside[at:]
            pair = inside[:-1] & inside[1:]
            pair[pair] = self._frequent(ids[:-1][pair], ids[1:][pair])
            both = pair[:-1] & pair[1:]
            found = [(ids[:-2] << 2 * BITS | ids[1:-1] << BITS | ids[2:])[both]]
        self.trie.add(*np.unique(np.concatenate(found), return_counts=True))
        self.carry = new[-2:] if len(new) > 1 else np.concatenate([self.carry, new])[-2:]

    def spill(self, left: int, partitions: int):
        """Spill down to ``left`` entries: numbers of partitions, and sorted entries of each."""
        import pyarrow as pa
        import pyarrow.compute as pc

        keys, counts = self.trie.take(left)
        names = list(self.numbers)
        words = pa.array(names, pa.large_binary())
        rank = np.empty(len(names), np.int64)
        rank[pc.array_sort_indices(words).to_numpy()] = np.arange(1, len(names) + 1)
        rank[0] = 0  # a phrase stands before those that it begins
        hashes = mix(self._checksums().astype(np.uint64) + np.uint64(self.lang | 1 << 32))
        hashes[0] = 0
        ids = [keys >> 2 * BITS, keys >> BITS & MASK, keys & MASK]
        part = (mix(hashes[ids[0]] * np.uint64(3) + hashes[ids[1]]) % np.uint64(partitions)).astype(np.int32)
        sort = np.argsort(rank[ids[0]] << 2 * BITS | rank[ids[1]] << BITS | rank[ids[2]])
        sort = sort[np.argsort(part[sort], kind="stable")]
        part = part[sort]
        columns = [words.take(pa.array(x[sort], mask=x[sort] == 0)) for x in ids]
        phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()), null_handling="skip")
        first = np.flatnonzero(np.diff(part, prepend=-1))
        at = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
        starts = np.flatnonzero(at % RUN_ENTRIES == 0)
        feed = pa.array([b"", b"\n"], pa.large_binary()).take(pa.array((at % RUN_ENTRIES > 0).astype(np.int8)))
        number = pa.array(counts[sort]).cast(pa.large_utf8()).cast(pa.large_binary())
        nothing, tab = pa.scalar(b"", pa.large_binary()), pa.scalar(b"\t", pa.large_binary())
        entries = pc.binary_join_element_wise(pc.binary_join_element_wise(feed, phrases, nothing), number, tab)
        # the entries of a run lie one behind the other already
        limits = np.frombuffer(entries.buffers()[1], np.int64)[entries.offset:entries.offset + len(entries) + 1]
        runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(limits[np.append(starts, len(part))]), entries.buffers()[2]])
        if not self.trie.size:
            self._renumber(tuple(names[k] for k in self.carry))
        return part[starts], runs


def chunks(text: bytes, most: int) -> Iterator[list[bytes]]:
    """The words and piece ends of translated text, about ``most`` bytes at a time."""
    at = 0
    while at < len(text):
        to = len(text)
        if to - at > most:
            cut = max(text.rfind(b" ", at, at + most), text.rfind(_BREAK, at, at + most))
            if cut < at:  # a word beyond that size
                ends = [k for k in (text.find(b" ", at + most), text.find(_BREAK, at + most)) if k >= 0]
                cut = min(ends, default=len(text) - 1)
            to = cut + 1
        yield text[at:to].replace(_BREAK, b" \xff ").split()
        at = to


def _rows(spilled: list):
    """A batch of ``part, runs`` from ``(language, partitions, runs)``."""
    import pyarrow as pa

    part = np.concatenate([p for _, p, _ in spilled])
    order = np.argsort(part, kind="stable")
    langs = pa.array([lang for lang, p, _ in spilled for _ in range(len(p))]).take(pa.array(order))
    runs = pa.concat_arrays([r for *_, r in spilled]).take(pa.array(order)).cast(pa.large_utf8(), safe=False).cast(pa.utf8())
    starts = np.flatnonzero(np.diff(part[order], prepend=-1))
    offsets = pa.array(np.append(starts, len(part)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(part[order][starts].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([langs, runs], names=["lang", "run"]))], names=["part", "runs"])


def phrase_runs(documents: DataFrame, partitions: int, pairs: np.ndarray | None = None) -> DataFrame:
    """``part, runs``: for a prefix partition its languages and sorted runs of entries ``phrase, tab,
    count``; a phrase may stand in several.  The entry of the empty phrase has the number of
    all words.  ``pairs`` as in ``Counter``."""
    shared = None if pairs is None else documents.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, Counter] = {}
        for batch in byte_slices(batches, "text", SLICE_BYTES):
            buffer, limits = raw_bytes(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for lang in dict.fromkeys(langs):
                counter = held.get(lang) or held.setdefault(lang, Counter(lang, shared and shared.value))
                text = _BREAK.join([buffer[limits[k]:limits[k + 1]].tobytes() for k, x in enumerate(langs) if x == lang]).translate(_TABLE) + _BREAK
                for words in chunks(text, SLICE_BYTES):
                    if len(counter.numbers) + len(words) > MASK and counter.trie.size:
                        yield _rows([(lang, *counter.spill(0, partitions))])
                    counter.read(words)
                    while sum(c.trie.size for c in held.values()) > MOST_ENTRIES:
                        largest = max(held, key=lambda x: held[x].trie.size)
                        yield _rows([(largest, *held[largest].spill(held[largest].trie.size // 2, partitions))])
        totals = [(lang, np.zeros(1, np.int32), pa.array([b"\t%d" % c.total], pa.large_binary())) for lang, c in held.items() if shared is None]
        left = [(lang, *c.spill(0, partitions)) for lang, c in held.items() if c.trie.size]
        if left or totals:
            yield _rows([*left, *totals])

    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, "part int, runs array<struct<lang:string,run:string>>")


def merged_counts(runs: DataFrame, partitions: int, least: int) -> DataFrame:
    """``lang, phrase, words, a`` of the phrases with ``least`` or more occurrences, and the number of
    all words under the empty phrase."""
    entries = runs.repartition(partitions, "part").select("part", F.explode("runs").alias("r")).select("r.lang", "part", F.explode(F.split("r.run", "\n")).alias("entry"))
    entries = entries.select("lang", "part", F.substring_index("entry", "\t", 1).alias("phrase"), F.substring_index("entry", "\t", -1).cast("long").alias("n"))
    merged = entries.groupBy("lang", "part", "phrase").agg(F.sum("n").alias("a")).where((F.col("phrase") == "") | (F.col("a") >= least))
    spaces = F.length("phrase") - F.length(F.replace("phrase", F.lit(" ")))
    return merged.select("lang", "phrase", F.when(F.col("phrase") == "", 0).otherwise(spaces + 1).cast("int").alias("words"), "a").repartition("lang", "phrase")


def pair_map(pairs: DataFrame) -> np.ndarray:
    """The bits of all ``pairs`` (``lang, phrase``), or-ed together in Spark; ``MAP_BITS`` in all."""
    word = lambda k: F.crc32(F.substring_index("phrase", " ", k))
    bits = pair_bits(word(1), word(-1), F.crc32("lang"), lambda c: F.shiftright(c, 6))
    bits = pairs.select(F.explode(F.array(*[b + 1 for b in bits])).alias("bit"))  # the functions below number bits from 1
    found = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros((MAP_BITS // 32768, 4096), np.uint8)
    for row in found.collect():
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def phrase_counts(documents: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, words, a``: occurrences of all phrases of up to three words with ``least`` or
    more; the phrase of no words has the number of all words of the language."""
    partitions = 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = stored(merged_counts(phrase_runs(documents, partitions), partitions, least), "phrases")
    long = phrase_runs(documents, partitions, pair_map(short.where("words = 2").select("lang", "phrase")))
    return short.unionByName(stored(merged_counts(long, partitions, least), "phrases"))


#: floor(1000000 * a * a / (l * r)) for counts of up to 16 digits: products of up to 38 digits are
#: exact, and no score is over 1000000, as a is at most l and at most r.
SCORE = "cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"


def collocations(documents: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    counts = phrase_counts(documents, least)
    totals = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    parts = counts.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    candidates = counts.where("words > 1")

    long = candidates.where(F.col("words") == LONGEST)
    inner = long.select("lang", F.explode(F.array(F.substring_index("phrase", " ", LONGEST - 1), F.substring_index("phrase", " ", 1 - LONGEST))).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = candidates.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a").drop("longer")

    cuts = held.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    scored = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = scored.withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
    SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
    FROM placed, (VALUES (1), (2), (3)) sizes(k)
    WHERE i + k - 1 <= len(w)
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(a) AS n FROM phrases WHERE words = 1 GROUP BY lang
), candidates AS (
    SELECT * FROM phrases WHERE words > 1 AND a >= 10
), inner_phrases AS (
    SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a FROM candidates WHERE words = 3
), held AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM inner_phrases i WHERE i.lang = c.lang AND i.phrase = c.phrase AND c.words = 2 AND 100 * i.a >= 50 * c.a)
), cuts AS (
    SELECT *, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS p, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS q
    FROM held, (VALUES (1), (2)) places(k) WHERE k < words
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, CAST(1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score,
        row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a), k) AS choice
    FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = c.p JOIN phrases y ON y.lang = c.lang AND y.phrase = c.q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored WHERE choice = 1
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", SQL)
def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))
