"""Near-duplicates with b-bit MinHash.

1. One pass gives each document its set of word shingles and from it a digest (documents of
   one digest are one class, however many), the keys of its bands (each over six of its
   minima) and a signature: the low bits of all minima, packed.
2. Classes that share a band are candidates.  A band's classes are compared by their packed
   signatures, a block of them against a block, by counting bits; the collision-corrected
   estimate must come within a margin of the threshold.  A task emits only a spanning forest
   of its pairs, never the pairs, and no task gets more than two blocks of a band.
3. The components of these estimated links are groups in which all true links lie.  The pairs of
   the forests are confirmed on full sets first: about one set a class is moved.  Where that does
   not connect a group, its parts are compared, block against block: all classes of the smaller
   parts with all of the group.  The confirmed links give the final components.

Texts are moved only for classes in groups: a bitmap of their keys, of fixed size, tells the
others at the scan.

A band misses a pair of similarity 0.80 with probability 0.74; the bands share minima, so all 48
do with 0.9 in ten thousand.  With the estimate's margin a pair at 0.80 is missed with 1.4 in
ten thousand, at 0.85 with 0.13 (simulated, a million pairs each, independent minima).

Edge cases: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text with fewer words than a shingle has one shingle, its whole sequence; rows
with a null id are linked with nothing, have a null component and are kept; repeated rows
have equal sets and so one component; rows that share an id but not a text are judged each by
its own text (a row's key is its id and a 64-bit hash of its text; a class's node is a number
of its own).  Other columns are kept by ``drop_near_duplicates``.  Long texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from releasekit.llm.base import in_map, key_map, query, slices, stored, table, tasks_for
from releasekit.llm.components import components
from releasekit.llm.shingles import shingle_hashes, word_hashes

MINIMA, BANDS, ROWS, BITS = 128, 48, 6, 4
_RNG = np.random.default_rng(7)
_A = _RNG.integers(1, 2**32, MINIMA, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, MINIMA, dtype=np.uint32)
_PLACES = np.array([_RNG.choice(MINIMA, ROWS, replace=False) for _ in range(BANDS)])
_KEYS = _RNG.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

#: Estimates within this of the threshold are confirmed on full sets: four standard errors at 0.8
#: (0.147), and more above.
MARGIN = 0.15
#: Classes in a block of a band, and classes and shingles in a block of a group.
BAND_BLOCK, GROUP_BLOCK, GROUP_SHINGLES = 512, 512, 500_000


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of 64-bit shingle hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(MINIMA, 2**32 - 1, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(out, (x[k:k + 256, None] * _A + _B).min(axis=0), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    return ((least[_PLACES].astype(np.uint64) + np.uint64(1)) * _KEYS).sum(axis=1, dtype=np.uint64).view(np.int64)


def pack(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum (after a multiplication that spreads them)."""
    low = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    low = low.reshape(-1, 8 // BITS).astype(np.uint8)
    return np.bitwise_or.reduce(low << np.arange(0, 8, BITS, dtype=np.uint8), axis=1).tobytes()


_ONES = np.uint64(int("0001" * 16, 2))


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of all signatures ``a`` (n x words of 64 bits) with all ``b``: equal minima by
    counting bits, corrected for those that are equal by chance."""
    equal = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        differ = a[:, k, None] ^ b[None, :, k]
        differ |= differ >> np.uint64(2)
        differ |= differ >> np.uint64(1)
        equal += 16 - np.bitwise_count(differ & _ONES).astype(np.int32)
    chance = 2.0**-BITS
    return (equal / MINIMA - chance) / (1 - chance)


def tree(nodes: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs (indexes into ``nodes``) of a spanning forest, the first that connect, as nodes."""
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in pairs.tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def forest(nodes: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of ``pairs`` (indexes into ``nodes``) as stars around the least node."""
    least: dict[int, int] = {}
    near: dict[int, list[int]] = {}
    for u, v in tree(nodes, pairs):
        near.setdefault(u, []).append(v)
        near.setdefault(v, []).append(u)
    for start in sorted(near):
        if start not in least:
            least[start], todo = start, [start]
            while todo:
                for v in near[todo.pop()]:
                    if v not in least:
                        least[v] = start
                        todo.append(v)
    return [(u, r) for u, r in least.items() if u != r]


def profiles(documents: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest, bands, signature`` per row; the last three are null
    where the set is empty."""
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            sizes, digests, bands, signatures = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = np.unique(shingle_hashes(word_hashes(text), words))
                sizes.append(len(s))
                least = minima(s) if len(s) else None
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(least).tobytes() if len(s) else None)
                signatures.append(pack(least) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "digest", "bands", "signature"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, digest binary, bands binary, signature binary")


def row_groups(batches, key: list[str]) -> Iterator[dict[str, list]]:
    """Rows of sorted batches, gathered by ``key``; a group's size is bounded by its blocks."""
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        keys = np.column_stack([rest.column(k).to_numpy() for k in key])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        at = 0
        for cut in cuts:
            yield {n: rest.column(n)[at:cut] for n in rest.column_names}
            at = int(cut)
        rest = rest.slice(at).combine_chunks()
    if rest is not None and rest.num_rows:
        yield {n: rest.column(n) for n in rest.column_names}


def _block_pairs(members: DataFrame, blocks: str, node: str) -> DataFrame:
    """Each row of a group with ``blocks`` blocks goes to the pairs of blocks that its own takes
    part in: ``lo <= hi``.  The block of a row comes from a hash of its node."""
    own = F.pmod(F.xxhash64(node, F.lit(11)), F.col(blocks))
    return members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))).select(
        *members.columns, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def estimated_links(classes: DataFrame, threshold: float) -> DataFrame:
    """``u, v``: pairs of the links by estimate that span a forest, per band and pair of blocks.  Blocks
    are in the order of nodes, so the bands of a group mostly give the same pairs."""
    def keys(batches):
        import pyarrow as pa

        for batch in batches:
            bands = batch.column("bands").to_pylist()
            flat = np.frombuffer(b"".join(bands), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(bands))), pa.array(flat)],
                names=["node", "band", "key"])

    rows = classes.select("node", "bands").mapInArrow(keys, "node long, band int, key long")
    shared = rows.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(shared, ["band", "key"]).withColumn("blocks", F.ceil(F.col("n") / BAND_BLOCK).cast("long")), "bands")
    work = members.groupBy().agg(F.sum("n")).first()[0]
    spread = _block_pairs(members.select("band", "key", "node", "blocks"), "blocks", "node")
    signed = spread.join(classes.select("node", "signature", "n_shingles"), "node")
    key = ["band", "key", "lo", "hi"]

    def run(batches):
        import pyarrow as pa

        for group in row_groups(batches, key):
            nodes = group["node"].to_numpy()
            signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint64).reshape(len(nodes), -1)
            sizes, own = group["n_shingles"].to_numpy(), group["own"].to_numpy()
            lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
            a = np.flatnonzero(own == lo)
            b = a if lo == hi else np.flatnonzero(own == hi)
            near = estimates(signatures[a], signatures[b]) >= threshold - MARGIN
            near &= np.minimum(sizes[a, None], sizes[None, b]) >= (threshold - 1e-9) * np.maximum(sizes[a, None], sizes[None, b])
            i, j = np.nonzero(np.triu(near, 1) if lo == hi else near)
            links = tree(nodes, np.column_stack([a[i], b[j]]))
            if links:
                yield _links(links)

    return signed.repartition(tasks_for(classes.sparkSession, work), *key).sortWithinPartitions(*key, "node").mapInArrow(run, "u long, v long")


def _links(links: list[tuple[int, int]]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], names=["u", "v"])


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets ``a`` with sets ``b`` (sorted arrays), by products of
    indicator matrices over a slice of the shared elements at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return out
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    row_a, row_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    shared = np.intersect1d(flat_a, flat_b)
    if not len(shared):
        return out
    col_a, col_b = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
    use_a, use_b = shared[np.minimum(col_a, len(shared) - 1)] == flat_a, shared[np.minimum(col_b, len(shared) - 1)] == flat_b
    col_a, row_a, col_b, row_b = col_a[use_a], row_a[use_a], col_b[use_b], row_b[use_b]
    order_a, order_b = np.argsort(col_a, kind="stable"), np.argsort(col_b, kind="stable")
    col_a, row_a, col_b, row_b = col_a[order_a], row_a[order_a], col_b[order_b], row_b[order_b]
    step = 4096
    for k in range(0, len(shared), step):
        (p, q), (r, s) = np.searchsorted(col_a, [k, k + step]), np.searchsorted(col_b, [k, k + step])
        x, y = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
        x[row_a[p:q], col_a[p:q] - k] = 1
        y[row_b[r:s], col_b[r:s] - k] = 1
        out += x @ y.T
    return out


def shingle_sets(documents: DataFrame, groups: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` of the classes in ``groups`` (node, id and text_hash of a row that has the
    set with this digest, digest).  Of the texts, those whose key is in no group stay where they
    are."""
    keyed = documents.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    wanted = groups.select("node", "id", "text_hash", "digest")
    some = in_map(keyed, F.xxhash64("id", "text_hash"), key_map(wanted, F.xxhash64("id", "text_hash")), "wanted").where("wanted").drop("wanted")

    def sets(batches):
        import pyarrow as pa

        for batch in slices(batches):
            values, keep = [], []
            for text, digest in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                s = np.unique(shingle_hashes(word_hashes(text), words)).tobytes()
                keep.append(hashlib.blake2b(s, digest_size=16).digest() == digest)
                values.append(s)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.binary())], names=["node", "shingles"]).filter(pa.array(keep))

    found = some.join(wanted.hint("merge"), ["id", "text_hash"]).select("node", "text", "digest").mapInArrow(sets, "node long, shingles binary")
    return found.dropDuplicates(["node"])


def confirmed_pairs(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``u, v``) that are linked on full sets.  The set of ``v`` goes to its pair, that
    of ``u`` once to each block of its pairs."""
    dealt = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / GROUP_BLOCK).cast("long"))
    keyed = pairs.join(pairs.groupBy("u").agg(F.count("*").alias("n")), "u").withColumn("block", dealt).select("u", "block", "v")
    hubs = keyed.select("u", "block").distinct().withColumn("v", F.lit(None).cast("long"))
    rows = hubs.join(sets.withColumnRenamed("node", "u"), "u").unionByName(keyed.join(sets.withColumnRenamed("node", "v"), "v"))

    def run(batches):
        hub, of = None, None
        for batch in slices(batches):
            links = []
            for u, block, v, s in zip(*(batch.column(c).to_pylist() for c in ("u", "block", "v", "shingles")), strict=True):
                x = np.frombuffer(s, np.uint64)
                if v is None:
                    hub, of = x, (u, block)
                    continue
                assert of == (u, block)
                both = len(np.intersect1d(hub, x, assume_unique=True))
                if 100 * both >= percent * (len(hub) + len(x) - both):
                    links.append((u, v))
            if links:
                yield _links(links)

    dealt_rows = rows.select("u", "block", "v", "shingles").repartition("u", "block").sortWithinPartitions("u", "block", F.asc_nulls_first("v"))
    return dealt_rows.mapInArrow(run, "u long, v long")


def cross_links(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``u, v``: forests of the links between the parts of a group.  ``members``: node, component,
    part, n_shingles, of groups of several parts.  The largest part of a group needs no comparison
    with itself: its blocks meet those of the other parts, and these meet each other."""
    weight = F.greatest(F.ceil(F.count("*") / GROUP_BLOCK), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).cast("long")
    sizes = members.groupBy("component", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("component").agg(F.max(F.struct("n", "part")).alias("m")).select("component", F.col("m.part").alias("main"))
    sided = stored(members.join(main, "component").withColumn("inner", F.col("part") == F.col("main")).select("component", "node", "part", "inner", "n_shingles"), "sides")
    blocks = sided.groupBy("component", "inner").agg(weight.alias("w")).groupBy("component").agg(
        F.max(F.when(F.col("inner"), F.col("w"))).alias("mains"), F.max(F.when(~F.col("inner"), F.col("w"))).alias("others"))
    placed = sided.join(blocks, "component").withColumn("own", F.when(F.col("inner"), F.col("others") + F.pmod(F.xxhash64("node", F.lit(11)), F.col("mains"))).otherwise(F.pmod(F.xxhash64("node", F.lit(11)), F.col("others"))))
    meets = F.when(F.col("inner"), F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("others") + F.col("mains") - 1))
    spread = placed.withColumn("other", F.explode(meets)).select("component", "node", "part", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    key = ["component", "lo", "hi"]

    def run(batches):
        for group in row_groups(batches, key):
            nodes, own, part = group["node"].to_numpy(), group["own"].to_numpy(), group["part"].to_numpy()
            found = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
            lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
            a = np.flatnonzero(own == lo)
            b = a if lo == hi else np.flatnonzero(own == hi)
            both = common_counts([found[k] for k in a], [found[k] for k in b]).astype(np.int64)
            n = np.array([len(x) for x in found], np.int64)
            near = (100 * both >= percent * (n[a, None] + n[None, b] - both)) & (part[a, None] != part[None, b])
            i, j = np.nonzero(np.triu(near, 1) if lo == hi else near)
            links = tree(nodes, np.column_stack([a[i], b[j]]))
            if links:
                yield _links(links)

    work = blocks.agg(F.sum(F.col("others") * (F.col("others") + F.col("mains")))).first()[0] or 0
    tasks = tasks_for(members.sparkSession, work * GROUP_BLOCK * GROUP_BLOCK)
    return spread.join(sets, "node").select("component", "lo", "hi", "own", "node", "part", "shingles").repartition(tasks, *key).sortWithinPartitions(*key).mapInArrow(run, "u long, v long")


def confirmed_links(documents: DataFrame, groups: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``u, v``: links confirmed on full sets that connect what all links connect.  ``groups``: node, id,
    text_hash, digest, n_shingles, component; ``pairs``: the estimated links that span them."""
    sets = stored(shingle_sets(documents, groups, words), "sets")
    sure = stored(confirmed_pairs(sets, pairs, percent), "sure")
    parts = components(sure)
    named = groups.select("node", "component", "n_shingles").join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    named = stored(named, "parts")
    several = named.groupBy("component").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("component")
    left = stored(named.join(several, "component", "left_semi"), "several")
    if left.isEmpty():
        return sure
    return sure.unionByName(stored(cross_links(sets, left, percent), "cross"))


def judged_rows(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row ``doc_id, text_hash, n_shingles, least``: the smallest id and text hash of the
    component that the row is in, its own where it is linked with nothing."""
    profile = stored(profiles(documents, words), "minhash")
    full = profile.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = full.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("n_shingles").alias("n_shingles"),
                                         F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    # the number is fixed by storing it
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), F.col("row.doc_id").alias("id"), F.col("row.text_hash").alias("text_hash"),
                                    "digest", "n_shingles", "bands", "signature"), "classes")
    pairs = stored(estimated_links(classes, percent / 100).distinct(), "pairs")
    grouped = stored(classes.select("node", "id", "text_hash", "digest", "n_shingles").join(components(pairs), "node"), "groups")
    found = components(confirmed_links(documents, grouped, pairs, words, percent))
    linked = stored(classes.select("node", "digest", "id", "text_hash").join(found, "node"), "linked")
    least = stored(linked.groupBy("component").agg(F.min(F.struct(F.col("id").alias("doc_id"), "text_hash")).alias("least")), "least")
    named = linked.join(least, "component").select("node", "least")
    named = classes.select("node", "digest", F.struct(F.col("id").alias("doc_id"), "text_hash").alias("own")).join(named, "node", "left").select("digest", F.coalesce("least", "own").alias("least"))
    return profile.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("least", F.struct("doc_id", "text_hash")).alias("least"))


def near_duplicates(documents: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``: the smallest id that links of
    ``100 * intersection >= percent * union`` reach, and whether it is the row's own."""
    return judged_rows(documents, words, percent).select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


@query("op1_near_duplicates")
def op1_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def drop_near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each component, that of its smallest id (and smallest text
    hash, where texts share the id); repeated rows of that document go too.  Rows whose id and
    text hash are surely not among those that go stay at the scan."""
    judged = stored(judged_rows(documents, words, percent).where("doc_id IS NOT NULL"), "near")
    keys = ["doc_id", "text_hash"]
    own = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    named = [F.col("doc_id").alias("__other_id"), F.col("text_hash").alias("__other_hash")]
    others = stored(judged.where(~own).select(*named).distinct(), "others")
    keyed = documents.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__hash", F.xxhash64(documents["text"]))
    key = F.xxhash64("__id", "__hash")
    repeated = stored(judged.where(own).groupBy(*keys).count().where("count > 1").select(*named), "repeated")
    # only rows that may be among these are moved
    gone = others.withColumn("__once", F.lit(False)).unionByName(repeated.withColumn("__once", F.lit(True)))
    marked = in_map(keyed, key, key_map(gone, F.xxhash64("__other_id", "__other_hash")), "__maybe")
    stay = marked.where(~F.col("__maybe")).select(*documents.columns)
    same = (F.col("__id") == F.col("__other_id")) & (F.col("__hash") == F.col("__other_hash"))
    met = marked.where("__maybe").join(gone, same, "left").where("__once IS NULL OR __once")
    left = met.where("__once IS NULL").select(*documents.columns)
    once = met.where("__once").dropDuplicates(["__id", "__hash", "text"]).select(*documents.columns)
    return stay.unionByName(left).unionByName(once)
