"""Near-duplicate vectors with spherical-cap filters.

1. Equal vectors of a label are one class, with a count and the smallest id.
2. The filters are random product codes: a direction is one unit vector of each block of
   coordinates, put side by side, so a thousand stored vectors stand for a million directions.
   Every vector is rotated and decoded to the list of all directions whose product with it
   exceeds ``alpha`` (a spherical cap); partial sums that can't reach it are cut.  Directions of
   one code share their parts, so how many a vector exceeds varies much; ``CODES`` codes, each
   with a rotation of its own, even that out.
3. Vectors that share a filter are compared, block against block, by cosine in double precision.
   A pair is counted at the least filter that both lists hold, so it counts once however many
   they share; a task emits counts and a spanning forest of its links, never the pairs.
4. Counts are summed up by vector, forests give the components.

``alpha`` is set from the rows of the largest label such that a cap holds ``CROWD`` of its rows
on average if vectors point anywhere, so candidates by chance stay in proportion to the input;
the number of directions then follows from the share of pairs at the threshold cosine whose two
vectors lie in one cap (an integral), so that such a pair shares ``SHARED`` filters of each code
on average.  Pairs above the threshold share more.

Edge cases: vectors that are null, empty or zero or hold null or non-finite components, a null
label and a null id link with nothing (a null id has a null component and is kept); vectors of
different lengths link with nothing; rows that repeat an id count as vectors of their own;
repeated vectors link with each other; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from releasekit.llm.base import query, stored, table, tasks_for
from releasekit.llm.components import components
from releasekit.llm.minhash import forest, row_groups
from releasekit.llm.shingles import mix

#: Filters of a code that a pair at the threshold shares on average; rows of a label in a cap by chance.
SHARED, CROWD = 0.7, 0.05
#: Codes, by their blocks.
CODES = {2: 24, 3: 72, 4: 144}
#: Widest cap used, unit vectors stored per block of a code, least number of coordinates.
WIDEST, MOST_WORDS, LEAST_DIMS = 1e-4, 16_384, 32
#: Products held at a time while decoding.
PRODUCTS = 4_000_000
#: Classes in a block of a filter.
BLOCK = 2048


def cap_shares(alpha: float, dims: int, cosine: float) -> tuple[float, float]:
    """The share of random directions within ``alpha`` of a vector, and of those within it of both
    of two vectors at ``cosine``: the projection of a direction on a plane has a uniform angle and
    a length over z with probability (1 - z * z) ** (dims / 2 - 1)."""
    phi = np.linspace(-np.pi, np.pi, 40_001)[:-1]

    def share(reach: np.ndarray) -> float:
        reach = np.where(reach > alpha, reach, np.inf)
        z = np.where(np.isfinite(reach), alpha / reach, 1.0)
        return float(((1 - z * z) ** (dims / 2 - 1) * np.isfinite(reach)).mean())

    return share(np.cos(phi)), share(np.minimum(np.cos(phi), np.cos(phi - math.acos(cosine))))


@functools.cache
def plan(rows: int, dims: int, cosine: float) -> tuple[float, int, int]:
    """``alpha``, blocks and unit vectors per block for a label of ``rows`` vectors."""
    dims, wanted = max(dims, LEAST_DIMS), min(WIDEST, CROWD / max(rows, 1))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if cap_shares(mid, dims, cosine)[0] > wanted else (low, mid)
    directions = SHARED / cap_shares(low, dims, cosine)[1]
    blocks = next((b for b in CODES if directions ** (1 / b) <= MOST_WORDS), max(CODES))
    return low, blocks, math.ceil(directions ** (1 / blocks))


@functools.cache
def code(dims: int, blocks: int, words: int, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation of code ``k`` from ``dims`` coordinates to blocks of equal length, and the unit
    vectors of each block (fixed by the numbers)."""
    rng = np.random.default_rng([dims, blocks, words, k])
    padded = math.ceil(max(dims, LEAST_DIMS) / blocks) * blocks
    turn = np.linalg.qr(rng.standard_normal((padded, padded)))[0][:dims].astype(np.float32)
    vectors = rng.standard_normal((blocks, words, padded // blocks))
    return turn, list((vectors / np.linalg.norm(vectors, axis=2, keepdims=True) / math.sqrt(blocks)).astype(np.float32))


def listed(units: np.ndarray, alpha: float, turn: np.ndarray, vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, direction)`` for every direction of a code that exceeds ``alpha`` with a unit vector."""
    parts = np.split(units.astype(np.float32) @ turn, len(vectors), axis=1)
    products = [p @ w.T for p, w in zip(parts, vectors, strict=True)]
    best = np.stack([p.max(axis=1) for p in products])
    row, number, total = np.arange(len(units)), np.zeros(len(units), np.int64), np.zeros(len(units), np.float32)
    for k, p in enumerate(products):
        rest = best.sum(axis=0) - best[k]  # the most that the other blocks can add
        r, c = np.divmod(np.flatnonzero(p.ravel() >= np.repeat(alpha - rest, p.shape[1])), p.shape[1])
        count = np.bincount(r, minlength=len(units))
        times = count[row]
        at = np.repeat((np.cumsum(count) - count)[row] - np.cumsum(times) + times, times) + np.arange(times.sum())
        row, number, total = np.repeat(row, times), np.repeat(number, times) * p.shape[1] + c[at], np.repeat(total, times) + p[r[at], c[at]]
        reach = total + best[k + 1:].sum(axis=0)[row] >= alpha
        row, number, total = row[reach], number[reach], total[reach]
    return row, number


def decode(units: np.ndarray, alpha: float, blocks: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, filter)`` over all codes; a filter is a 64-bit hash of code and direction."""
    rows, filters = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    step = max(16, PRODUCTS // (blocks * words))
    for k in range(CODES[blocks]):
        held = code(units.shape[1], blocks, words, k)
        for at in range(0, len(units), step):
            r, number = listed(units[at:at + step], alpha, *held)
            rows.append(r + at)
            filters.append(mix(number.astype(np.uint64) + np.uint64(k << 56)))
    return np.concatenate(rows), np.concatenate(filters)


def unit_vectors(lists) -> np.ndarray:
    """An Arrow column of lists of one length, as rows of length 1 in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def usable(embedding: str = "embedding"):
    """Whether a vector can be compared at all."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(e, lambda x: x != 0), F.lit(False))


def filter_rows(classes: DataFrame, rows: int, cosine: float) -> DataFrame:
    """``node, filter``: the filters of every class.  Label and length are hashed into them, so that
    only vectors of one label and length share any; where a hash collides they are told apart
    when they are compared."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == dims))
                at, number = decode(unit_vectors(own.column("embedding")), *plan(rows, dims, cosine))
                cell = own.column("cell").to_numpy()[at].view(np.uint64)
                yield pa.RecordBatch.from_arrays([own.column("node").take(pa.array(at)), pa.array(mix(number ^ cell).view(np.int64))], names=["node", "filter"])

    return classes.select("node", "cell", "dims", "embedding").mapInArrow(run, "node long, filter long")


def _shared_before(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Which pairs of rows ``a`` and ``b`` have a filter below ``limit`` in common."""
    found = np.zeros((len(a), len(b)), bool)
    sides = []
    for rows in (a, b):
        own = [lists[k][lists[k] < limit] for k in rows]
        sides.append((np.repeat(np.arange(len(rows)), [len(x) for x in own]), np.concatenate(own) if own else np.empty(0, np.int64)))
    common = np.intersect1d(sides[0][1], sides[1][1])
    for k in range(0, len(common), 512):
        some = common[k:k + 512]
        marks = []
        for (row, value), rows in zip(sides, (a, b), strict=True):
            place = np.minimum(np.searchsorted(some, value), len(some) - 1)
            hit = some[place] == value
            m = np.zeros((len(rows), len(some)), np.float32)
            m[row[hit], place[hit]] = 1
            marks.append(m)
        found |= marks[0] @ marks[1].T > 0
    return found


def compared(members: DataFrame, cosine: float, tasks: int) -> DataFrame:
    """``node, other, n``: for each class in a pair of blocks with links counted there, a class of
    its component (itself, at times) and the number of vectors that it is linked with."""
    key = ["filter", "dims", "lo", "hi"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for group in row_groups(batches, key):
            lo, hi, limit = (group[k][0].as_py() for k in ("lo", "hi", "filter"))
            own = group["own"].to_numpy()
            a = np.flatnonzero(own == lo)
            b = a if lo == hi else np.flatnonzero(own == hi)
            units = unit_vectors(group["embedding"].combine_chunks())
            near = units[a] @ units[b].T >= cosine
            if lo == hi:
                near = np.triu(near, 1)
            if not near.any():
                continue
            labels = group["label"].combine_chunks().dictionary_encode().indices.to_numpy()  # two labels of one cell
            near &= labels[a, None] == labels[None, b]
            used_a, used_b = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            near = near[np.ix_(used_a, used_b)]
            a, b = a[used_a], b[used_b]
            lists = [np.array(x, np.int64) for x in group["filters"].to_pylist()]
            near &= ~_shared_before(lists, a, b, limit)
            nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
            n = np.zeros(len(nodes), np.int64)
            np.add.at(n, a, near @ copies[b])
            np.add.at(n, b, near.T @ copies[a])
            i, j = np.nonzero(near)
            root = dict(forest(nodes, np.column_stack([a[i], b[j]])))
            some = np.flatnonzero(n)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array([root.get(x, x) for x in nodes[some].tolist()], pa.int64()), pa.array(n[some])], names=["node", "other", "n"])

    return members.repartition(tasks, *key).sortWithinPartitions(*key).mapInArrow(run, "node long, other long, n long")


def found_links(classes: DataFrame, cosine: float) -> DataFrame:
    """``compared`` over all filters that two classes share; ``classes``: node, cell, label, dims,
    embedding, copies."""
    rows = classes.groupBy("cell").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    filters = filter_rows(classes, rows, cosine)
    shared = filters.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(filters.join(shared, "filter"), "members")
    work = members.groupBy().agg(F.sum("n")).first()[0] or 0  # a filter of n classes has n * n comparisons
    lists = members.groupBy("node").agg(F.sort_array(F.collect_list("filter")).alias("filters"))
    own = F.pmod(F.xxhash64("node", F.lit(11)), F.col("blocks"))
    spread = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long")).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "filter", "node", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    full = classes.join(lists, "node").select("node", "label", "dims", "embedding", "copies", "filters")
    return compared(spread.join(full, "node"), cosine, tasks_for(classes.sparkSession, work))


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``: the other rows of the same label at
    ``cosine`` or more, the smallest id that links reach, and whether it is the row's own."""
    good = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = vectors.select("vec_id", "label", "embedding", *[F.when(good, F.xxhash64(F.lit(k), "label", "embedding")).alias(h) for k, h in ((1, "h1"), (2, "h2"))])
    classes = keyed.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    # the number is fixed by storing it
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), F.xxhash64("label", F.size("embedding")).alias("cell"), F.size("embedding").alias("dims"), "*"), "classes")
    found = stored(found_links(classes, cosine), "found")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = components(found.select(F.col("node").alias("u"), F.col("other").alias("v")))
    linked = classes.select("node", "h1", "h2", "id", "copies").join(counts, "node", "left").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    linked = stored(linked, "linked")
    least = linked.groupBy("component").agg(F.min("id").alias("least"))
    done = linked.join(least, "component").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "least")
    return keyed.select("vec_id", "h1", "h2").join(done, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


#: Every pair of a label, without filters.
SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id, v.vec_id <= coalesce(l.b, v.vec_id) AS kept
FROM embeddings v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least l ON l.a = v.vec_id
"""


@query("op12_near_vectors", SQL)
def op12_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
