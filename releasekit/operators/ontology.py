"""Term hierarchies and crosswalks (GOAL-1..3, JOI-4).

The transitive closure is an iterative frontier join.  Each round joins only the
newest pairs to the edge list, removes pairs already known (``left_anti``, which
also makes cycles terminate) and cuts lineage with a reliable ``checkpoint()`` in
the shared checkpoint folder, so a lost executor never replays the whole loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releasekit.session import ensure_checkpoint_dir


def descendants(edges: DataFrame, parent: str = "parent", child: str = "child",
                max_rounds: int | None = None, roots: DataFrame | None = None) -> DataFrame:
    """All (ancestor, descendant, depth) pairs; depth = shortest distance.  With ``roots`` (one
    column of terms) only the pairs whose ancestor is one of them: the search starts there,
    so it costs what the roots' descendants cost.

    The loop always ends: every round adds only pairs not seen before (the anti join also
    makes cycles finish) and pairs are finite; it runs as many rounds as the longest
    shortest path.  ``max_rounds`` is an optional guard that fails loudly, never truncates.

    Each round's new pairs are checkpointed once; the closure is the union of those
    pieces, so no round rewrites what earlier rounds already stored.  A pair first found
    in round k is at shortest distance k (breadth-first from every node at once)."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = (edges.select(F.col(parent).alias("a"), F.col(child).alias("d"))
              .where("a is not null and d is not null").distinct().checkpoint())
    step = e.select(F.col("a").alias("mid"), F.col("d").alias("next"))
    start = e if roots is None else e.join(roots.select(F.col(roots.columns[0]).alias("a")).distinct(), "a", "left_semi")
    frontier = start.select("a", "d", F.lit(1).alias("depth")).where("a <> d").checkpoint()
    known = frontier
    rounds = 0
    while True:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"closure did not converge in {max_rounds} rounds")
        nxt = (frontier.join(step, frontier["d"] == step["mid"])
               .select(F.col("a"), F.col("next").alias("d"), (F.col("depth") + 1).alias("depth"))
               .where("a <> d")
               .groupBy("a", "d").agg(F.min("depth").alias("depth"))
               .join(known.select("a", "d"), ["a", "d"], "left_anti")
               .checkpoint())
        if nxt.isEmpty():
            break
        known = known.unionByName(nxt)
        frontier = nxt
    return known.select(F.col("a").alias("ancestor"), F.col("d").alias("descendant"), "depth")


def extend_closure(closure: DataFrame, added: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """The closure (``ancestor, descendant, depth``) after more edges, without computing it anew.

    A new pair leads up to the parent of a new edge, over new edges with known pairs between
    them, and down from the child of the last one.  So the new edges are chained first, over
    the known pairs between them, as often as that shortens a way; then what lies above the
    first is paired with what lies below the last.  The work is that of the pairs that change,
    and one pass that takes the shorter depth of old and new."""
    spark = closure.sparkSession
    ensure_checkpoint_dir(spark)
    edge = added.select(F.col(parent).alias("t"), F.col(child).alias("h")).where("t IS NOT NULL AND h IS NOT NULL AND t <> h").distinct().checkpoint()
    ends = edge.select(F.col("t").alias("x")).unionByName(edge.select(F.col("h").alias("x"))).distinct().checkpoint()
    here = ends.select(F.col("x").alias("ancestor"), F.col("x").alias("descendant"), F.lit(0).alias("depth"))
    # known ways from the child of a new edge to the parent of another
    between = (closure.join(edge.select(F.col("h").alias("ancestor")).distinct(), "ancestor", "left_semi")
               .join(edge.select(F.col("t").alias("descendant")).distinct(), "descendant", "left_semi").select("ancestor", "descendant", "depth").unionByName(here))
    link = between.join(edge.withColumnRenamed("t", "descendant"), "descendant").groupBy(F.col("ancestor").alias("h"), F.col("h").alias("to")).agg(
        (F.min("depth") + 1).alias("more")).checkpoint()
    ways = edge.withColumn("depth", F.lit(1)).checkpoint()
    frontier = ways
    while True:
        longer = frontier.join(link, "h").groupBy("t", F.col("to").alias("h")).agg(F.min(F.col("depth") + F.col("more")).alias("depth"))
        better = longer.join(ways.withColumnRenamed("depth", "known"), ["t", "h"], "left").where("known IS NULL OR depth < known").drop("known").checkpoint()
        if better.isEmpty():
            break
        ways = ways.unionByName(better).groupBy("t", "h").agg(F.min("depth").alias("depth")).checkpoint()
        frontier = better
    around = closure.select("ancestor", "descendant", "depth").unionByName(here)
    up = around.select(F.col("ancestor").alias("a"), F.col("descendant").alias("t"), F.col("depth").alias("above"))
    down = around.select(F.col("ancestor").alias("h"), F.col("descendant").alias("d"), F.col("depth").alias("below"))
    # the shortest way from each node above to each last child, before what lies below is added
    reach = up.join(ways, "t").groupBy("a", "h").agg(F.min(F.col("above") + F.col("depth")).alias("depth"))
    fresh = reach.join(down, "h").where("a <> d").select(F.col("a").alias("ancestor"), F.col("d").alias("descendant"), (F.col("depth") + F.col("below")).alias("depth"))
    return closure.select("ancestor", "descendant", "depth").unionByName(fresh).groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth"))


def ancestors(edges: DataFrame, terms: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """(ancestor, descendant, depth) for the given terms (one column) as descendants only: the
    search goes up from them, so terms that no evidence names cost nothing."""
    up = descendants(edges, parent=child, child=parent, roots=terms)
    return up.select(F.col("descendant").alias("ancestor"), F.col("ancestor").alias("descendant"), "depth")


def expand_to_ancestors(evidence: DataFrame, closure: DataFrame, term: str, keep_self: bool = True) -> DataFrame:
    """GOAL-2: every evidence row also counts for all ancestors of its term."""
    up = (evidence.join(closure.select(F.col("descendant").alias(term), "ancestor"), term)
          .drop(term).withColumnRenamed("ancestor", term))
    out = evidence.unionByName(up) if keep_self else up
    return out.distinct()


def entity_sources(frames: dict[str, DataFrame], key: str, name: str = "sources") -> DataFrame:
    """GOAL-3: which sources mention each entity (sources are a small, fixed set)."""
    from functools import reduce
    tagged = [f.select(F.col(key), F.lit(src).alias("__src")) for src, f in frames.items()]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return (u.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.array_join(F.array_sort(F.collect_set("__src")), ",").alias(name)))


def crosswalk_concepts(term_classes: DataFrame, mapping: DataFrame, *, term: str, concept: str,
                       cls: str = "class") -> DataFrame:
    """Terms chosen by class -> concepts.  The mapping repeats a (term, concept) pair per
    semantic type, so it is de-duplicated first.  Small: one row per (concept, class)."""
    m = mapping.select(term, concept).distinct()
    return term_classes.select(term, cls).join(m, term).select(concept, cls).distinct()


def crosswalk(term_classes: DataFrame, mapping: DataFrame, relations: DataFrame, *,
              term: str, concept: str, subject: str, source: str, cls: str = "class",
              name: str = "sources", subject_map: DataFrame | None = None, via: str | None = None) -> DataFrame:
    """JOI-4: terms chosen by class -> concepts -> relations of subjects to those concepts,
    keeping the set of sources that assert each (subject, class).

    Relations are cut to the chosen concepts before the subject map joins them.  Where the
    concept of a relation itself comes from a join, cut that side by ``crosswalk_concepts``
    first, join the relations to it and end with ``subject_sources``.  When the relation carries an intermediate id (``via``,
    e.g. an order) rather than the subject, ``subject_map`` (via -> subject) is joined
    only to the surviving rows."""
    concepts = crosswalk_concepts(term_classes, mapping, term=term, concept=concept, cls=cls)
    key = via or subject
    hits = relations.join(concepts, concept).select(key, cls, source)
    if subject_map is not None:
        hits = hits.join(subject_map.select(via, subject), via)
    return subject_sources(hits, subject=subject, source=source, cls=cls, name=name)


def subject_sources(hits: DataFrame, *, subject: str, source: str, cls: str = "class", name: str = "sources") -> DataFrame:
    """The sources that assert each (subject, class), as sorted text; sources are a small set."""
    return (hits.groupBy(subject, cls)
                .agg(F.array_join(F.array_sort(F.collect_set(F.col(source).cast("string"))), ",").alias(name)))
