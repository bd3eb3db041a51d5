"""URL filter: allow / block rules per host and path, and link-graph propagation for the rest.

Trust flows from hosts with allowed pages along host links (personalised PageRank);
distrust flows from hosts with blocked pages against the links (a host that links to a
blocked one is suspect): a host takes on the distrust of the hosts that it links to, each in
proportion to its share of the host's links, so it does not matter how many others link there.
Both run over host edges, aggregated from all page links before anything is joined, so a host
with a third of all pages is one row per target.  Trust that arrives at a host without links ends
there.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no rule, has
no node in the graph and is allowed.  Null html has no links.  Repeated rows count as often
as they occur.  An empty table gives an empty result.  Columns beyond the three named ones
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import ascii_lower, query, table

#: The rules of the query, as its contract states them.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

LINK = r"""(?i)href\s*=\s*["']?([^"'\s>]*://[^"'\s>]*)"""
DAMPING = 0.85
#: Rounds at most, and the sum of all changes at which they end.  What k rounds leave out is no more
#: than 0.85 ** k of a rank: a thousandth.  Ranks only rise, so no host changes by more than the sum.
ITERATIONS, BOUND = 43, 1e-4
#: A host is blocked when its distrust is at least this (half of its pages blocked by rules, or
#: somewhat more than half of its links to hosts whose pages are), and this many times its trust.
MIN_DISTRUST, RATIO = 0.07, 2.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    host_fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
    return host_fits & F.col("path").startswith(slash + path)


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest fitting rule (null if none fits).
    A rule fits its host and all subdomains where the path starts with the rule's.  Of two
    fitting rules of one length, a block wins."""
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[0] != "block")):
        rule = (F.when(_fits(r), r) if rule is None else rule.when(_fits(r), r))
        verdict = (F.when(_fits(r), v) if verdict is None else verdict.when(_fits(r), v))
    return urls.withColumn("rule", rule if rules else F.lit(None).cast("string")).withColumn("rule_verdict", verdict if rules else F.lit(None).cast("string"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between two different hosts, counted over all pages."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
    edges = links.select("src", host_of(F.col("link")).alias("dst"))
    return edges.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING, bound: float = BOUND) -> DataFrame:
    """``host, trust, distrust`` from ``seeds`` (host, trust, distrust: the personalisation).

    rank = (1 - damping) * seed + damping * (rank that arrives), from rank = (1 - damping) *
    seed, until the ranks together rise by less than ``bound``, ``iterations`` times at most.
    Trust leaves a host along its links in proportion to their counts; distrust comes to a host
    from the targets of its links in the same proportions.  Each round is one join of the edges
    with the ranks and one sum by host, then a reliable checkpoint."""
    out_n = edges.groupBy("src").agg(F.sum("n").alias("out_n"))
    weighted = edges.join(out_n, "src").select("src", "dst", (F.col("n") / F.col("out_n")).alias("w"))
    zero = F.lit(0.0)
    flow = weighted.select(F.col("src").alias("host"), F.col("dst").alias("to"), F.col("w").alias("w_trust"), zero.alias("w_distrust")).unionByName(
        weighted.select(F.col("dst").alias("host"), F.col("src").alias("to"), zero.alias("w_trust"), F.col("w").alias("w_distrust"))).checkpoint()
    start = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust")).checkpoint()
    if flow.isEmpty():  # no links: every round gives the start again
        return start
    total = lambda df: df.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 0.0
    rank, before = start, total(start)
    for _ in range(iterations):
        arrived = flow.join(rank, "host").select(F.col("to").alias("host"), (F.col("trust") * F.col("w_trust") * damping).alias("trust"), (F.col("distrust") * F.col("w_distrust") * damping).alias("distrust"))
        rank = start.unionByName(arrived).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).checkpoint()
        now = total(rank)
        if now - before < bound:
            break
        before = now
    return rank


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, iterations: int = ITERATIONS,
                min_distrust: float = MIN_DISTRUST, ratio: float = RATIO) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``.

    The rule's verdict where one fits; else the host's: block where distrust is at least
    ``min_distrust`` and ``ratio`` times the trust, otherwise allow.  The seed of a host is
    the share of its pages that a rule allows (trust) or blocks (distrust)."""
    url = F.col("url")
    judged = with_rules(pages.select("page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path")), rules)
    share = lambda v: F.avg(F.when(F.col("rule_verdict") == v, 1.0).otherwise(0.0))
    seeds = judged.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")).where("trust > 0 OR distrust > 0")
    ranks = propagate(host_edges(pages.select("url", "html")), seeds, iterations)
    bad = (F.col("distrust") >= min_distrust) & (F.col("distrust") >= ratio * F.col("trust"))
    return judged.join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def _oracle() -> str:
    host = "CASE WHEN strpos({0}, '://') > 0 THEN translate(regexp_extract(substr({0}, strpos({0}, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"
    path = "CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
    cases = {"rule": "", "verdict": ""}
    for v, r in sorted(RULES, key=lambda x: (-len(x[1]), x[0] != "block")):
        h, _, p = r.partition("/")
        fits = f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN "
        cases["rule"] += fits + f"'{r}' "
        cases["verdict"] += fits + f"'{v}' "
    rounds = "".join(f""",
r{i + 1} AS MATERIALIZED (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT * FROM r0
    UNION ALL SELECT dst, {DAMPING} * trust * n / out_n, 0.0 FROM weighted JOIN r{i} ON src = host
    UNION ALL SELECT src, 0.0, {DAMPING} * distrust * n / out_n FROM weighted JOIN r{i} ON dst = host) GROUP BY host)""" for i in range(ITERATIONS))
    link = LINK.replace("'", "''")
    return f"""
WITH parts AS (SELECT page_id, {host.format("coalesce(url, '')")} AS host, coalesce({path}, '') AS path FROM pages),
judged AS (SELECT *, CASE {cases["rule"]}END AS rule, CASE {cases["verdict"]}END AS rule_verdict FROM parts),
links AS (SELECT {host.format("coalesce(url, '')")} AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM pages),
edges AS (SELECT src, {host.format("link")} AS dst, count(*) AS n FROM links GROUP BY 1, 2 HAVING src <> '' AND dst <> '' AND src <> dst),
weighted AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY src) AS out_n FROM edges),
r0 AS MATERIALIZED (SELECT host, {1 - DAMPING} * avg(CASE WHEN rule_verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
    {1 - DAMPING} * avg(CASE WHEN rule_verdict = 'block' THEN 1.0 ELSE 0.0 END) AS distrust FROM judged WHERE host <> '' GROUP BY host){rounds}
SELECT page_id, j.host, path, rule,
    coalesce(rule_verdict, CASE WHEN distrust >= {MIN_DISTRUST} AND distrust >= {RATIO} * trust THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN r{ITERATIONS} r ON j.host = r.host"""


@query("op6_url_filter", _oracle())
def op6_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
