"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost.  Pieces are taken longest first;
each goes to the open sequence that it fills best, or opens a new one.  Which size is opened
is optimised jointly: every permitted size is tried as the size to open (at least), next to
the size of least cost per token, and the plan of least total cost stays.  At the end every
sequence is cut down to the smallest permitted length that holds its contents, and the costs
compared are those after this.

Only ids and lengths move.  They are dealt out evenly into shards of a bounded number of
pieces, so no key can make one task large; a shard of twenty thousand pieces packs as tightly
as the whole table would, but for its last few sequences.

Edge cases: a document longer than the largest length is cut into pieces of that length and a
rest; one without tokens (null, empty or blank text) is returned with length 0 and no
sequence; repeated rows and null ids are packed like any other row; ties go to the earlier
piece in order of length, id and start.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import query, stored, table

CAPACITIES = (256, 512, 1024, 2048, 4096)
SHARD = 20_000


def sequence_cost(capacity: int) -> float:
    """Linear work per token, and attention that grows with the square."""
    return capacity * (1 + capacity / 32768)


def best_fit(lengths: np.ndarray, capacities: Sequence[int], opened: dict[int, int]) -> list[list[int]]:
    """Bins as lists of indexes.  ``lengths`` descends; ``opened``: for the least permitted
    capacity that holds a piece, the capacity to open."""
    bins: list[list[int]] = []
    spaces: list[int] = []  # distinct free spaces, ascending
    by_space: dict[int, list[int]] = {}

    def put(b: int, space: int) -> None:
        if space:
            if space not in by_space:
                bisect.insort(spaces, space)
                by_space[space] = []
            by_space[space].append(b)

    for i, n in enumerate(lengths.tolist()):
        k = bisect.bisect_left(spaces, n)
        if k < len(spaces):
            space = spaces[k]
            b = by_space[space].pop()
            if not by_space[space]:
                del by_space[space]
                del spaces[k]
            bins[b].append(i)
            put(b, space - n)
        else:
            bins.append([i])
            put(len(bins) - 1, opened[capacities[bisect.bisect_left(capacities, n)]] - n)
    return bins


def pack(lengths: np.ndarray, capacities: Sequence[int], costs: dict[int, float]) -> list[tuple[list[int], int]]:
    """``(indexes, capacity)`` of each sequence of the cheapest plan."""
    if not len(lengths):
        return []
    capacities = sorted(capacities)
    per_token = {c: min((d for d in capacities if d >= c), key=lambda d: (costs[d] / d, d)) for c in capacities}
    plans = [per_token, *({c: max(c, least) for c in capacities} for least in capacities)]
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for opened in {tuple(sorted(p.items())): p for p in plans}.values():
        bins = best_fit(lengths, capacities, opened)
        sized = [(b, capacities[bisect.bisect_left(capacities, int(lengths[b].sum()))]) for b in bins]
        cost = sum(costs[c] for _, c in sized)
        if best is None or cost < best[0]:
            best = (cost, sized)
    return best[1]


def word_count(text: Column) -> Column:
    """Words between ASCII white space."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, r"[ \x09-\x0D]+")))


#: Scripts written without spaces (Thai to Lao, Burmese, Khmer, kana, Han): each character is a token.
_UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
#: Characters of other words in a token at most.
TOKEN_CHARS = 16


def token_count(text: Column) -> Column:
    """Tokens by a fixed rule: a character of a script without spaces, or up to ``TOKEN_CHARS``
    others without ASCII white space.  A word of usual length is one token."""
    rule = rf"[{_UNSPACED}]|[^ \x09-\x0D{_UNSPACED}]{{1,{TOKEN_CHARS}}}"
    return F.coalesce(F.regexp_count(text, F.lit(rule)), F.lit(0))


def pack_documents(documents: DataFrame, n_tokens: Column | None = None, capacities: Sequence[int] = CAPACITIES,
                   cost=sequence_cost, shard: int = SHARD) -> DataFrame:
    """``doc_id, start, n_tokens`` (a piece of the document, in tokens), ``bin_id, capacity,
    position`` (the place of its first token in the sequence).  ``n_tokens`` is the length of a
    document, by default ``token_count``; any tokenizer's count can stand there."""
    capacities, largest = sorted(capacities), max(capacities)
    costs = {c: float(cost(c)) for c in capacities}
    count = F.coalesce(n_tokens if n_tokens is not None else token_count(F.col("text")), F.lit(0)).cast("long")
    sized = documents.select("doc_id", count.alias("n"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / largest) - 1).cast("long")
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        "doc_id", (F.col("piece") * largest).alias("start"), F.least(F.lit(largest).cast("long"), F.col("n") - F.col("piece") * largest).alias("n_tokens"))
    pieces = stored(pieces, "pieces")  # texts are read once; the count and the packing read this
    shards = max(1, -(-pieces.count() // shard))
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts).sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        lengths = whole.column("n_tokens").to_numpy()
        full = lengths[:int((lengths > 0).sum())]
        n = whole.num_rows
        bin_id, capacity, position = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        own = TaskContext.get().partitionId() << 32
        for k, (members, size) in enumerate(pack(full, capacities, costs)):
            bin_id[members], capacity[members] = own + k, size
            position[members] = np.cumsum(lengths[members]) - lengths[members]
        none = lengths == 0
        for name, values in (("bin_id", bin_id), ("capacity", capacity), ("position", position)):
            whole = whole.append_column(name, pa.array(values, pa.int64(), mask=none))
        yield from whole.combine_chunks().to_batches()

    # dealt out in turn, not by a key: repeated ids are spread like all others
    return pieces.repartition(shards).mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, bin_id long, capacity long, position long")


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
