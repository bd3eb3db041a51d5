"""Writers for raw dump shapes (preamble TSV, ``#A|B|`` files, numbered chunks, JSON
documents).  They turn a table into the kind of files a public source ships, so the
readers can be exercised on data of any size.

Every dump file is one ``(key, chunk)`` group written as its own directory, and each
starts with its head lines (preamble / header).  The chunk is a hash of the row and its
number in the task, so identical rows spread like others and a
key holding a third of all rows is still written by ``n_chunks`` tasks.  Head rows are
generated per group with ``posexplode`` (no cross join), shuffled next to their data,
and ``sortWithinPartitions`` puts them first; that order already satisfies the file
writer's required ordering, so it writes rows as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_COL = "chunk"


def as_text(cols: list, sep: str) -> Column:
    """One delimited record as the CSV writer makes it: nulls are empty fields, empty strings are
    quoted, fields that hold the separator, a quote or a line feed are quoted and escaped."""
    return F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"f{i}") for i, c in enumerate(cols)]), {"sep": sep, "emptyValue": '""', "comment": "\x01", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})


ROWS_PER_FILE = 1_000_000


def write_text_dump(lines: DataFrame, path: str, head: list[str], compression: str | None = None,
                    partition_by: str | None = None, n_chunks: int | None = None,
                    rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write a one-column ``value`` frame (plus ``partition_by``) as text files, each
    beginning with ``head``.  Layout: ``path/[<partition_by>=<key>/]chunk=<n>/part-*``.

    Without ``n_chunks`` every key gets ``ceil(rows / rows_per_file)`` chunks: a small key
    is one file, a key holding a third of all rows is spread over many tasks.  The
    per-key counts are one pre-aggregated row per key (one per output file group)."""
    keys = [partition_by] if partition_by else []
    base = lines.select("value", *[F.col(k).cast("string").alias(k) for k in keys])
    if n_chunks is None:
        chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file))).cast("bigint")
        if keys:
            base = base.join(base.groupBy(*keys).agg(chunks.alias("__n")), keys)
            n_col = F.col("__n")
        else:  # one number for the whole dump: a scalar subquery
            n_col = base.agg(chunks).scalar()
    else:
        n_col = F.lit(max(1, n_chunks))
    data = base.select(
        "value", *keys, F.pmod(F.xxhash64("value", F.monotonically_increasing_id()), n_col).alias(CHUNK_COL), F.lit(len(head)).alias("__ord"))
    group_cols = keys + [CHUNK_COL]
    if head:
        heads = (data.select(*group_cols).distinct()
                 .select(*group_cols, F.posexplode(F.array(*[F.lit(h) for h in head])).alias("__ord", "value")))
        data = data.unionByName(heads)
    out = (data.repartition(*[F.col(c) for c in group_cols])
               .sortWithinPartitions(*group_cols, "__ord")
               .drop("__ord"))
    w = out.write.mode("overwrite").partitionBy(*group_cols)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_delimited_dump(df: DataFrame, path: str, sep: str = "\t", header: str | None = None,
                         preamble: list[str] | None = None, trailing_sep: bool = False,
                         compression: str | None = None, partition_by: str | None = None,
                         n_chunks: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
    cols = [c for c in df.columns if c != partition_by]
    line = as_text(cols, sep)
    if trailing_sep:
        line = F.concat(line, F.lit(sep))
    sel = [line.alias("value")] + ([F.col(partition_by)] if partition_by else [])
    head = list(preamble or []) + ([header] if header is not None else [])
    write_text_dump(df.select(*sel), path, head, compression=compression, partition_by=partition_by,
                    n_chunks=n_chunks, rows_per_file=rows_per_file)


def write_json_pages(terms: DataFrame, path: str, page_col: str, array_path: tuple[str, str] = ("_embedded", "terms")) -> None:
    """One JSON document per page (API-style paging), one on each line of a bounded number of
    files: ``{"_embedded":{"terms":[...]}}``.

    Rows are grouped by ``page_col``; the caller picks the page count so a page stays
    bounded (the group is a page, never a whole table)."""
    outer, inner = array_path
    item_cols = [c for c in terms.columns if c != page_col]
    docs = terms.groupBy(page_col).agg(
        F.to_json(F.struct(F.struct(F.collect_list(F.struct(*item_cols)).alias(inner)).alias(outer))).alias("value")
    )
    docs.select("value").write.mode("overwrite").text(path)
