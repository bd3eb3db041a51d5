"""Query table of the subpackage and the helpers its operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from releasekit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame``, with its DuckDB SQL if it has one."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared by driver and executors), among the
    library's scratch output, which ``session.clear_scratch`` removes."""
    return scratch_path(spark, f"llm-{label}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts the lineage,
    and a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column yet."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches in slices of a few rows, so that a worker holds few texts as Python objects
    at a time, however many rows a batch has."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bits of a map of keys, and comparisons that a task gets.
MAP_BITS, COMPARISONS = 1 << 26, 20_000_000


def key_map(keys: DataFrame, key: Column) -> DataFrame:
    """``bucket, bits``: a bitmap of the 64-bit values ``key``, or-ed together in Spark and stored: at
    most 2,048 rows of 4 KB, whatever the number of keys, so it can be broadcast."""
    bit = F.pmod(key, F.lit(MAP_BITS)) + 1  # the functions number bits from 1
    return stored(keys.groupBy(F.bitmap_bucket_number(bit).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits")), "keymap")


def in_map(rows: DataFrame, key: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """``rows`` with the column ``name``: false where ``key`` is surely not among the keys of the map
    (a few other rows have true, too).  No shuffle."""
    bit = F.pmod(key, F.lit(MAP_BITS)) + 1
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.expr("1").cast("int") == F.getbit(byte.cast("long"), F.pmod(at, F.lit(8)).cast("int")).cast("int")
    return rows.withColumn("__bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmap), "__bucket", "left").withColumn(name, F.coalesce(held, F.lit(False))).drop("__bucket", "__bits")


def tasks_for(spark: SparkSession, comparisons: int | None) -> int:
    """How many tasks to deal ``comparisons`` out to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, -(-(comparisons or 0) // COMPARISONS)))


def raw_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings, one after the other, and the limits of each row
    in them; a null counts as empty.  Nothing is copied where the column is one buffer."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_utf8())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, limits, data = column.buffers()
    limits = np.frombuffer(limits, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[limits[0]:limits[-1]], limits - limits[0]


def byte_slices(batches: Iterator, column: str, most: int) -> Iterator:
    """Arrow batches in slices whose texts hold ``most`` bytes at most, or one row."""
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            start = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, start + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: a one-element transform binds it to a
    lambda variable, so the optimizer can't copy the expression into an inner lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)
