"""Sinks: Parquet releases, versioned layout, publish policies, write profile (SNK-1..4)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from releasekit.functions.columns import ARTIFACT_FILENAME, RELEASE_TS_FORMAT
from releasekit.session import child_names, move_into_place, remove_path
from releasekit.sources import commits


def write_parquet(df: DataFrame, path: str, n_partitions: int | None = None, mode: str = "overwrite",
                  max_records_per_file: int | None = None) -> None:
    """SNK-1.  A fixed file count costs a full shuffle, so it is applied only when asked;
    otherwise AQE-coalesced partitions decide and ``maxRecordsPerFile`` bounds file size."""
    if n_partitions is not None:
        df = df.repartition(n_partitions)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


@dataclass
class WriteProfile:
    nrow: int
    non_null: dict[str, int]
    schema: str
    path: str = ""
    extra: dict = field(default_factory=dict)

    def as_metadata(self) -> dict[str, str]:
        return {"nrow": str(self.nrow), "schema": self.schema}


def write_profiled(df: DataFrame, path: str, n_partitions: int | None = None, mode: str = "overwrite",
                   fmt: str = "parquet") -> WriteProfile:
    """SNK-4: row count and per-column non-null counts gathered by the write itself
    (``Observation``), so the release is not scanned a second time to count it."""
    obs = Observation("write_profile")
    metrics = [F.count(F.lit(1)).alias("__nrow")]
    metrics += [F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(df.columns)]
    observed = df.observe(obs, *metrics)
    if n_partitions is not None:
        observed = observed.repartition(n_partitions)
    observed.write.mode(mode).format(fmt).save(path)
    got = obs.get
    return WriteProfile(
        nrow=int(got["__nrow"]),
        non_null={c: int(got[f"nn{i}"]) for i, c in enumerate(df.columns)},
        schema=df.schema.treeString(),
        path=path,
    )


def release_relpath(source: str, artifact: str, version: str, created, fmt: str = "parquet") -> str:
    """``source/artifact/version/yyyyMMddTHHmmss/data.fmt`` (SNK-2, driver-side twin of
    ``functions.columns.resource_relpath``)."""
    assert RELEASE_TS_FORMAT == "yyyyMMdd'T'HHmmss"
    return "/".join([source, artifact, version, created.strftime("%Y%m%dT%H%M%S"), f"{ARTIFACT_FILENAME}.{fmt}"])


POLICIES = ("replace", "refuse", "put")


def publish(df: DataFrame, url: str, policy: str = "replace", fmt: str = "parquet",
            n_partitions: int | None = None) -> tuple[str, WriteProfile | None]:
    """SNK-3: ``replace`` exchanges an existing target once the new data are complete (a failed
    write leaves it as it was), ``refuse`` leaves an existing target alone, ``put`` writes
    over it in place.  Returns (outcome, profile)."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; one of {POLICIES}")
    if policy == "replace":
        staged = f"{url.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
        prof = write_profiled(df, staged, n_partitions=n_partitions, mode="errorifexists", fmt=fmt)
        move_into_place(df.sparkSession, staged, url)
        prof.path = url
        return "written", prof
    try:
        prof = write_profiled(df, url, n_partitions=n_partitions, mode="errorifexists" if policy == "refuse" else "overwrite", fmt=fmt)
    except AnalysisException as e:
        if policy == "refuse" and "PATH_ALREADY_EXISTS" in str(e):
            return "refused", None
        raise
    return "written", prof


RELEASES, COMMITS = "_releases", "_commits"


def publish_release(df: DataFrame, url: str, policy: str = "replace", fmt: str = "parquet",
                    n_partitions: int | None = None, keep: int = 2) -> tuple[str, WriteProfile | None]:
    """SNK-3 for releases that are read while they change: the data go to a folder of their own
    below ``url``, and a numbered pointer, written last, makes them the release.  Readers
    (``published_path``, ``read_published``, the registry) follow the newest pointer, so they see
    one whole release at any moment; a writer that dies leaves the old one in place.

    ``replace`` keeps the data of the newest ``keep`` releases, for readers that began before;
    ``put`` keeps all; ``refuse`` leaves an existing release alone, also where two writers start
    at once.  A plain directory at ``url`` counts as a release and goes with the first
    ``replace``.  Returns (outcome, profile)."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; one of {POLICIES}")
    spark, url = df.sparkSession, url.rstrip("/")
    log = f"{url}/{COMMITS}"
    found = commits.head(spark, log)
    plain = [n for n in child_names(spark, url) if n not in (COMMITS, RELEASES)] if not found else []
    if policy == "refuse" and (found or plain):
        return "refused", None
    data = f"{RELEASES}/{uuid.uuid4().hex}"
    prof = write_profiled(df, f"{url}/{data}", n_partitions=n_partitions, mode="errorifexists", fmt=fmt)
    what = {"data": data, "format": fmt, "nrow": prof.nrow, "schema": df.schema.json()}
    number = found[0] if found else 0
    while not commits.commit(spark, log, number + 1, what):
        if policy == "refuse":
            remove_path(spark, f"{url}/{data}")
            return "refused", None
        number = commits.head(spark, log)[0]
    if policy == "replace":
        commits.expire(spark, log, url, keep)
        for name in plain:
            remove_path(spark, f"{url}/{name}")
    return "written", prof


def published_path(spark: SparkSession, url: str) -> str:
    """The folder that holds the release at ``url`` now; ``url`` itself where nothing was published
    by pointer."""
    url = url.rstrip("/")
    found = commits.head(spark, f"{url}/{COMMITS}")
    return f"{url}/{found[1]['data']}" if found else url


def read_published(spark: SparkSession, url: str, fmt: str | None = None) -> DataFrame:
    """The release at ``url``, in the format that its pointer names."""
    found = commits.head(spark, f"{url.rstrip('/')}/{COMMITS}")
    return spark.read.format(fmt or (found[1]["format"] if found else "parquet")).load(published_path(spark, url))


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring the rows of a key together for a partitioned write, in one pass: a rebalance by
    ``keys``, whose partitions adaptive execution splits where a key is large and joins
    where keys are small, from the measured sizes."""
    return df.hint("rebalance", *[F.col(k) for k in keys])


def write_indexed(df: DataFrame, path: str, key: str, mode: str = "errorifexists", rows_per_file: int = 1_000_000,
                  row_group_bytes: int = 8 << 20) -> None:
    """SNK-1 for point lookups: rows sorted by ``key`` within files of a key range each, small row groups,
    and a Bloom filter of the key in each.  A reader that asks for one key skips files and row
    groups by their least and greatest key, and what is left by the filter.  Rows of one key
    are ranged by a hash of the row as well, so a hot key spreads over tasks."""
    others = [F.col(f"`{c}`").cast("string") for c in df.columns]
    ranged = df.withColumn("__spread", F.xxhash64(*others)).repartitionByRange(F.col(f"`{key}`"), F.col("__spread")).sortWithinPartitions(F.col(f"`{key}`")).drop("__spread")
    (ranged.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def write_versioned(df: DataFrame, root: str, version_col: str = "version", mode: str = "overwrite",
                    rows_per_file: int | None = None, created_col: str | None = None) -> None:
    """Many releases at once: one ``version=...`` directory each (and below it one
    ``created=yyyyMMddTHHmmss`` directory per collection, with ``created_col``),
    partition-prunable on read.  ``overwrite`` replaces the releases that ``df`` holds and
    leaves all others.

    Without ``rows_per_file`` every task writes its own file per version it holds (no
    shuffle); with it, rows are clustered, and no file gets more rows than that."""
    levels = [version_col]
    if created_col:
        df = df.withColumn("created", F.date_format(created_col, RELEASE_TS_FORMAT))
        levels.append("created")
    w = (clustered(df, levels) if rows_per_file else df).write.mode(mode).partitionBy(*levels)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(root)
