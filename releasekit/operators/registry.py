"""The release registry as an ordinary keyed table (REG-1..14, SNK-6, SRC-10).

Every operator takes any DataFrame plus key / order column names, so the same code
serves the ten-row catalog and billion-row fact tables.  Key columns are compared
null-safe throughout: a null field equals a null field.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import SLUG_PATTERN, resource_relpath, storage_url
from releasekit.session import child_names, remove_path
from releasekit.sources import commits
from releasekit.sources.writers import published_path

KEY = ["source", "storage", "artifact", "version", "created"]

FORMAT_TYPE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("default", T.BooleanType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("storage", T.StringType()),
    T.StructField("artifact", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("artifact_name", T.StringType()),
    T.StructField("scheme", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("root", T.StringType()),
    T.StructField("formats", T.ArrayType(FORMAT_TYPE)),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("resources", T.MapType(T.StringType(), T.StringType())),
])


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_struct(name, type_="directory", default=True, properties=None) -> Column:
    props = _c(properties) if properties is not None else F.lit(None).cast("map<string,string>")
    return F.struct(_c(name).alias("name"), _c(type_).alias("type"), _c(default).alias("default"),
                    props.alias("properties"))


def default_format(formats="formats") -> Column:
    """First format flagged default, else the first one (REG-3)."""
    f = _c(formats)
    return F.coalesce(F.try_element_at(F.filter(f, lambda x: x["default"]), F.lit(1)),
                      F.try_element_at(f, F.lit(1)))


def resources_map(formats="formats", source="source", artifact="artifact", version="version",
                  created="created", scheme="scheme", bucket="bucket", root="root") -> Column:
    """format name -> full URL for every format (REG-2)."""
    f = _c(formats)
    names = F.transform(f, lambda x: x["name"])
    urls = F.transform(f, lambda x: storage_url(scheme, bucket, root,
                                                resource_relpath(source, artifact, version, created, x["name"])))
    return F.map_from_arrays(names, urls)


def build_entries(df: DataFrame, *, source, artifact, version, created, storage=None,
                  scheme=None, bucket=None, root=None, formats=None, metadata=None,
                  source_name=None, artifact_name=None, resources=None) -> DataFrame:
    """Registry rows from arbitrary columns, defaults filled in (REG-1).

    ``storage`` defaults to ``local``; ``formats`` to one Parquet directory flagged
    default; ``created`` to midnight today when null; ``resources`` to the layout URLs
    (REG-2)."""
    none = lambda: F.lit(None).cast("string")
    storage = F.lit("local") if storage is None else storage
    scheme = none() if scheme is None else scheme
    bucket = none() if bucket is None else bucket
    root = none() if root is None else root
    source_name = none() if source_name is None else source_name
    artifact_name = none() if artifact_name is None else artifact_name
    if formats is None:
        formats = F.array(format_struct(F.lit("parquet"), F.lit("directory"), F.lit(True)))
    if metadata is None:
        metadata = F.lit(None).cast("map<string,string>")
    created_c = F.coalesce(_c(created).cast("timestamp_ntz"),
                           F.date_trunc("day", F.localtimestamp()).cast("timestamp_ntz"))
    base = df.select(
        _c(source).alias("source"), _c(storage).alias("storage"), _c(artifact).alias("artifact"),
        _c(version).alias("version"), created_c.alias("created"),
        _c(source_name).alias("source_name"), _c(artifact_name).alias("artifact_name"),
        _c(scheme).alias("scheme"), _c(bucket).alias("bucket"), _c(root).alias("root"),
        _c(formats).alias("formats"), _c(metadata).alias("metadata"),
        *( [_c(resources).alias("resources")] if resources is not None else [] ),
    )
    if resources is None:
        base = base.withColumn("resources", resources_map())
    return base.select(*[F.col(f.name).cast(f.dataType) for f in REGISTRY_SCHEMA.fields])


def with_paths(reg: DataFrame) -> DataFrame:
    """Relative path and URL of each entry's default format (REG-2/3, ``Entry.path``/``url``)."""
    fmt = default_format()["name"]
    return (reg.withColumn("default_format", fmt)
               .withColumn("path", resource_relpath("source", "artifact", "version", "created", fmt))
               .withColumn("url", F.element_at("resources", fmt)))


# --- lookups -----------------------------------------------------------------------------

def find(reg: DataFrame, source: str | None = None, artifact: str | None = None,
         version: str | None = "latest") -> DataFrame:
    """REG-5/REG-7.  ``version`` None/'' = every version; ``'latest'`` (the default) = all
    entries of the lexically greatest version of each (source, artifact) (D1).  Newest first."""
    df = reg
    if source is not None:
        df = df.where(F.col("source") == source)
    if artifact is not None:
        df = df.where(F.col("artifact") == artifact)
    if version == "latest":
        df = latest_version_all(df, ["source", "artifact"], "version")
    elif version:
        df = df.where(F.col("version") == version)
    return df.orderBy(F.desc("version"), F.desc("created"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest ``order`` tuple winning (REG-6).

    ``max_by`` over a struct, with map-side partial results, so a hot key is pre-reduced on
    every task before the shuffle.  Spark plans it as a sort aggregate (struct buffers are
    not hash-aggregatable): each task sorts its rows by key, nothing is sorted globally."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.struct(*[F.col(o) for o in order])).alias("__row")
    )
    return picked.select(*keys, "__row.*")


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on null-safe equality of ``keys``; ``right`` is reduced to its other columns."""
    named = right.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
                         *[F.col(c) for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)])
    return left.join(named, same, how).drop(*[f"__key_{i}" for i in range(len(keys))])


def latest_version_all(df: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """Every row carrying the greatest ``version`` of its key, ties kept (REG-7).  The input is
    read twice: give a stored table where its computation is costly."""
    top = df.groupBy(*keys).agg(F.max(version).alias("__top"))
    return _same_keys(df, top, keys, "inner").where(F.col(version) == F.col("__top")).drop("__top")


# --- updates -----------------------------------------------------------------------------

def duplicates_of(new: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    return _same_keys(new, base.select(*keys), keys, "left_semi")


def _repeats(new: DataFrame, keys: list[str]) -> DataFrame:
    return new.groupBy(*keys).count().where("count > 1").select(*keys, F.lit("repeated in insert").alias("__why"))


def _refuse(bad: DataFrame) -> None:
    first = bad.limit(1).collect()
    if first:
        row = first[0].asDict()
        raise ValueError(f"entry {row.pop('__why')}: {row}")


def insert_strict(base: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """REG-8: union, but a key already present (or repeated in ``new``) is an error."""
    # both probes in one job: keys already in base, and keys repeated within new
    clash = duplicates_of(new, base, keys).select(*keys, F.lit("already exists").alias("__why"))
    _refuse(clash.unionByName(_repeats(new, keys)))
    return base.unionByName(new)


def upsert(base: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """REG-9: rows of ``new`` replace rows of ``base`` with the same key; a key repeated in
    ``new`` is an error."""
    _refuse(_repeats(new, keys))
    return _same_keys(base, new.select(*keys), keys, "left_anti").unionByName(new)


def remove(base: DataFrame, gone: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """REG-10: drop every row whose key is in ``gone``."""
    return _same_keys(base, gone.select(*keys), keys, "left_anti")


def removed_any(base: DataFrame, gone: DataFrame, keys: list[str] = KEY) -> bool:
    return not _same_keys(base, gone.select(*keys), keys, "left_semi").isEmpty()


def exists_flag(candidates: DataFrame, base: DataFrame, keys: list[str] = KEY, name: str = "present") -> DataFrame:
    """REG-11: membership flag per candidate row (duplicates in ``base`` cannot multiply rows)."""
    marks = base.select(*keys).distinct().withColumn(name, F.lit(True))
    return (_same_keys(candidates, marks, keys, "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


def entry_faults(entries: DataFrame) -> DataFrame:
    """``entries`` with ``fault``: why an entry may not be registered, null if it may.  Source,
    storage and artifact are slugs; a version begins with ``v``; there is at least one
    format, no format twice; every URL is non-empty."""
    bad_slug = lambda c: F.when(F.col(c).isNull() | ~F.col(c).rlike(SLUG_PATTERN), F.lit(f"{c} is no slug"))
    names = F.transform("formats", lambda f: f["name"])
    urls = F.map_values("resources")
    return entries.withColumn("fault", F.coalesce(
        bad_slug("source"), bad_slug("storage"), bad_slug("artifact"),
        F.when(F.col("version").isNull() | ~F.col("version").startswith("v"), F.lit("version does not begin with v")),
        F.when(F.coalesce(F.size("formats"), F.lit(0)) <= 0, F.lit("no format")),
        F.when(F.size(F.array_distinct(names)) != F.size(names), F.lit("repeated format")),
        F.when(F.coalesce(F.size(urls), F.lit(0)) <= 0, F.lit("no URL")),
        F.when(F.exists(urls, lambda u: F.coalesce(u, F.lit("")) == ""), F.lit("empty URL"))))


def require_valid(entries: DataFrame) -> DataFrame:
    """The same entries; an error if one of them has a fault."""
    _refuse(entry_faults(entries).where("fault IS NOT NULL").select(*KEY, F.concat(F.lit("refused, "), F.col("fault")).alias("__why")))
    return entries


def dedupe_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """REG-12: the last row (greatest ``ordinal``) of each key, like a dict built in order."""
    return latest_per_key(df, keys, [ordinal])


def merge(*frames: DataFrame) -> DataFrame:
    """REG-14 / SET-4: append without de-duplication."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_position(reg: DataFrame, order: list = KEY, name: str = "position") -> DataFrame:
    """SRT-4: 1-based position under the composite key, without gathering all rows in one task:
    a range sort, then a number per partition on top of the sizes of those before it (one
    row per partition)."""
    ranged = reg.repartitionByRange(*[F.col(o) if isinstance(o, str) else o for o in order]).sortWithinPartitions(*order)
    numbered = ranged.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part, row = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    joined = numbered.withColumn("__part", part).join(F.broadcast(before.select("__part", "__before")), "__part")
    return joined.withColumn(name, F.coalesce("__before", F.lit(0)) + row + 1).drop("__id", "__part", "__before")


# --- persistence (SNK-6) ----------------------------------------------------------------

COMMITS = "_commits"


def save_registry(reg: DataFrame, root: str, base: int | None = None) -> str:
    """Write a new registry version and commit it; the path that a reader may be using is never
    rewritten (D16).  An empty registry is a version like any other.  With ``base`` (the number
    that ``load_version`` gave) the commit is made only if no other has come since, else it is a
    ``CommitConflict`` and nothing has changed; without, ``reg`` follows whatever is there.
    Returns the directory of the version."""
    spark, root = reg.sparkSession, root.rstrip("/")
    data = f"rv={_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%d%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    # file sizes are left to adaptive execution
    reg.hint("rebalance").write.mode("errorifexists").option("maxRecordsPerFile", 1_000_000).parquet(f"{root}/{data}")
    log = f"{root}/{COMMITS}"
    while True:
        at = base if base is not None else (commits.head(spark, log) or (0,))[0]
        if commits.commit(spark, log, at + 1, {"data": data}):
            return data
        if base is not None:
            remove_path(spark, f"{root}/{data}")
            raise commits.CommitConflict(f"{root} has moved on from version {base}")


def load_version(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number and content of the newest registry version; older ones are not opened.  A missing
    location is an empty registry with number 0; one that can't be reached is an error."""
    root = root.rstrip("/")
    found = commits.head(spark, f"{root}/{COMMITS}")
    if found:
        return found[0], spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/{found[1]['data']}")
    # registries from before there were commits: the newest complete directory
    for rv in sorted((n for n in child_names(spark, root) if n.startswith("rv=")), reverse=True):
        if "_SUCCESS" in child_names(spark, f"{root}/{rv}"):
            return 0, spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/{rv}")
    return 0, empty_registry(spark)


def load_registry(spark: SparkSession, root: str) -> DataFrame:
    return load_version(spark, root)[1]


def update_registry(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], attempts: int = 50) -> int:
    """Read, change, commit.  Where another writer commits in between, the registry is read again
    and ``change`` (and its checks) applied to that, so no writer's entries are lost and a strict
    insert still fails on a key that has come meanwhile.  Returns the number of the version."""
    for _ in range(attempts):
        number, reg = load_version(spark, root)
        try:
            save_registry(change(reg), root, base=number)
            return number + 1
        except commits.CommitConflict:
            continue
    raise commits.CommitConflict(f"{root}: {attempts} attempts, each overtaken by another writer")


def expire_versions(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Remove the data of all but the newest ``keep`` registry versions."""
    return commits.expire(spark, f"{root.rstrip('/')}/{COMMITS}", root, keep)


# --- reading through the registry (SRC-10 / SRC-11) ---------------------------------------

def resolve(reg: DataFrame, source: str, artifact: str, version: str | None = "latest") -> dict:
    """The entry to read: newest ``created`` among the matches; error when none."""
    hit = with_paths(find(reg, source, artifact, version)).limit(1).collect()
    if not hit:
        raise ValueError(f"no entry for source={source!r} artifact={artifact!r} version={version!r}")
    return hit[0].asDict(recursive=True)


def recorded_schema(entry: dict) -> T.StructType | None:
    """The schema frozen in the entry's metadata at import time, if any."""
    raw = (entry.get("metadata") or {}).get("schema_json")
    return T.StructType.fromJson(json.loads(raw)) if raw else None


def read_release(spark: SparkSession, reg: DataFrame, source: str, artifact: str,
                 version: str | None = "latest", fmt: str | None = None,
                 enforce_schema: bool = True) -> DataFrame:
    """Resolve an entry and read the requested format (D6: the requested one, not the
    default).  The format's ``properties`` become reader options (delimiter,
    compression, ...); for self-describing-less formats (csv, json) the recorded schema is
    applied, so no inference pass runs and drift fails loudly instead of silently."""
    entry = resolve(reg, source, artifact, version)
    name = fmt or entry["default_format"]
    if name not in (entry["resources"] or {}):
        raise ValueError(f"entry has no {name!r} resource: {sorted(entry['resources'] or {})}")
    url = entry["resources"][name]
    props = next((f["properties"] for f in entry["formats"] or [] if f["name"] == name), None) or {}
    reader = spark.read.format(name).options(**props)
    schema = recorded_schema(entry) if enforce_schema and name not in ("parquet", "orc", "delta") else None
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(published_path(spark, url))
