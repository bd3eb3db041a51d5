"""Whole import: ingest -> clean -> Parquet -> publish -> register (SNK-5).

Idempotent per (source, artifact, version, created): re-running replaces the release (readers
see the old or the new one, whole) and upserts the same registry key."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import SLUG_PATTERN, read_as
from releasekit.functions.schema import sanitize_columns
from releasekit.operators import registry as R
from releasekit.operators.quality import cast_fails
from releasekit.sources.writers import WriteProfile, publish_release, release_relpath


def _check_names(source: str, artifact: str, storage: str, version: str) -> None:
    """The rules of ``registry.entry_faults`` that are known before the write."""
    for name, value in (("source", source), ("artifact", artifact), ("storage", storage)):
        if not re.fullmatch(SLUG_PATTERN.strip("^$"), value or ""):
            raise ValueError(f"{name} is no slug: {value!r}")
    if not (version or "").startswith("v"):
        raise ValueError(f"version does not begin with v: {version!r}")


def import_release(
    spark: SparkSession,
    df: DataFrame,
    *,
    registry_root: str,
    store_root: str,
    source: str,
    artifact: str,
    version: str,
    created: _dt.datetime | None = None,
    storage: str = "local",
    policy: str = "replace",
    n_partitions: int | None = None,
    sanitize: bool = True,
    types: T.StructType | None = None,
) -> dict:
    """Publish ``df`` as a release and register it.  Returns the registry entry as a dict
    with the write profile (nrow, non-null counts) gathered during the write.  The entry is
    checked before anything is written.  ``types`` casts columns by name; values that are
    none of their type become null and are counted per column (``bad_casts``)."""
    _check_names(source, artifact, storage, version)
    if created is None:
        created = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    if sanitize:
        df = sanitize_columns(df)
    casts = None
    if types is not None:
        casts = Observation("casts")
        df = df.observe(casts, F.count(F.lit(1)).alias("n"), *[F.count_if(cast_fails(f"`{f.name}`", f.dataType, df.schema[f.name].dataType)).alias(f"bad{i}") for i, f in enumerate(types.fields)])
        df = df.select(*[read_as(f"`{f.name}`", f.dataType, df.schema[f.name].dataType).alias(f.name) for f in types.fields])
    rel = release_relpath(source, artifact, version, created, "parquet")
    url = f"{store_root.rstrip('/')}/{rel}"
    outcome, prof = publish_release(df, url, policy=policy, n_partitions=n_partitions)
    if prof is None:  # refused: the release already exists, keep its entry as is
        prof = WriteProfile(nrow=-1, non_null={}, schema=df.schema.treeString(), path=url)
    meta = {"nrow": str(prof.nrow), "schema": prof.schema, "schema_json": df.schema.json()}
    meta.update({f"non_null.{k}": str(v) for k, v in prof.non_null.items()})
    bad_casts = {}
    if casts is not None and outcome == "written":
        got = casts.get
        bad_casts = {f.name: int(got[f"bad{i}"]) for i, f in enumerate(types.fields) if got[f"bad{i}"]}
        meta.update({f"bad_casts.{k}": str(v) for k, v in bad_casts.items()})
    one = spark.range(1).select(
        F.lit(created.isoformat(" ")).cast("timestamp_ntz").alias("created"),
        F.create_map(*[x for kv in meta.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]).alias("metadata"),
    )
    entry = R.build_entries(
        one, source=F.lit(source), artifact=F.lit(artifact), version=F.lit(version), created="created",
        storage=F.lit(storage), root=F.lit(store_root.rstrip("/")), metadata="metadata",
    )
    if outcome == "written":
        R.require_valid(entry)
        R.update_registry(spark, registry_root, lambda reg: R.upsert(reg, entry))
    return {"outcome": outcome, "url": url, "relpath": rel, "nrow": prof.nrow, "non_null": prof.non_null, "bad_casts": bad_casts}
