"""Schema walkers and whole-frame projections (PRJ-2, PRJ-3, PRJ-4, CMP-1).

These look at ``df.schema`` (metadata) on the driver and emit one projection; the
data itself never leaves the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import NAME_RUN, NAME_TAIL


def sanitize_name(name: str) -> str:
    """lower, runs of non ``[0-9a-z]`` -> ``_``, trailing ``_`` stripped (leading kept)."""
    return re.sub(NAME_TAIL, "", re.sub(NAME_RUN, "_", name.lower()))


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column in one ``toDF`` (not a rename loop); fail on collisions (D13)."""
    new = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both sanitise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def _quote(path: list[str]) -> str:
    return ".".join(f"`{p}`" for p in path)


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """Struct leaves (arrays and maps count as leaves)."""
    out = []
    for f in schema.fields:
        p = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType):
            out.extend(leaf_paths(f.dataType, p))
        else:
            out.append((p, f.dataType))
    return out


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs -> ``sep``-joined top-level columns; arrays stay arrays (PRJ-3)."""
    cols = [F.col(_quote(list(p))).alias(sep.join(p)) for p, _ in leaf_paths(df.schema)]
    names = [sep.join(p) for p, _ in leaf_paths(df.schema)]
    if len(set(names)) != len(names):
        raise ValueError("flattened names collide; choose another separator")
    return df.select(*cols)


def expand_map(df: DataFrame, column: str, sep: str = "_") -> DataFrame:
    """Map column -> one column per key (``resources`` -> ``resources_parquet``), like a
    nested-record normaliser does with dicts.  The key set is collected first; it is a
    vocabulary (format names, metadata fields), not data-sized."""
    keys = sorted(r["k"] for r in df.select(F.explode(F.map_keys(F.col(f"`{column}`"))).alias("k"))
                  .where("k is not null").distinct().collect())
    cols = [F.col(f"`{column}`")[k].alias(f"{column}{sep}{k}") for k in keys]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column], *cols)


def to_flat(df: DataFrame, sep: str = "_", max_columns: int = 10_000) -> DataFrame:
    """PRJ-3 + PRJ-4 (REG-13): nested structs and maps flattened to ``sep``-joined columns,
    then columns that are null in every row dropped.  Arrays stay arrays.

    A column per map key is made for keys with a value in some row, at most ``max_columns`` in
    all (an error beyond that: such a map holds data, not a vocabulary).  Keys are reduced to
    distinct ones by Spark before they come to the driver."""
    flat = flatten(df, sep)
    maps = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.MapType)]
    plain = [c for c in flat.columns if c not in maps]
    got = flat.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(plain)]).first()
    cols = [F.col(f"`{c}`") for i, c in enumerate(plain) if got[f"c{i}"] > 0]
    if maps:
        def held_by(m: str):
            keys = F.map_keys(F.map_filter(F.col(f"`{m}`"), lambda k, v: v.isNotNull()))
            return F.transform(keys, lambda k: F.struct(F.lit(m).alias("m"), k.cast("string").alias("k")))

        held = [held_by(m) for m in maps]
        keys = flat.select(F.explode(F.concat(*[F.coalesce(h, F.array().cast("array<struct<m:string,k:string>>")) for h in held])).alias("x")).select("x.m", "x.k").distinct().limit(max_columns + 1).collect()
        if len(keys) > max_columns:
            raise ValueError(f"the maps {maps} have more than {max_columns} keys")
        for m in maps:
            cols += [F.col(f"`{m}`")[k].alias(f"{m}{sep}{k}") for k in sorted(r["k"] for r in keys if r["m"] == m)]
    return flat.select(*cols)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row, with one aggregation pass (PRJ-4)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def _type_name(dt: T.DataType) -> str:
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return {T.StructType: "struct", T.ArrayType: "array", T.MapType: "map"}[type(dt)]
    return dt.simpleString()


def schema_rows(schema: T.StructType) -> list[tuple[str, str]]:
    """Every path of a schema with its type (CMP-1).

    Arrays contribute ``path[]`` for the element, so ``a.refs[].id`` is a path,
    matching how evidence schemas are compared across releases.
    """
    rows: list[tuple[str, str]] = []

    def walk(dt: T.DataType, path: str) -> None:
        rows.append((path, _type_name(dt)))
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(dt, T.ArrayType):
            walk(dt.elementType, path + "[]")
        elif isinstance(dt, T.MapType):
            walk(dt.valueType, path + "{}")

    for f in schema.fields:
        walk(f.dataType, f.name)
    return rows


def tree_string(df: DataFrame) -> str:
    """Schema tree text as recorded next to a release."""
    return df.schema.treeString()
