"""Column expressions (PRJ-5, SCL-1..11).  All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's contracts.
SLUG_PATTERN = r"^[A-Za-z0-9_]+$"          # identifier rule for source / artifact / storage slugs
RELEASE_TS_FORMAT = "yyyyMMdd'T'HHmmss"    # timestamp directory of a release
ARTIFACT_FILENAME = "data"                 # base name of a published resource
NAME_RUN, NAME_TAIL = r"[^0-9a-z]+", r"_+$"  # runs of other characters -> "_"; trailing ones go


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_tail(c) -> Column:
    """Last path segment of a URL; '' when the URL ends in '/' (SCL-1)."""
    return F.element_at(F.split(_c(c), "/"), -1)


def nth_token(c, sep_regex: str, n: int) -> Column:
    """n-th token (1-based) or null when out of range (SCL-2)."""
    return F.try_element_at(F.split(_c(c), sep_regex), F.lit(n))


def prefix(c, length: int) -> Column:
    """Fixed-length prefix (SCL-3)."""
    return F.substring(_c(c), 1, length)


def split_values(c, sep_regex: str = ";", drop_empty: bool = False) -> Column:
    """Multi-valued cell to an array (SCL-4).  Empty pieces (a trailing ';') are kept as the
    source has them; ``drop_empty`` removes them."""
    pieces = F.split(_c(c), sep_regex)
    return F.filter(pieces, lambda v: F.length(F.trim(v)) > 0) if drop_empty else pieces


def iri_to_curie(c) -> Column:
    """``.../HP_0000006`` -> ``HP:0000006`` (SCL-5)."""
    return F.replace(url_tail(c), F.lit("_"), F.lit(":"))


def release_from_path(c, pattern: str = r"_(\d{4}-\d{2})\.[^/]*$") -> Column:
    """Release period taken from a file name; null when the name has none (SCL-6)."""
    got = F.regexp_extract(_c(c), pattern, 1)
    return F.when(got != "", got)


def version_from_ts(c, grain: str = "month") -> Column:
    """``v2020-06`` (month) or ``v2020-07-28`` (day) from a timestamp (SCL-7)."""
    fmt = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]
    return F.concat(F.lit("v"), F.date_format(_c(c), fmt))


def created_from_version(c, grain: str = "month") -> Column:
    """Parse ``v2020-06`` / ``v2020-07-28`` back to a midnight timestamp (SCL-8)."""
    fmt = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]
    return F.to_timestamp_ntz(F.regexp_replace(_c(c), "^v", ""), F.lit(fmt))


def slugify(c) -> Column:
    """lower, runs of non ``[0-9a-z]`` -> ``_``, trailing ``_`` stripped; a leading ``_`` stays (SCL-9)."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(c)), NAME_RUN, "_"), NAME_TAIL, "")


def is_slug(c) -> Column:
    return _c(c).rlike(SLUG_PATTERN)


def release_dir_ts(c) -> Column:
    return F.date_format(_c(c), RELEASE_TS_FORMAT)


def resource_relpath(source, artifact, version, created, fmt) -> Column:
    """``source/artifact/version/yyyyMMddTHHmmss/data.<fmt>`` (SNK-2, REG-2)."""
    return F.concat_ws(
        "/", _c(source), _c(artifact), _c(version), release_dir_ts(created),
        F.concat(F.lit(ARTIFACT_FILENAME + "."), _c(fmt)),
    )


def storage_url(scheme, bucket, root, relpath) -> Column:
    """``scheme://bucket[/root]/relpath``; null parts are skipped (SCL-10), so a storage
    without scheme and bucket is a plain ``root/relpath`` (local or mounted storage)."""
    return F.concat_ws("", F.concat(_c(scheme), F.lit("://")),
                       F.concat_ws("/", _c(bucket), _c(root), _c(relpath)))


def artifact_kind(c, file_suffix: str) -> Column:
    """A name ending in ``file_suffix`` is a single file, anything else a directory (SCL-11)."""
    return F.when(_c(c).endswith(file_suffix), F.lit("file")).otherwise(F.lit("directory"))


#: What counts as a number in text.  Spark's cast takes Java's suffixes too, and would read the
#: identifiers 1D and 2F as numbers.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:nan|inf|infinity)\s*$"


def read_as(c, dt, source=None) -> Column:
    """``c`` as type ``dt``, null where it is none.  ``source`` is the type that ``c`` has; text
    (the default) must look like a number to be read as one."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dt, T.NumericType) and (source is None or isinstance(source, T.StringType)):
        return F.when(c.rlike(NUMBER), c.try_cast(dt))
    return c.try_cast(dt)
