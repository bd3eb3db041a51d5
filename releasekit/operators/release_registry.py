"""``ReleaseRegistry``: the registry operators bound to one storage location.

A convenience object for the usual workflow (load -> find / read -> add / upsert /
remove -> save).  Every method is one of the DataFrame operators in
``releasekit.operators.registry``; the object only remembers the location and the
current (lazy) registry DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from releasekit.operators import registry as R


class ReleaseRegistry:
    """``entries`` are the registry as loaded, with all changes made since.  A registry that was
    given its ``entries`` outright replaces what is stored when it is saved."""

    def __init__(self, spark: SparkSession, root: str, entries: DataFrame | None = None):
        self.spark = spark
        self.root = root
        self.changes: tuple[Callable[[DataFrame], DataFrame], ...] | None = () if entries is None else None
        self.entries = entries if entries is not None else R.load_registry(spark, root)

    def _changed(self, change: Callable[[DataFrame], DataFrame]) -> "ReleaseRegistry":
        out = ReleaseRegistry(self.spark, self.root, change(self.entries))
        out.changes = None if self.changes is None else (*self.changes, change)
        return out

    # lookups ---------------------------------------------------------------------------
    def find(self, source: str | None = None, artifact: str | None = None, version: str | None = "latest") -> DataFrame:
        return R.find(self.entries, source, artifact, version)

    def latest(self) -> DataFrame:
        """Newest entry of every (source, artifact)."""
        return R.latest_per_key(self.entries, ["source", "artifact"], ["version", "created"])

    def read(self, source: str, artifact: str, version: str | None = "latest", fmt: str | None = None) -> DataFrame:
        return R.read_release(self.spark, self.entries, source, artifact, version, fmt)

    def contains(self, candidates: DataFrame) -> DataFrame:
        return R.exists_flag(candidates, self.entries)

    def flat(self) -> DataFrame:
        from releasekit.functions.schema import to_flat

        return to_flat(self.entries)

    # updates (each returns a new registry; nothing is written until ``save``) -----------
    def add(self, new: DataFrame, overwrite: bool = False) -> "ReleaseRegistry":
        R.require_valid(new)
        return self._changed(lambda reg: R.upsert(reg, new) if overwrite else R.insert_strict(reg, new))

    def remove(self, gone: DataFrame) -> "ReleaseRegistry":
        return self._changed(lambda reg: R.remove(reg, gone))

    def merge(self, *others: "ReleaseRegistry") -> "ReleaseRegistry":
        return self._changed(lambda reg: R.merge(reg, *[o.entries for o in others]))

    def save(self) -> str:
        """Commit the changes made since loading, on top of what other writers have committed
        meanwhile; returns the version id."""
        if self.changes is None:
            return R.save_registry(self.entries, self.root)
        return f"version {R.update_registry(self.spark, self.root, lambda reg: reduce(lambda r, change: change(r), self.changes, reg))}"
