"""Immutable snapshots of a continuously updated source (GOAL-4).

A Structured Streaming file source picks up new files; ``trigger(availableNow=True)``
processes what is there and stops, so a scheduled run is a batch job with
exactly-once bookkeeping in the checkpoint.  ``foreachBatch`` may replay a batch after
a failure, so each batch writes ``version=<v>/batch=<id>`` directories and overwrites
just those: a replay rewrites the same files instead of adding copies.

A version's entry points at its directory, so it covers every batch that had rows of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import version_from_ts
from releasekit.sources.writers import clustered


def batch_counts(batch: DataFrame, ts_col: str) -> DataFrame:
    """``version, newest, n`` of one batch (which has a column ``version``)."""
    return batch.groupBy(F.col("version").cast("string").alias("version")).agg(F.max(ts_col).alias("newest"), F.count(F.lit(1)).alias("n"))


def register_versions(spark: SparkSession, counts: DataFrame, batch_id: int, out_dir: str, registry_root: str,
                      source: str, artifact: str) -> None:
    """Bring the entries of the versions in ``counts`` up to date: ``created`` is the newest event time
    and ``nrow`` the rows of all batches so far, which are those of the version's newest entry and
    of this batch.  An entry names the last batch that it counts, so a replayed batch changes
    nothing.  Neither the store nor earlier batches are read."""
    from releasekit.operators import registry as R

    def change(reg: DataFrame) -> DataFrame:
        own = reg.where((F.col("source") == source) & (F.col("artifact") == artifact)).join(counts.select("version"), "version", "left_semi")
        newest = R.latest_per_key(own.withColumn("last", F.coalesce(F.col("metadata")["last_batch"].cast("bigint"), F.lit(-1).cast("bigint"))), ["version"], ["last", "created"])
        old = newest.select("version", F.col("created").alias("old_created"), F.col("metadata")["nrow"].cast("bigint").alias("old_n"), "last")
        fresh = counts.join(old, "version", "left").where(F.col("last").isNull() | (F.col("last") < batch_id))
        entries = R.build_entries(
            fresh, source=F.lit(source), artifact=F.lit(artifact), version="version",
            created=F.greatest(F.col("newest").cast("timestamp_ntz"), "old_created"),
            metadata=F.create_map(F.lit("nrow"), (F.col("n") + F.coalesce("old_n", F.lit(0))).cast("string"), F.lit("last_batch"), F.lit(str(batch_id))),
            resources=F.create_map(F.lit("parquet"), F.concat(F.lit(out_dir.rstrip("/") + "/version="), F.col("version"))))
        return R.upsert(reg, entries)

    R.update_registry(spark, registry_root, change)


def snapshot_stream(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                    checkpoint_dir: str, ts_col: str = "ts", grain: str = "day",
                    fmt: str = "parquet", max_files_per_trigger: int | None = None,
                    registry_root: str | None = None, source: str = "stream",
                    artifact: str = "snapshot", rows_per_file: int = 1_000_000) -> int:
    """Run one availableNow pass; returns the number of batches processed.  With
    ``registry_root`` every written version is registered (REG-9 upsert)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    batches: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("version", version_from_ts(ts_col, grain)).withColumn("batch", F.lit(batch_id))
        counts = batch_counts(out, ts_col).checkpoint()  # one row a version, read several times below
        (clustered(out, ["version"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", rows_per_file).partitionBy("version", "batch").parquet(out_dir))
        if registry_root:
            register_versions(spark, counts, batch_id, out_dir, registry_root, source, artifact)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def read_snapshots(spark: SparkSession, out_dir: str) -> DataFrame:
    """All snapshot rows with their ``batch`` and ``version`` (partition columns)."""
    return spark.read.parquet(out_dir)
