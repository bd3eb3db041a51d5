"""GOAL-4: a snapshot run equals the batch answer, and a re-run adds nothing."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.streaming.snapshots import read_snapshots, snapshot_stream


def test_snapshot_equals_batch_and_is_exactly_once(spark, scratch):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    root = scratch("stream")
    e.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{root}/in")
    schema = T.StructType(e.schema.fields + [T.StructField("day", T.DateType())])
    n1 = snapshot_stream(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ckpt", registry_root=f"{root}/reg")
    assert n1 >= 1
    snap = read_snapshots(spark, f"{root}/out")
    batch = e.groupBy(F.concat(F.lit("v"), F.date_format("ts", "yyyy-MM-dd")).alias("version")).count()
    got = snap.groupBy(F.col("version").cast("string").alias("version")).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    n2 = snapshot_stream(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ckpt", registry_root=f"{root}/reg")
    assert n2 == 0 and read_snapshots(spark, f"{root}/out").count() == e.count()
    from releasekit.operators import registry as R
    reg = R.load_registry(spark, f"{root}/reg")
    assert reg.count() == batch.count()  # one entry per version
    day = batch.orderBy("version").first()["version"]
    back = R.read_release(spark, reg, "stream", "snapshot", day)
    assert back.count() == batch.where(F.col("version") == day).first()["count"]


def test_accounting_reads_no_history_and_a_replay_changes_nothing(spark, scratch):
    import datetime as dt

    from releasekit.operators import registry as R
    from releasekit.streaming.snapshots import batch_counts, register_versions

    root = scratch("accounting")
    rows = lambda *hours: spark.createDataFrame([(f"v2024-01-0{d}", dt.datetime(2024, 1, d, h)) for d, h in hours], "version string, ts timestamp_ntz")
    state = lambda: {(r["version"], r["created"].hour): (r["metadata"]["nrow"], r["metadata"]["last_batch"]) for r in R.load_registry(spark, f"{root}/reg").collect()}
    batches = [rows((1, 3), (1, 5), (2, 1)), rows((1, 4)), rows((1, 9), (3, 0))]
    for k, b in enumerate(batches):
        for _ in range(2):  # the second time is a replay
            register_versions(spark, batch_counts(b, "ts"), k, f"{root}/never_written", f"{root}/reg", "s", "a")
    assert state() == {("v2024-01-01", 5): ("3", "1"), ("v2024-01-01", 9): ("4", "2"), ("v2024-01-02", 1): ("1", "0"), ("v2024-01-03", 0): ("1", "2")}
    register_versions(spark, batch_counts(batches[1], "ts"), 1, f"{root}/never_written", f"{root}/reg", "s", "a")  # an old batch again
    assert len(state()) == 4 and state()["v2024-01-01", 9] == ("4", "2")
