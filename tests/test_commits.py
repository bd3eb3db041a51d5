"""Commits that can't lose an entry, and releases that change under a reader."""

import threading

import pytest
from pyspark.sql import functions as F

from releasekit.operators import registry as R
from releasekit.operators.release_registry import ReleaseRegistry
from releasekit.session import path_exists
from releasekit.sources import commits
from releasekit.sources.writers import publish_release, published_path, read_published, write_parquet


def entry(spark, artifact, nrow=1, version="v1"):
    one = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created"))
    return R.build_entries(one, source=F.lit("s"), artifact=F.lit(artifact), version=F.lit(version), created="created",
                           metadata=F.create_map(F.lit("nrow"), F.lit(str(nrow))), root=F.lit("x"))


def artifacts(spark, root):
    return {r["artifact"]: r["metadata"]["nrow"] for r in R.load_registry(spark, root).collect()}


def in_threads(work, n):
    errors = []

    def run(k):
        try:
            work(k)
        except Exception as e:
            errors.append(e)
    threads = [threading.Thread(target=run, args=(k,)) for k in range(n)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return errors


def test_one_of_many_writers_puts_a_file(spark, scratch):
    root, won = scratch("put"), []
    commits.put_if_absent(spark, f"{root}/other", "x")
    assert not in_threads(lambda k: won.append(k) if commits.put_if_absent(spark, f"{root}/file", f"by {k}") else None, 8)
    assert len(won) == 1 and commits.read_text(spark, f"{root}/file") == f"by {won[0]}"


def test_rename_refuses_an_existing_target(spark, scratch):
    root = scratch("rename")
    for name in "abc":
        commits.put_if_absent(spark, f"{root}/{name}", name)
    assert not commits.rename_if_absent(spark, f"{root}/a", f"{root}/b") and commits.read_text(spark, f"{root}/b") == "b"
    assert commits.rename_if_absent(spark, f"{root}/a", f"{root}/d") and commits.read_text(spark, f"{root}/d") == "a"


def test_interleaved_saves_keep_both_entries(spark, scratch):
    root = scratch("reg")
    R.save_registry(entry(spark, "base"), root)
    a, b = ReleaseRegistry(spark, root), ReleaseRegistry(spark, root)
    a = a.add(entry(spark, "a1"))
    b = b.add(entry(spark, "a2")).add(entry(spark, "base", 7), overwrite=True).remove(entry(spark, "absent"))
    a.save()
    b.save()
    assert artifacts(spark, root) == {"base": "7", "a1": "1", "a2": "1"}
    # a strict insert is checked against what the other writer has committed
    c, d = ReleaseRegistry(spark, root).add(entry(spark, "a3", 1)), ReleaseRegistry(spark, root).add(entry(spark, "a3", 2))
    c.save()
    with pytest.raises(ValueError, match="already exists"):
        d.save()
    assert artifacts(spark, root)["a3"] == "1"


def test_writers_at_once_lose_nothing(spark, scratch):
    root = scratch("reg")
    assert not in_threads(lambda k: R.update_registry(spark, root, lambda reg: R.upsert(reg, entry(spark, f"t{k}"))), 6)
    assert set(artifacts(spark, root)) == {f"t{k}" for k in range(6)}
    assert commits.numbers(spark, f"{root}/{R.COMMITS}") == [1, 2, 3, 4, 5, 6]


def test_a_stale_base_is_refused(spark, scratch):
    root = scratch("reg")
    number, _ = R.load_version(spark, root)
    R.save_registry(entry(spark, "a"), root, base=number)
    with pytest.raises(commits.CommitConflict):
        R.save_registry(entry(spark, "b"), root, base=number)
    assert artifacts(spark, root) == {"a": "1"}
    R.save_registry(R.empty_registry(spark), root, base=1)
    assert artifacts(spark, root) == {}
    assert len(R.expire_versions(spark, root, keep=1)) == 1 and artifacts(spark, root) == {}


def test_registry_without_commits_is_read(spark, scratch):
    root = scratch("reg")
    entry(spark, "old").write.parquet(f"{root}/rv=20200101")
    assert artifacts(spark, root) == {"old": "1"}
    ReleaseRegistry(spark, root).add(entry(spark, "new")).save()
    assert set(artifacts(spark, root)) == {"old", "new"}


def test_a_reader_sees_one_whole_release(spark, scratch):
    url = scratch("release")
    assert publish_release(spark.range(10), url)[0] == "written"
    reader = read_published(spark, url)
    write_parquet(spark.range(99), f"{url}/_releases/dead")  # a writer that died before its pointer
    assert read_published(spark, url).count() == 10
    with pytest.raises(Exception):
        publish_release(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), url)
    assert read_published(spark, url).count() == 10
    publish_release(spark.range(20), url)
    assert (reader.count(), read_published(spark, url).count()) == (10, 20)
    first = published_path(spark, url)
    publish_release(spark.range(30), url)
    publish_release(spark.range(40), url)
    assert read_published(spark, url).count() == 40 and not path_exists(spark, first)


def test_policies(spark, scratch):
    url, won = scratch("release"), []
    in_threads(lambda k: won.append(publish_release(spark.range(k + 1), url, "refuse")[0]), 4)
    assert sorted(won) == ["refused"] * 3 + ["written"]
    assert publish_release(spark.range(50), url, "put")[0] == "written" and read_published(spark, url).count() == 50
    plain = scratch("plain")
    write_parquet(spark.range(5), plain)
    assert published_path(spark, plain) == plain and publish_release(spark.range(1), plain, "refuse")[0] == "refused"
    publish_release(spark.range(6).withColumn("x", F.lit("y")), plain, fmt="json")
    assert read_published(spark, plain).columns == ["id", "x"] and not [n for n in __import__("releasekit.session", fromlist=["x"]).child_names(spark, plain) if not n.startswith("_")]
    with pytest.raises(ValueError):
        publish_release(spark.range(1), url, "sometimes")
